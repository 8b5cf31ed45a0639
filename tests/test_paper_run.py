"""Files and questions of any form to stored answers; replies that are none."""

import json

import pytest

from snowlit.operators.content import check_replies, register_handler
from snowlit.operators.worklist import split_errors
from snowlit.plans.paper_run import answer_documents, answer_papers
from snowlit.plans.question_run import run_questions
from snowlit.sources.files import collect_questions, export_answer_files, read_answer_files, read_failures, read_responses


def asked(spark, *sources):
    return [tuple(r) for r in collect_questions(spark, *sources).orderBy("q_idx").collect()]


def test_questions_from_anything(spark, tmp_path):
    folder = tmp_path / "questions"
    folder.mkdir()
    for name, text in {"b.md": " second \n", "a.MD": "first", "c.txt": "no question"}.items():
        (folder / name).write_text(text)
    (tmp_path / "none").mkdir()
    got = asked(
        spark, [str(folder), ["What: is [it]?", [f"{folder}/b.md", []], f"{folder}/c.txt"]],
        str(tmp_path / "none"), f"{tmp_path}/absent.md", "What: is [it]?", "why {a,b} * ?", "x" * 5000, "", "scheme://host/why",
    )
    assert got == list(enumerate([
        "first", "second", "What: is [it]?", "second", f"{tmp_path}/absent.md", "What: is [it]?", "why {a,b} * ?",
        "x" * 5000, "", "scheme://host/why",
    ], start=1))
    assert asked(spark, "One question") == [(1, "One question")]
    assert asked(spark) == asked(spark, [], [[]]) == []


def test_replies_without_an_answer_are_rows(spark):
    replies = {
        "ok": '{"message":{"content":"yes"}}', "busy": '{"error":"busy"}', "cut": '{"message":{"con', "null": None,
        "empty": "", "bare": '{"message":"text"}', "no": '{"message":{"content":null},"error":""}', "blank": '{"message":{"content":""}}',
    }
    df = spark.createDataFrame(list(replies.items()), "paper_id STRING, reply STRING")
    good, bad = split_errors(check_replies(df))
    assert {r.paper_id: r.content for r in good.collect()} == {"ok": "yes", "blank": ""}
    none = "no message content"
    assert {r.paper_id: r.error for r in bad.collect()} == {"busy": "busy", "cut": none, "null": none, "empty": none, "bare": none, "no": none}


def test_unusable_replies_are_asked_again(spark, tmp_path):
    papers = spark.createDataFrame([("p", "some words"), ("blank", " ")], "paper_id STRING, text STRING")
    questions = spark.createDataFrame([(1, "a?"), (2, "b?")], "q_idx INT, question STRING")
    path, replies = f"{tmp_path}/responses", ['{"error":"busy"}', "{", '{"message":{"content":"fine"}}']
    for reply in replies:
        def fn(bodies, reply=reply):
            assert all(json.loads(body)["model"] == "some-model" for body in bodies)
            return [reply if "a?" in body else replies[2] for body in bodies]

        run_questions(papers, questions, path, fn, model="some-model")
        if reply != replies[2]:
            error = "busy" if "busy" in reply else "no message content"
            assert error in {r.error for r in read_failures(spark, path).collect()}
            assert [(r.paper_id, r.q_idx) for r in read_failures(spark, path).collect()] == [("p", 1)]
    assert read_failures(spark, path).count() == 0
    assert sorted(tuple(r) for r in read_responses(spark, path).collect()) == [
        ("blank", 1, None, True), ("blank", 2, None, True), ("p", 1, "fine", False), ("p", 2, "fine", False),
    ]


@pytest.fixture
def folder(tmp_path):
    folder = tmp_path / "papers"
    folder.mkdir()
    files = {"one.v2": b"%PDF|first page|second", "b c%": b"%PDF|only", "blank": b"%PDF| |", "nothing": b"%PDF", "broken": b"html"}
    for name, content in files.items():
        (folder / f"{name}.pdf").write_bytes(content)
    return folder


def test_files_to_answers(spark, tmp_path, folder):
    read = tmp_path / "read"
    read.mkdir()

    def pages(content):
        texts = content.decode().split("|")[1:]
        with open(read / "log", "a") as log:
            log.write(f"{texts}\n")
        return texts

    def fn(prompts):
        return [f"{'only\n' in p} {p.count('page')} {'Why?' in p}" for p in prompts]

    register_handler("bars", pages)
    path = f"{tmp_path}/answers"
    run = lambda *questions: answer_papers(spark, str(folder), questions, "bars", path, fn, batch_size=2)
    problems = {r.path.rsplit("/", 1)[1]: r.error for r in run("Why?", ["How?"]).collect()}
    assert problems == {"broken.pdf": "not a PDF file", "nothing.pdf": "no pages"}
    got = {(r.paper_id, r.q_idx): r.response for r in read_responses(spark, path).collect()}
    assert got == {
        ("one.v2", 1): "False 1 True", ("one.v2", 2): "False 1 False", ("b c%", 1): "True 0 True", ("b c%", 2): "True 0 False",
        ("blank", 1): None, ("blank", 2): None,
    }
    # Finished files are not read again; a new one is, and a new question asks for all.
    (read / "log").unlink()
    (folder / "new.pdf").write_bytes(b"%PDF|new text")
    run("Why?", "How?")
    assert set((read / "log").read_text().splitlines()) == {"['new text']", "[]"}
    run("Why?", "How?", "When?")
    assert read_responses(spark, path).count() == 12
    questions = collect_questions(spark, "Why?", "How?", "When?")
    export_answer_files(answer_documents(questions, read_responses(spark, path)), f"{tmp_path}/tree")
    written = read_answer_files(spark, f"{tmp_path}/tree").collect()
    assert len(written) == 9 and {r.paper_id for r in written} == {"one.v2", "b c%", "new"}
    assert {r.value.split("\n")[2] for r in written} == {"Why?", "How?", "When?"}


def test_page_images_to_answers(spark, tmp_path, folder):
    register_handler("bar images", lambda content: content.split(b"|")[1:], output="image")
    path = f"{tmp_path}/answers"
    fn = lambda bodies: [str(len(json.loads(b)["messages"][1]["images"])) for b in bodies]
    problems = answer_papers(spark, str(folder), "Why?", "bar images", path, fn)
    assert {r.error for r in problems.collect()} == {"not a PDF file", "no pages"}
    got = {r.paper_id: r.response for r in read_responses(spark, path).collect()}
    assert got["one.v2"] == "--- Page 1 ---\n1\n\n--- Page 2 ---\n1" and set(got) == {"one.v2", "b c%", "blank"}


def test_no_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    register_handler("none", lambda content: [])
    path = f"{tmp_path}/answers"
    assert answer_papers(spark, str(tmp_path / "empty"), "Why?", "none", path, lambda p: p).count() == 0
    assert read_responses(spark, path).count() == 0
