"""Readers and writers on temporary files."""

import json
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from checks import storage_cases  # noqa: F401
from checks.cases import spark_query
from snowlit.functions.doi import has_doi
from snowlit.operators.content import extract_content, register_handler
from snowlit.operators.extract import parse_answers
from snowlit.sources import files
from snowlit.sources.commits import committed, publish, write_aside
from snowlit.sources.files import (
    export_answer_files,
    read_exported_answers,
    read_answer_files,
    read_failures,
    read_question_lines,
    read_questions,
    read_references,
    read_responses,
    read_saved_questions,
    read_topics,
    read_works,
    scan_pdfs,
    write_questions,
    write_references,
    write_responses,
)
from snowlit.functions.prompts import render_answer


@pytest.fixture
def folder(tmp_path):
    for name in ("b.pdf", "A.PDF", "notes.txt", "pdf"):
        (tmp_path / name).write_bytes(b"%PDF\n" + name.encode())
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "c.pdf").write_bytes(b"%PDF")
    return tmp_path


def names(df):
    return sorted(r.path.rsplit("/", 1)[1] for r in df.collect())


def test_scan_a_folder(spark, folder):
    assert names(scan_pdfs(spark, str(folder))) == ["A.PDF", "b.pdf"]


def test_scan_given_files(spark, folder):
    files = [str(folder / n) for n in ("b.pdf", "notes.txt", "A.PDF")]
    assert names(scan_pdfs(spark, files)) == ["A.PDF", "b.pdf"]
    assert names(scan_pdfs(spark, str(folder / "b.pdf"))) == ["b.pdf"]
    assert names(scan_pdfs(spark, str(folder / "notes.txt"))) == []


def test_scanned_files_are_read(spark, folder):
    register_handler("whole", lambda content: [content.decode()])
    got = extract_content(scan_pdfs(spark, str(folder)), "whole").collect()
    assert sorted(r.text for r in got) == ["%PDF\nA.PDF", "%PDF\nb.pdf"]


def test_reference_files(spark, tmp_path):
    refs = [
        {"title": "One", "doi": "10.1016/S0140-6736(05)1"}, {"title": "Title only"},
        {"doi": "10.3390/W12061530"}, {"title": "Empty", "doi": ""}, {"title": "Null", "doi": None},
    ]
    (tmp_path / "seed paper.json").write_text(json.dumps(refs, indent=4), encoding="utf-8")
    (tmp_path / "other.json").write_text("[]", encoding="utf-8")
    got = read_references(spark, str(tmp_path)).orderBy("pos")
    rows = [tuple(r) for r in got.collect()]
    assert [r[1] for r in rows] == [0, 1, 2, 3, 4]
    assert {r[0] for r in rows} == {"seed paper"}
    assert rows[1][2:] == ("Title only", None)
    assert [r.doi for r in got.filter(has_doi(F.col("doi"))).collect()] == [
        "10.1016/S0140-6736(05)1", "10.3390/W12061530"
    ]


def test_missing_reference_file_has_no_rows(spark, tmp_path):
    assert read_references(spark, f"{tmp_path}/none.json").count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_references_are_replaced(spark, tmp_path, fmt):
    path = f"{tmp_path}/refs"
    for rows in ([("p", 0, "t", None), ("p", 1, None, "10.1/a")], [("q", 0, "t", "10.1/b")]):
        df = spark.createDataFrame(rows, "paper_id STRING, pos INT, title STRING, doi STRING")
        write_references(df, path, fmt)
    assert [r.doi for r in spark.read.format(fmt).load(path).collect()] == ["10.1/b"]


def test_question_folder_in_path_order(spark, tmp_path):
    for name, text in (("q2.md", " two\n"), ("q10.md", "\nten\n\nmore "), ("a.MD", "first"), ("x.txt", "no")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = [tuple(r) for r in read_questions(spark, str(tmp_path)).orderBy("q_idx").collect()]
    assert got == [(1, "first"), (2, "ten\n\nmore"), (3, "two")]
    numeric = read_questions(spark, str(tmp_path), numeric=True).orderBy("q_idx")
    assert [r.question for r in numeric.collect()] == ["first", "two", "ten\n\nmore"]
    assert [r.question for r in read_questions(spark, f"{tmp_path}/q2.md").collect()] == ["two"]
    assert read_questions(spark, f"{tmp_path}/x.txt").count() == 0
    assert read_questions(spark, f"{tmp_path}/none").count() == 0


def test_question_lines(spark, tmp_path):
    (tmp_path / "q.txt").write_text(" one\n\n  \r\ntwo \r\nthree", encoding="utf-8")
    got = read_question_lines(spark, f"{tmp_path}/q.txt").orderBy("q_idx")
    assert [tuple(r) for r in got.collect()] == [(1, "one"), (2, "two"), (3, "three")]


def test_saved_questions(spark, tmp_path):
    path = f"{tmp_path}/questions"
    rows = [(1, "What?\n\nIn detail"), (2, "Why?")]
    write_questions(spark.createDataFrame(rows, "q_idx INT, question STRING"), path)
    assert sorted(map(tuple, read_saved_questions(spark, path).collect())) == rows


def test_answer_files(spark, tmp_path):
    for paper, q, response in (("My paper", 1, "NO USEFUL DATA"), ("other", 2, "a,b,1,2,3")):
        (tmp_path / "run" / paper).mkdir(parents=True)
        text = spark.range(1).select(render_answer(F.lit(q), F.lit("Q?"), F.lit(response))).first()[0]
        (tmp_path / "run" / paper / f"q{q}.md").write_text(text, encoding="utf-8")
    (tmp_path / "run" / "other" / "notes.md").write_text("no answer")
    saved = parse_answers(read_answer_files(spark, str(tmp_path)))
    assert sorted(map(tuple, saved.collect())) == [
        ("My paper", 1, "Q?", "NO USEFUL DATA"), ("other", 2, "Q?", "a,b,1,2,3")
    ]
    assert read_answer_files(spark, f"{tmp_path}/none").count() == 0


def test_exported_answer_files_are_read_again(spark, tmp_path):
    rows = [
        ("10.1/a b", 1, "x\n\ny\n"), ("10.1/a+b", 2, " "), ("100%2F", 1, "é"), ("..", 3, "dots"), ("a?#:", 10, "z"),
        ("twice", 1, "a"), ("twice", 1, "b"), (None, 1, "no id"), ("no number", None, "v"), ("no text", 1, None),
    ]
    documents = spark.createDataFrame(rows, "paper_id STRING, q_idx INT, value STRING")
    for _ in range(2):  # a second run replaces the files
        assert export_answer_files(documents, f"file:{tmp_path}/tree") == 6
    expected = sorted([*rows[:5], rows[6]])
    assert sorted(map(tuple, read_answer_files(spark, f"{tmp_path}/tree").collect())) == expected
    assert len([p for p in (tmp_path / "tree").rglob("*") if p.is_file() and p.suffix == ".md"]) == 6
    assert export_answer_files(documents.limit(0), f"{tmp_path}/none") == 0


def test_responses_are_never_overwritten(spark, tmp_path):
    path = f"{tmp_path}/responses"
    schema = "paper_id STRING, q_idx INT, response STRING, skipped BOOLEAN"
    assert read_responses(spark, path).count() == 0
    write_responses(spark.createDataFrame([("p", 1, "old", False), ("p", 1, "old", False)], schema), path)
    write_responses(spark.createDataFrame([("p", 1, "new", False), ("p", 2, "b", True)], schema), path)
    assert sorted(map(tuple, read_responses(spark, path).collect())) == [
        ("p", 1, "old", False), ("p", 2, "b", True)
    ]


RESPONSE_ROW = "paper_id STRING, q_idx INT, response STRING, skipped BOOLEAN, error STRING"


def test_two_interleaved_writers(spark, tmp_path, monkeypatch):
    path, real, tries = f"{tmp_path}/responses", files.publish, []
    late = [("p", 1, "late", False, None), ("q", 1, "q", False, None), ("r", 1, None, True, "boom"), ("s", 1, "s", False, None)]
    first = [("p", 1, "first", False, None), ("r", 1, "r", False, None), ("s", 1, None, True, "busy"), ("t", 1, None, True, "busy")]

    def meanwhile(spark, path, commit, number):
        tries.append(number)
        if len(tries) == 1:  # the other job ends after this one has written, before it publishes
            write_responses(spark.createDataFrame(first, RESPONSE_ROW), path)
        return real(spark, path, commit, number)

    monkeypatch.setattr(files, "publish", meanwhile)
    write_responses(spark.createDataFrame(late, RESPONSE_ROW), path)
    assert tries == [0, 0, 1]
    got = sorted((r.paper_id, r.response) for r in read_responses(spark, path).collect())
    assert got == [("p", "first"), ("q", "q"), ("r", "r"), ("s", "s")]
    assert [r.paper_id for r in read_failures(spark, path).collect()] == ["t"]


def test_many_writers_at_once(spark, tmp_path):
    path = f"{tmp_path}/responses"

    def write(n):
        rows = [(f"p{i}", 1, f"by {n}", False, None) for i in range(n, n + 6)]
        write_responses(spark.createDataFrame(rows, RESPONSE_ROW).coalesce(1), path)

    with ThreadPoolExecutor(5) as pool:
        list(pool.map(write, range(0, 15, 3)))
    got = sorted(r.paper_id for r in read_responses(spark, path).collect())
    assert got == sorted(f"p{i}" for i in range(18))
    assert len(committed(spark, path)) == 5


def test_one_job_gets_a_number(spark, tmp_path):
    for round in range(20):
        path, start = f"{tmp_path}/{round}", Barrier(6)

        def race(n):
            start.wait()
            return publish(spark, path, f"c{n}", 0)

        with ThreadPoolExecutor(6) as pool:
            won = list(pool.map(race, range(6)))
        assert won.count(True) == 1 and committed(spark, path) == [f"c{won.index(True)}"]


def test_a_job_that_died_leaves_nothing_to_read(spark, tmp_path):
    path = f"{tmp_path}/responses"
    answers = spark.createDataFrame([("p", 1, "lost", False, None)], RESPONSE_ROW)
    write_aside(answers, path, "q_idx")
    assert read_responses(spark, path).count() == 0
    commit = write_aside(answers, path, "q_idx")
    assert publish(spark, path, commit, 0)
    assert not publish(spark, path, "another", 0)
    assert read_responses(spark, path).count() == 1
    assert committed(spark, path) == [commit]


def test_catalogues(spark, tmp_path):
    works = {"doi": "10.1/a", "primary_location": {"pdf_url": None}, "topics": ["T1"], "extra": 1}
    (tmp_path / "works.json").write_text(json.dumps(works))
    row = read_works(spark, f"{tmp_path}/works.json", "json").first()
    assert row.topics == ["T1"] and row.primary_location.pdf_url is None and row.is_oa is None
    (tmp_path / "topics.json").write_text('{"id": "https://openalex.org/T1", "display_name": "Water"}')
    assert read_topics(spark, f"{tmp_path}/topics.json", "json").first().display_name == "Water"


def test_exported_answers_are_listed_and_read_by_tasks(spark, sf, tmp_path):
    papers = ["a", "b/c", "d%2Fe", ".", "..", "_f", ".g", "h+i j", "%2E", "\u00e9", *(f"p{i}" for i in range(200))]
    rows = [(paper, q, f"{paper} says {q}") for paper in papers for q in (1, 12)] + [("empty", 3, "")]
    documents = spark.createDataFrame(rows, "paper_id STRING, q_idx INT, value STRING")
    assert export_answer_files(documents, f"{tmp_path}/tree") == len(rows)
    (tmp_path / "tree" / "p1" / "q9.md.part").write_text("unfinished")
    assert sorted(map(tuple, read_exported_answers(spark, f"{tmp_path}/tree").collect())) == sorted(rows)
    assert read_exported_answers(spark, f"file:{tmp_path}/tree").count() == len(rows)
    assert read_exported_answers(spark, f"{tmp_path}/none").count() == 0
    # No file of an answer is known to the driver.
    assert spark_query("answers_from_files")(spark, sf).inputFiles() == []
