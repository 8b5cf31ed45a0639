"""Questions, prompts, user code, answers and extraction."""

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks.storage_cases import pdf_folder, register_pages
from snowlit.functions.answers import has_data
from snowlit.functions.prompts import (
    messages,
    page_name,
    page_prompt,
    render_answer,
    reply_content,
    request_json,
    text_prompt,
)
from snowlit.operators import questions as questions_module
from snowlit.operators.content import answer, answer_bodies, extract_content, piece_ends, register_handler
from snowlit.operators.extract import (
    bibliography_entries,
    compare_runs,
    dedup_measurements,
    extract_measurements,
    extract_references,
    parse_answers,
    rejected_entries,
    run_agreement,
)
from snowlit.operators.pages import join_page_replies
from snowlit.operators.questions import (
    flatten_questions,
    pair_questions,
    pending_pairs,
    pending_questions,
    question_counts,
    question_rollup,
    rollup_digits,
)
from snowlit.plans.question_run import (
    page_requests,
    run_page_questions,
    run_questions,
    text_requests,
    whole_page_answers,
)
from snowlit.sources.files import read_failures, read_responses, scan_pdfs, write_responses


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.fixture(scope="module")
def papers(spark):
    rows = [("p1", "one  two\nthree"), ("p2", " \n"), ("p3", None), ("p4", "four")]
    return spark.createDataFrame(rows, "paper_id STRING, text STRING")


@pytest.fixture(scope="module")
def questions(spark):
    return spark.createDataFrame([(2, "Why?"), (1, "What?")], "q_idx INT, question STRING")


@pytest.fixture(params=[False, True], ids=["one block", "many blocks"])
def either_way(request, monkeypatch):
    """Run with all questions in one block, and with a block for each number."""
    if request.param:
        monkeypatch.setattr(questions_module, "NUMBERS_PER_BLOCK", 1)


def pairs(df):
    return sorted((r.paper_id, r.q_idx) for r in df.collect())


def test_pairs(papers, questions, either_way):
    paired = pair_questions(papers.select("paper_id"), questions)
    assert pairs(paired) == [(p, q) for p in ("p1", "p2", "p3", "p4") for q in (1, 2)]
    assert {(r.q_idx, r.question) for r in paired.collect()} == {(1, "What?"), (2, "Why?")}


def test_pending(spark, papers, questions, either_way):
    done = spark.createDataFrame(
        [("p1", 1), ("p1", 1), ("p2", 1), ("p2", 2), ("p9", 1), ("p3", 7)], "paper_id STRING, q_idx INT"
    )
    left = pending_pairs(papers.select("paper_id"), questions, done)
    assert pairs(left) == [("p1", 2), ("p3", 1), ("p3", 2), ("p4", 1), ("p4", 2)]


def test_finished_papers_are_gone_before_their_text_is_used(spark, papers, questions):
    done = spark.createDataFrame([("p1", 1), ("p1", 2)], "paper_id STRING, q_idx INT")
    left = pending_questions(papers, questions, done)
    assert sorted(r.paper_id for r in left.collect()) == ["p2", "p3", "p4"]


def test_text_requests(papers, questions, spark, either_way):
    done = spark.createDataFrame([("p4", 1)], "paper_id STRING, q_idx INT")
    got = {(r.paper_id, r.q_idx): r.prompt for r in text_requests(papers, questions, done, 8, 10).collect()}
    assert got["p1", 1] == (
        "Paper:\n\none two\n\n---\n\nthree\n\n---\n\nQuestion: What?\n\n"
        "Please answer based only on the paper above."
    )
    assert got["p2", 1] is None and got["p3", 2] is None
    assert ("p4", 1) not in got and ("p4", 2) in got


def test_requests_are_what_the_service_expects(spark):
    sent = messages(F.lit("sys"), F.lit('say "hi"\n'))
    plain = json.loads(value(spark, request_json("m", sent)))
    assert plain == {
        "model": "m",
        "messages": [{"role": "system", "content": "sys"}, {"role": "user", "content": 'say "hi"\n'}],
        "stream": False,
    }
    warm = json.loads(value(spark, request_json("m", sent, temperature=0.5)))
    assert warm["options"] == {"temperature": 0.5, "num_ctx": 256}
    wide = json.loads(value(spark, request_json("m", sent, max_context_tokens=32768)))
    assert wide["options"] == {"temperature": 1.0, "num_ctx": 32768}
    shown = messages(F.lit("s"), F.lit("u"), F.array(F.lit("aGk=")))
    body = json.loads(value(spark, request_json("m", shown)))
    assert body["messages"][1]["images"] == ["aGk="] and "images" not in body["messages"][0]


def test_prompt_wording(spark):
    assert value(spark, text_prompt(F.lit("C"), F.lit("Q"))) == (
        "Paper:\n\nC\n\n---\n\nQuestion: Q\n\nPlease answer based only on the paper above."
    )
    assert value(spark, page_prompt(F.lit(3), F.lit("Q"))) == (
        "[image]\n\nPage 3 of the paper:\n\nQuestion: Q\n\nPlease answer based only on the page image above."
    )
    assert value(spark, page_name(F.lit(7))) == "page_007.png"
    assert value(spark, page_name(F.lit(1234))) == "page_1234.png"


def test_replies(spark):
    rows = [('{"message":{"role":"assistant","content":"yes"}}',), ('{"message":{}}',), ("{}",), ("no",), (None,)]
    df = spark.createDataFrame(rows, "reply STRING")
    assert [r[0] for r in df.select(reply_content(F.col("reply"))).collect()] == ["yes", None, None, None, None]


def test_page_replies_in_page_order(spark):
    rows = [("p", n, f"r{n}") for n in (10, 2, 1)]
    df = spark.createDataFrame(rows, "paper_id STRING, page_no INT, reply STRING")
    assert join_page_replies(df).first().response == (
        "--- Page 1 ---\nr1\n\n--- Page 2 ---\nr2\n\n--- Page 10 ---\nr10"
    )


def test_page_requests_number_each_page(spark, questions):
    images = spark.createDataFrame([("p", 1), ("p", 2)], "paper_id STRING, page_no INT")
    got = page_requests(images, questions).collect()
    assert len(got) == 4 and all(f"Page {r.page_no} of" in r.prompt for r in got)


def test_flatten(spark):
    df = spark.createDataFrame([([["a", "b"], [], ["c"]],)], "questions ARRAY<ARRAY<STRING>>")
    assert [tuple(r) for r in flatten_questions(df).collect()] == [(1, "a"), (2, "b"), (3, "c")]


@pytest.fixture
def shout():
    """Made here so that it travels to the workers by value."""
    def upper(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("cannot say that")
        return [p.upper() for p in prompts]

    return upper


@pytest.mark.parametrize("batch_size,tasks", [(1, None), (3, None), (100, 2)])
def test_answers(spark, shout, batch_size, tasks):
    rows = [("p", i, t) for i, t in enumerate(["a", "bad", None, "d", "e", "bad", "g"])]
    requests = spark.createDataFrame(rows, "paper_id STRING, q_idx INT, prompt STRING")
    got = {r.q_idx: (r.response, r.skipped, r.error) for r in answer(requests, shout, batch_size, tasks).collect()}
    assert got == {
        0: ("A", False, None), 1: (None, True, "cannot say that"), 2: (None, True, "no text"),
        3: ("D", False, None), 4: ("E", False, None), 5: (None, True, "cannot say that"),
        6: ("G", False, None),
    }


def test_answering_twice_adds_nothing(spark, shout, papers, questions, tmp_path):
    path = f"{tmp_path}/responses"
    run_questions(papers, questions, path, shout, batch_size=2)
    first = sorted(map(tuple, read_responses(spark, path).collect()))
    assert len(first) == 8 and sum(r[3] for r in first) == 4
    run_questions(papers, questions, path, lambda prompts: ["other"] * len(prompts))
    assert sorted(map(tuple, read_responses(spark, path).collect())) == first
    more = questions.unionAll(spark.createDataFrame([(3, "How?")], "q_idx INT, question STRING"))
    run_questions(papers, more, path, lambda prompts: ["new"] * len(prompts))
    again = sorted(map(tuple, read_responses(spark, path).collect()))
    assert len(again) == 12 and [r for r in again if r[1] != 3] == first


def test_numeric_paper_ids(spark, questions, tmp_path):
    papers = spark.createDataFrame([(7, "a b"), (8, "c")], "paper_id BIGINT, text STRING")
    for _ in range(2):
        run_questions(papers, questions, f"{tmp_path}/r", lambda prompts: ["x"] * len(prompts))
    rows = spark.read.parquet(f"{tmp_path}/r").collect()
    assert sorted((r.paper_id, r.q_idx) for r in rows) == [(7, 1), (7, 2), (8, 1), (8, 2)]


def test_handlers(spark):
    register_handler("lines", lambda content: content.decode().splitlines()[1:])
    rows = [("a.pdf", b"%PDF\none\ntwo"), ("b.pdf", b"<html>"), ("c.pdf", b"%PDF\n\xff")]
    files = spark.createDataFrame(rows, "path STRING, content BINARY")
    got = extract_content(files, "lines").collect()
    good = sorted((r.path, r.page_no, r.text) for r in got if r.error is None)
    assert good == [("a.pdf", 1, "one"), ("a.pdf", 2, "two")]
    assert {r.path for r in got if r.error} == {"b.pdf", "c.pdf"}
    register_handler("bytes", lambda content: [content[:4]], output="image")
    assert extract_content(files.limit(1), "bytes").first().image == b"%PDF"


def test_unknown_handler(spark):
    with pytest.raises(ValueError, match="unknown content handler"):
        extract_content(spark.createDataFrame([], "path STRING, content BINARY"), "pdf2html")
    with pytest.raises(ValueError):
        register_handler("x", lambda c: [], output="sound")


def test_documents_read_back(spark):
    question = "Fill # Response\n\n---\n\nin"
    document = value(spark, render_answer(F.lit(12), F.lit(question), F.lit("a\n\n---\nb")))
    assert document == f"# Question 12\n\n{question}\n\n---\n\n# Response\n\na\n\n---\nb"
    row = parse_answers(spark.createDataFrame([(document,)], "value STRING")).first()
    assert (row.question, row.response) == (question, "a\n\n---\nb")


def test_no_data_flag(spark):
    df = spark.createDataFrame([(" NO USEFUL DATA\n",), ("NO USEFUL DATA here",), (None,)], "r STRING")
    assert [r[0] for r in df.select(has_data(F.col("r"))).collect()] == [False, True, False]


def references(spark, *entries):
    xml = f'<TEI xmlns="http://www.tei-c.org/ns/1.0"><listBibl>{"".join(entries)}</listBibl></TEI>'
    docs = spark.createDataFrame([("p", xml)], "paper_id STRING, xml STRING")
    return [tuple(r)[1:] for r in extract_references(docs).orderBy("pos").collect()], docs


def test_bibliography(spark):
    got, docs = references(
        spark,
        '<biblStruct xml:id="b0"><analytic><title level="a"> Ab &amp; <hi>cd</hi>\n</title>'
        '<idno type="DOI"> 10.1/x </idno></analytic><monogr><title>Journal</title></monogr></biblStruct>',
        "<biblStruct><monogr><title>Only title</title></monogr></biblStruct>",
        '<biblStruct><idno type="PMID">1</idno><idno type="DOI">10.1/y</idno></biblStruct>',
        "<biblStruct><note>neither</note></biblStruct>",
        "<biblStruct/>",
        '<biblStruct><title/><idno type="DOI">10.1/z</idno></biblStruct>',
        "<biblStruct><title>bad & broken</title></biblStruct>",
        "<biblStruct><title>bad <b>nesting</title></b></biblStruct>",
        '<biblStruct><title>last</title><idno type="DOI"/></biblStruct>',
    )
    assert got == [
        (0, "Ab & cd", "10.1/x"), (1, "Only title", None), (2, None, "10.1/y"),
        (4, "", "10.1/z"), (7, "last", ""),
    ]
    assert [r.pos for r in rejected_entries(docs).orderBy("pos").collect()] == [5, 6]


def test_nested_entries(spark):
    got, docs = references(
        spark,
        '<biblStruct><note><biblStruct><idno type="DOI">10.1/in</idno></biblStruct></note><idno type="DOI">10.1/out</idno></biblStruct>',
        "</biblStruct><biblStruct><title>never ends</title><biblStruct><title>a</title><biblStruct/></biblStruct>",
        "<!-- <biblStruct><title>no</title></biblStruct> --><biblStruct><title><![CDATA[</biblStruct>]]></title></biblStruct>",
        "<biblStruct q='\">'><title>quoted</title></biblStruct><biblStructs><title>other</title></biblStructs>",
    )
    assert got == [
        (0, None, "10.1/in"), (1, None, "10.1/in"), (3, "a", None), (4, "</biblStruct>", None), (5, "quoted", None),
    ]
    assert [(r.pos, r.error) for r in rejected_entries(docs).collect()] == [(2, "no end tag")]
    deep = "<biblStruct><title>d</title>" * 300 + "</biblStruct>" * 300
    assert len(references(spark, deep)[0]) == 300
    flat = "<biblStruct><title>f</title></biblStruct>" * 3000
    assert len(references(spark, flat)[0]) == 3000


def measured(spark, *responses):
    rows = [("p", 1, r) for r in responses]
    df = spark.createDataFrame(rows, "paper_id STRING, q_idx INT, response STRING")
    return extract_measurements(df)


def test_measurements(spark):
    got = measured(
        spark,
        "Here you are:\nPOLYMER_USED,DRUG,WATER_PH,CONCENTRATION,CAPACITY\n"
        "polyPhOx,Aspirin,8.20,10,0.1865\r\n NaN,Piroxicam,NaN,25,NaN \n\nbroken,line,1\n"
        '"poly(a,b)","1,2-dichloroethane",7,1e2,3',
        "NO USEFUL DATA",
        "In this study, however, water, salt, and polymers were used.",
        None,
    )
    rows = [tuple(r)[3:] for r in got.orderBy("line_no").collect()]
    assert rows == [
        ("polyPhOx", "Aspirin", 8.2, 10.0, 0.1865),
        (None, "Piroxicam", None, 25.0, None),
        ("poly(a,b)", "1,2-dichloroethane", 7.0, 100.0, 3.0),
    ]


def test_measurements_once_per_condition(spark):
    got = dedup_measurements(measured(spark, "a,b,1,2,NaN\na,b,1.0,2,NaN", "a,b,1,2,NaN\na,b,1,2,3"))
    assert sorted(((r.capacity, r.n_rows) for r in got.collect()), key=str) == [(3.0, 1), (None, 3)]


def test_run_comparison(spark):
    schema = "paper_id STRING, q_idx INT, response STRING"
    a = spark.createDataFrame([("p", 1, "x"), ("q", 1, "x"), ("r", 1, None), ("s", 1, "x"), ("s", 1, "x")], schema)
    b = spark.createDataFrame([("p", 1, "x"), ("q", 1, "y"), ("r", 1, None), ("t", 1, "x")], schema)
    compared = compare_runs(a, b)
    assert {r.paper_id: r.outcome for r in compared.collect()} == {
        "p": "same", "q": "different", "r": "same", "s": "only_a", "t": "only_b"
    }
    assert {r.outcome: r.n for r in run_agreement(compared).collect()} == {
        "same": 2, "different": 1, "only_a": 1, "only_b": 1
    }


def test_rollup_parts_hold_every_paper(spark, monkeypatch):
    rows = [(f"p{i}", 1 + (i % 3 == 0), f"r{i}", i % 5 == 0) for i in range(200)]
    responses = spark.createDataFrame(rows, "paper_id STRING, q_idx INT, response STRING, skipped BOOLEAN")
    monkeypatch.setattr(questions_module, "PAPERS_PER_PART", 10)
    for digits in (0, 1, 2, None):
        seen = []
        for part in question_rollup(responses, digits).collect():
            seen += [(p.paper_id, part.q_idx, p.response, False) for p in part.papers]
            seen += [(p, part.q_idx, None, True) for p in part.skipped_papers]
        assert sorted(seen, key=str) == sorted(((p, q, None if s else r, s) for p, q, r, s in rows), key=str)
    assert rollup_digits(responses, 133) == 0
    assert rollup_digits(responses, 10) == 1
    assert rollup_digits(responses, 1) == 2
    counts = {r.q_idx: (r.answered, r.skipped) for r in question_counts(responses).collect()}
    assert counts == {1: (107, 26), 2: (53, 14)}


def test_failures_are_kept_apart_and_tried_again(spark, shout, papers, questions, tmp_path):
    from snowlit.sources.files import read_failures

    def broken(prompts):
        raise ValueError("busy")

    path = f"{tmp_path}/responses"
    run_questions(papers, questions, path, broken)
    answered = read_responses(spark, path).collect()
    assert all(r.skipped and r.response is None for r in answered)  # papers without words only
    failed = read_failures(spark, path)
    assert failed.count() > 0 and {r.error for r in failed.collect()} == {"busy"}
    run_questions(papers, questions, path, shout)
    assert read_failures(spark, path).count() == 0
    keys = [(r.paper_id, r.q_idx) for r in read_responses(spark, path).collect()]
    assert len(keys) == len(set(keys)) == papers.count() * questions.count()


def test_unmarked_rows_count_as_answered(spark):
    responses = spark.createDataFrame([("p", 1, "a", None)], "paper_id STRING, q_idx INT, response STRING, skipped BOOLEAN")
    assert tuple(question_counts(responses).first()) == (1, 1, 0)
    assert len(question_rollup(responses, 0).first().papers) == 1


def test_page_answers_keep_their_page(spark, shout):
    rows = spark.createDataFrame([("p", 1, 1, "x"), ("p", 2, 1, "y")], "paper_id STRING, page_no INT, q_idx INT, prompt STRING")
    assert sorted((r.page_no, r.response) for r in answer(rows, shout).collect()) == [(1, "X"), (2, "Y")]


def test_repeated_and_missing_ids_do_not_depend_on_the_plan(spark, questions, either_way):
    papers = spark.createDataFrame([("p", "a"), ("p", "b"), (None, "c"), ("q", "d")], "paper_id STRING, text STRING")
    none = spark.createDataFrame([], "paper_id STRING, q_idx INT, response STRING, skipped BOOLEAN")
    n = questions.count()
    got = [r.paper_id for r in text_requests(papers, questions, none).collect()]
    assert sorted(got) == ["p"] * 2 * n + ["q"] * n


def test_page_runs_go_on_where_they_stopped(spark, questions, tmp_path):
    images = spark.createDataFrame(
        [("p", 1, b"a"), ("p", 2, b"b"), ("q", 1, b"c"), (None, 1, b"d"), ("r", 1, None)], "paper_id STRING, page_no INT, image BINARY"
    )
    path, pages = f"{tmp_path}/answers", f"{tmp_path}/pages"

    def half(bodies):
        if any("Page 2 of" in b for b in bodies):
            raise RuntimeError("busy")
        return ["first"] * len(bodies)

    run_page_questions(images, questions, path, pages, half)
    assert sorted((r.paper_id, r.q_idx) for r in read_responses(spark, path).collect()) == [
        ("q", 1), ("q", 2), ("r", 1), ("r", 2)
    ]
    run_page_questions(images, questions, path, pages, lambda bodies: ["second"] * len(bodies))
    got = {(r.paper_id, r.q_idx): r.response for r in read_responses(spark, path).collect()}
    assert len(got) == 6
    assert got["p", 1] == "--- Page 1 ---\nfirst\n\n--- Page 2 ---\nsecond" and got["q", 2] == "--- Page 1 ---\nfirst"


def test_pairs_of_repeated_and_missing_ids(spark, questions, either_way):
    papers = spark.createDataFrame([("p1", "x"), ("p1", "y"), (None, "z"), ("p2", "w")], "paper_id STRING, text STRING")
    done = spark.createDataFrame([("p1", 1)], "paper_id STRING, q_idx INT")
    assert pairs(pending_pairs(papers, questions, done)) == [("p1", 2), ("p1", 2), ("p2", 1), ("p2", 2)]
    assert pairs(text_requests(papers, questions, done)) == [("p1", 2), ("p1", 2), ("p2", 1), ("p2", 2)]


def test_missing_and_repeated_numbers(spark, either_way):
    papers = spark.createDataFrame([("p", "a"), ("q", "b")], "paper_id STRING, text STRING")
    asked = spark.createDataFrame([(1, "x"), (None, "y"), (2, "z"), (2, "w")], "q_idx INT, question STRING")
    done = spark.createDataFrame([("p", 1), ("q", 2), (None, 2), ("p", None)], "paper_id STRING, q_idx INT")
    expected = [("p", "w"), ("p", "z"), ("q", "x")]
    for df in (pending_pairs(papers, asked, done), text_requests(papers, asked, done)):
        assert sorted((r.paper_id, r.question) for r in df.collect()) == expected
    assert len(pending_pairs(papers, asked, done.limit(0)).collect()) == 6
    assert pending_pairs(papers, asked.limit(0), done).collect() == []
    assert len(pair_questions(papers, asked).collect()) == 8


@pytest.mark.parametrize("failed_first", [True, False])
def test_a_good_answer_beats_a_failed_one_of_the_same_key(spark, tmp_path, failed_first):
    rows = [("p", 1, None, True, "boom"), ("p", 1, "good", False, None), ("q", 1, None, True, "boom")]
    df = spark.createDataFrame(
        rows if failed_first else rows[::-1], "paper_id STRING, q_idx INT, response STRING, skipped BOOLEAN, error STRING"
    )
    write_responses(df.coalesce(1), f"{tmp_path}/a")
    assert [tuple(r) for r in read_responses(spark, f"{tmp_path}/a").collect()] == [("p", 1, "good", False)]
    assert [tuple(r) for r in read_failures(spark, f"{tmp_path}/a").collect()] == [("q", 1, "boom")]


def test_whole_answers_are_of_the_pages_there_are(spark):
    """Page 3 is gone, page 4 was never asked about; later it is."""
    images = spark.createDataFrame([("p", n, b"x") for n in (1, 2, 4, 4)], "paper_id STRING, page_no INT, image BINARY")
    schema = "paper_id STRING, page_no INT, q_idx INT, response STRING, skipped BOOLEAN"
    said = [("p", n, 1, f"r{n}", False) for n in (1, 2, 3)]
    assert whole_page_answers(spark.createDataFrame(said, schema), images).collect() == []
    said += [("p", 4, 1, "r4", False), ("p", 4, 1, "r4", False)][:1]
    whole = whole_page_answers(spark.createDataFrame(said, schema), images).collect()
    assert [r.response for r in whole] == ["--- Page 1 ---\nr1\n\n--- Page 2 ---\nr2\n\n--- Page 4 ---\nr4"]


def test_pieces_stay_near_their_limit():
    assert piece_ends([4, 4, 4, 30, 1], 10) == [(0, 2), (2, 3), (3, 5)]
    assert piece_ends([], 10) == [] and piece_ends([0, 0], 10) == [(0, 2)]


def test_bodies_in_several_pieces_are_answered_like_prompts(spark):
    # Texts of a megabyte: several pieces to a batch; some are missing, some fail.
    text = F.when(F.col("id") % 7 != 3, F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 1 << 20)))
    asked = spark.range(40, numPartitions=1).select(
        F.col("id").alias("paper_id"), F.lit(1).alias("q_idx"), text.alias("body")
    )

    def fn(texts):
        if any(t.startswith("5x") for t in texts):
            raise RuntimeError("busy")
        return [t[:2] for t in texts]

    want = sorted(map(tuple, answer(asked, fn, 3, prompt="body").collect()))
    assert len(want) == 40 and sum(r[4] == "busy" for r in want) == 1
    assert sorted(map(tuple, answer_bodies(asked, fn, 3).collect())) == want


def test_paper_files_do_not_grow_with_the_table(spark):
    papers = spark.range(2500, numPartitions=1).select(F.col("id").alias("paper_id"), F.col("id").cast("string").alias("text"))
    path = pdf_folder(SimpleNamespace(spark=spark, papers=papers))
    register_pages()
    pages = extract_content(scan_pdfs(spark, path), "marked pages")
    assert pages.count() == 2500
    assert pages.agg(F.max("page_no")).first()[0] <= 1000


def test_pages_of_a_large_file_leave_in_pieces(spark):
    register_handler("large pages", lambda content: [f"{i}" + "x" * (3 << 20) for i in range(8)])
    files = spark.createDataFrame([("a.pdf", b"%PDF")], "path STRING, content BINARY")
    got = extract_content(files, "large pages").select("page_no", F.left("text", F.lit(1)), F.length("text")).collect()
    assert sorted(map(tuple, got)) == [(i + 1, str(i), 1 + (3 << 20)) for i in range(8)]


def test_plain_entries_read_as_the_parser_reads_them(spark, monkeypatch):
    entries = [
        '<title>a</title><idno type="DOI">10.1/a</idno>', '<title n="x>y"> b </title ><idno type="DOI" >10.1/b</idno>',
        "<title/><title>c</title>", "<title>d <i>e</i> f</title>", '<idno type="DOI"/><idno type="DOI">10.1/c</idno>',
        '<idno type="doi">1</idno><idno type="DOI"><b>10.1/d</b></idno>', "<note>no title</note>", "<titles>x</titles>",
        "<a><b><c><title>g</title></c></b></a>", "<a><b><c><d><e><f><title>deep</title></f></e></d></c></b></a>",
        "<title>h &amp; i</title>", "<title>j\r\nk</title>", "<title><![CDATA[l]]></title>", '<title xmlns="u">m</title>',
        "<title>n</title></a>", "<title>o</Title>", '<title a="1" a="2">p</title>', "<title>q]]>r</title>", "<!-- <title>s</title> --><title>t</title>",
        "<title a='1'>u</title>", "<p:title>v</p:title>", "<title>w\x02</title>", "<title>é \U0001f600</title>", "<title>x</title><title>y</title>",
        '<idno n="<">z</idno>', "<title>a\nb</title>", "<idno\ntype=\"DOI\">10.1/e</idno>", "",
    ]
    docs = spark.createDataFrame([(i, f"<biblStruct>{e}</biblStruct>") for i, e in enumerate(entries)], "paper_id INT, xml STRING").repartition(4)

    def both():
        return [sorted(map(tuple, f(docs).collect())) for f in (extract_references, rejected_entries)]

    got = both()
    assert bibliography_entries(docs).filter("plain").count() >= 10
    monkeypatch.setattr("snowlit.operators.extract._plain_entry", lambda: "(?!)")
    assert got == both() and len(got[0]) > 15 and len(got[1]) > 4


def test_entries_without_oddities_need_no_xml_parser(spark):
    rows = [(i, f'<listBibl><biblStruct><title>t{i}</title><biblStruct n="a>b"/></biblStruct ></listBibl>') for i in range(5)]
    docs = spark.createDataFrame(rows, "paper_id INT, xml STRING")
    assert bibliography_entries(docs).filter("NOT plain").isEmpty()
