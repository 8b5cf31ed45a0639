"""Text and DOI columns against plain Python on the same values."""

import base64
import random
import re

import pytest
from pyspark.sql import functions as F

from snowlit.functions.doi import doi_key, is_pdf, is_valid_doi, term_kind, title_key
from snowlit.functions.text import (
    WHITESPACE,
    base64_text,
    chunk_words,
    estimate_tokens,
    squeeze,
    strip,
    word_count,
    words,
)
from snowlit.operators.pages import (
    assemble_parts,
    assemble_text,
    chunk_pages,
    chunk_text,
    contexts,
    join_chunks,
    number_rows,
)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    alphabet = "abcXYZ019_-.,;é漢ñ" + WHITESPACE * 2
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 300))) for _ in range(400)]
    return ["", " ", "\n", "a", WHITESPACE, f"{WHITESPACE}x{WHITESPACE}", "one two"] + made


def column(spark, texts, expression):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "i INT, t STRING")
    return [r[1] for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_whitespace_is_what_python_calls_whitespace():
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_words_and_counts(spark, texts):
    t = F.col("t")
    assert column(spark, texts, strip(t)) == [x.strip() for x in texts]
    assert column(spark, texts, words(t)) == [x.split() for x in texts]
    assert column(spark, texts, squeeze(t)) == [" ".join(x.split()) for x in texts]
    assert column(spark, texts, word_count(t)) == [len(x.split()) for x in texts]
    assert column(spark, texts, estimate_tokens(t)) == [len(x) // 4 for x in texts]


def test_null_text_has_no_words(spark):
    assert column(spark, [None], words(F.col("t"))) == [[]]
    assert column(spark, [None], word_count(F.col("t"))) == [0]


def test_title_key(spark, texts):
    def expected(title):
        kept = re.sub(r"[^\w\s-]", "", title)
        return re.sub(r"\s+", "_", kept)[:200]

    assert column(spark, texts, title_key(F.col("t"))) == [expected(x) for x in texts]
    assert column(spark, [None], title_key(F.col("t"))) == ["unknown"]


def test_base64_has_no_line_breaks(spark):
    data = ["x" * n for n in (0, 1, 57, 58, 200, 5000)]
    got = column(spark, data, base64_text(F.col("t").cast("binary")))
    assert got == [base64.b64encode(x.encode()).decode() for x in data]


def test_doi_columns(spark):
    given = [None, "", " 10.1/A ", "https://doi.org/10.1/a", "doi:10.1/a", "10.1016/S0(1)2"]
    assert column(spark, given, is_valid_doi(F.col("t"))) == [False, False, True, False, False, True]
    assert column(spark, given, doi_key(F.col("t"))) == [
        None, "", "10.1/a", "10.1/a", "doi:10.1/a", "10.1016/s0(1)2"
    ]
    assert column(spark, given, doi_key(F.col("t"), case_sensitive=True))[2] == "10.1/A"


def test_term_kind(spark):
    assert column(spark, ["T1", "C1", "poly", ""], term_kind(F.col("t"))) == [
        "topic", "concept", "keyword", "keyword"
    ]


def test_is_pdf(spark):
    rows = [(b"%PDF-1.7",), (b"<html>",), (b"",), (None,)]
    df = spark.createDataFrame(rows, "content BINARY")
    assert [r[0] for r in df.select(is_pdf(F.col("content"))).collect()] == [True, False, False, False]


def expected_chunks(text, size, most):
    split = text.split()
    count = -(-len(split) // size)
    if most is not None:
        count = min(most, count)
    return [" ".join(split[i * size : (i + 1) * size]) for i in range(count)]


@pytest.mark.parametrize("tokens,most", [(4, None), (12, None), (12, 2), (40, 1), (10_000, 3)])
def test_chunks(spark, texts, tokens, most):
    papers = spark.createDataFrame(list(enumerate(texts)), "paper_id INT, text STRING")
    got = {}
    for row in chunk_text(papers, tokens, most).orderBy("paper_id", "chunk_idx").collect():
        got.setdefault(row.paper_id, []).append(row.chunk)
    for i, text in enumerate(texts):
        assert got.get(i, []) == expected_chunks(text, tokens // 4, most)


@pytest.mark.parametrize("tokens,most", [(12, None), (12, 2), (10_000, 3)])
def test_contexts_are_joined_chunks(spark, texts, tokens, most):
    papers = spark.createDataFrame(list(enumerate(texts)), "paper_id INT, text STRING")
    inside = {r.paper_id: r.context for r in contexts(papers, tokens, most).collect()}
    grouped = {r.paper_id: r.context for r in join_chunks(chunk_text(papers, tokens, most)).collect()}
    for i, text in enumerate(texts):
        chunks = expected_chunks(text, tokens // 4, most)
        assert inside[i] == ("\n\n---\n\n".join(chunks) if chunks else None)
        assert grouped.get(i) == inside[i]


def test_chunk_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        chunk_words(3)
    papers = spark.createDataFrame([(1, "a")], "paper_id INT, text STRING")
    with pytest.raises(ValueError):
        chunk_text(papers, 3)


def one_big_paper():
    """Three papers; one holds most pages. Pages out of order, some empty."""
    rng = random.Random(3)
    pages = [("big", n, " ".join(f"w{n}_{i}" for i in range(rng.randrange(0, 9)))) for n in range(900)]
    pages += [("small", n, f"only {n}\n page ") for n in range(4)]
    pages += [("blank", 0, None), ("blank", 1, " \n")]
    rng.shuffle(pages)
    return pages


@pytest.mark.parametrize("most", [None, 5])
def test_chunks_from_pages_equal_chunks_from_text(spark, monkeypatch, most):
    from snowlit.operators import pages as module

    original = module.running_offset
    monkeypatch.setattr(
        module, "running_offset", lambda *a, **k: original(*a, **{**k, "block": 7})
    )
    made = one_big_paper()
    df = spark.createDataFrame(made, "paper_id STRING, page_no INT, text STRING").repartition(5)
    got = {(r.paper_id, r.chunk_idx): r.chunk for r in chunk_pages(df, 40, most).collect()}
    expected = {}
    for paper in ("big", "small", "blank"):
        text = "\n\n".join(t for p, _, t in sorted(made, key=lambda m: m[1]) if p == paper and t)
        for i, chunk in enumerate(expected_chunks(text, 10, most)):
            expected[paper, i] = chunk
    assert got == expected


def test_page_text_in_parts(spark):
    made = one_big_paper()
    df = spark.createDataFrame(made, "paper_id STRING, page_no INT, text STRING")
    whole = {r.paper_id: r.text for r in assemble_text(df).collect()}
    parts = {}
    for r in assemble_parts(df, 50).orderBy("paper_id", "part").collect():
        parts.setdefault(r.paper_id, []).append(r.text)
    assert {p: "\n\n".join(t) for p, t in parts.items()} == whole
    assert set(whole) == {"big", "small", "blank"}


def test_numbers_run_across_blocks(spark):
    rows = [("a", n * 1000, t) for n in range(30) for t in ("x", "y")] + [("b", 5, "z")]
    df = spark.createDataFrame(rows, "k STRING, p INT, t STRING").repartition(4)
    got = {(r.k, r.p, r.t): r.number for r in number_rows(df, ["k"], "p", ["t"]).collect()}
    expected = {row: i + 1 for i, row in enumerate(sorted(r for r in rows if r[0] == "a"))}
    assert got == expected | {("b", 5, "z"): 1}
