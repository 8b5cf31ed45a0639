"""The plans behind the queries: what is scanned, shuffled and never done."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.cases import CASES
from snowlit.functions.terms import has_topic
from snowlit.operators.citations import expand_citations
from snowlit.operators.extract import compare_runs
from snowlit.operators.pages import chunk_pages
from snowlit.operators.postings import a_and_b, cap_per_term, complement
from snowlit.operators.works import filter_open_access, filter_year, matching_works, pdf_url
from snowlit.plans.question_run import text_requests
from snowlit.sources.files import read_works, write_responses

QUERIES = {name: query for name, query in entry.queries().items() if name in CASES}
PACKAGE = pathlib.Path(__file__).resolve().parent.parent / "snowlit"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan(df))


@pytest.fixture
def no_broadcast(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_pairs_all_rows_or_runs_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    assert ("MapInPandas" in text) == (name in ("answers", "scanned_pages"))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_the_library_uses_dataframes_only():
    source = "\n".join(p.read_text() for p in PACKAGE.rglob("*.py") if "llm" not in p.parts)
    for banned in ("crossJoin", "localCheckpoint", ".rdd", "broadcast(", "toPandas", "parallelize"):
        assert banned not in source


@pytest.fixture(scope="module")
def works(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("works") / "t")
    spark.range(100).select(
        F.concat(F.lit("10.1/"), "id").alias("doi"),
        F.lit("t").alias("title"),
        F.struct(F.lit("u").alias("pdf_url"), F.lit("x").alias("other")).alias("primary_location"),
        (F.lit(1990) + F.col("id") % 30).cast("int").alias("publication_year"),
        (F.col("id") % 2 == 0).alias("is_oa"),
        F.array(F.lit("T1")).alias("topics"),
        F.array(F.lit("C1")).alias("concepts"),
        F.lit("long text").alias("text"),
    ).write.parquet(path)
    return path


def test_filters_and_columns_reach_the_scan(spark, works, conf):
    conf("spark.sql.maxMetadataStringLength", "2000")
    table = read_works(spark, works)
    text = plan(filter_open_access(filter_year(table, 2000, 2005)).select("doi"))
    assert "GreaterThanOrEqual(publication_year,2000)" in text
    assert "LessThanOrEqual(publication_year,2005)" in text
    assert "EqualTo(is_oa,true)" in text
    assert "ReadSchema: struct<doi:string,publication_year:int,is_oa:boolean>" in text


def test_only_the_nested_leaf_is_read(spark, works):
    text = plan(pdf_url(spark.read.parquet(works)).select("doi", "pdf_url"))
    assert "ReadSchema: struct<doi:string,primary_location:struct<pdf_url:string>>" in text


def test_a_search_is_one_scan_without_shuffle(spark, works):
    found = matching_works(read_works(spark, works), has_topic("T1") & ~has_topic("T2"), "polymer")
    assert plan(found).count("FileScan") == 1
    assert exchanges(found) == []


def test_reading_list_shuffles_each_table_once(spark, sf, no_broadcast):
    assert exchanges(QUERIES["reading_list"](spark, sf)) == ["hashpartitioning"] * 3


def test_set_operations_shuffle_each_side_once(spark, no_broadcast):
    a, b = (spark.range(9).select(F.col("id").cast("string").alias("doi"), F.lit(n).alias("n")) for n in (1, 2))
    for df in (a_and_b(a, b), complement(a, b)):
        assert exchanges(df) == ["hashpartitioning"] * 2


@pytest.mark.parametrize("name", ["saved_search_match", "saved_search_bans"])
def test_saved_searches_read_postings_once(spark, sf, name):
    from checks.cases import Tables

    t = Tables(spark, sf)
    df = QUERIES[name](spark, sf)
    assert len(re.findall(r"Exchange (?:hash|range|Single)", plan(df))) <= 5
    # The table under the postings is read for its two kinds of term, and again for the
    # list of searches where it is made from them.
    scans = plan(t.postings).count("FileScan")
    assert plan(df).count("FileScan") <= scans * (1 if name == "saved_search_match" else 3)


def test_capping_limits_groups_before_each_shuffle(spark, works):
    postings = read_works(spark, works).select(F.explode("topics").alias("term"), "doi")
    text = plan(cap_per_term(postings, 5))
    assert text.count("WindowGroupLimit") == 4  # partial and final, twice


def test_first_run_does_not_shuffle_text(spark, sf):
    from checks.cases import Tables

    t = Tables(spark, sf)
    requests = text_requests(t.papers, t.questions, t.answered.limit(0))
    text = plan(requests)
    assert "SortMergeJoin" not in text


def shuffled_columns(df):
    """The columns of each shuffle of a plan."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)


@pytest.mark.parametrize("first_run", [True, False])
def test_no_text_of_finished_papers_is_shuffled(spark, sf, conf, tmp_path, first_run):
    """Papers stored by id, half of them finished, and no broadcast to help."""
    from checks.cases import Tables
    from snowlit.sources.files import write_papers

    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.maxMetadataStringLength", "10000")
    conf("spark.sql.debug.maxToStringFields", "200")
    t = Tables(spark, sf)
    papers = write_papers(t.papers, f"papers_{tmp_path.name}", 8, f"{tmp_path}/papers")
    done = t.papers.filter("paper_id % 2 = 0").select("paper_id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("q_idx"))
    requests = text_requests(papers, t.questions, done.limit(0) if first_run else done, tasks=3)
    shuffles = shuffled_columns(requests)
    assert shuffles and not any(re.search(r"\btext#", s) for s in shuffles)
    # Contexts, of open papers alone, cross as they are, without prompts.
    assert any("context#" in s for s in shuffles) and not any("prompt#" in s for s in shuffles)
    n = t.papers.filter("true" if first_run else "paper_id % 2 = 1").count()
    assert requests.count() == n * t.questions.count()
    spark.sql(f"DROP TABLE papers_{tmp_path.name}")


def test_stored_answers_are_read_by_key_only(spark, tmp_path):
    path = f"{tmp_path}/responses"
    schema = "paper_id STRING, q_idx INT, response STRING, skipped BOOLEAN"
    write_responses(spark.createDataFrame([("p", 1, "x" * 100, False)], schema), path)
    from snowlit.sources.files import read_responses

    keys = read_responses(spark, path).select("paper_id", "q_idx")
    assert "ReadSchema: struct<paper_id:string,error:string>" in plan(keys)


def test_pages_are_shuffled_by_block_and_by_chunk(spark, sf, no_broadcast):
    from checks.cases import Tables

    text = plan(chunk_pages(Tables(spark, sf).page_text, 128))
    by = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    # Only block totals are ever brought together by paper alone.
    alone = [b for b in by if re.fullmatch(r"paper_id#\w+, \d+", b)]
    assert len(alone) == 1


def test_page_text_is_shuffled_twice(spark, no_broadcast):
    pages = spark.createDataFrame([("p", 0, "a b"), ("p", 1, "c"), (None, 0, "d")], "paper_id STRING, page_no INT, text STRING")
    chunks = chunk_pages(pages, 128)
    # Pages by block and pieces by chunk; the other three hold totals only.
    assert exchanges(chunks) == ["hashpartitioning"] * 5
    sorts = re.findall(r"Exchange hashpartitioning\(([^)]*)\).*\n.*(?:Project|Sort|Filter).*_text#", plan(chunks))
    assert len(sorts) == 1
    assert sorted(map(tuple, chunks.collect()), key=str) == [("p", 0, "a b c"), (None, 0, "d")]


def test_runs_are_compared_with_one_shuffle_and_sort_each(spark, no_broadcast):
    schema = "paper_id STRING, q_idx INT, response STRING"
    a = spark.createDataFrame([("p", 1, "x"), ("p", 1, "y"), (None, 1, "x"), ("q", None, None)], schema)
    b = spark.createDataFrame([("p", 1, "y"), (None, 1, "z"), ("r", None, "w")], schema)
    compared = compare_runs(a, b)
    text = plan(compared)
    assert exchanges(compared) == ["hashpartitioning"] * 2
    assert "SortAggregate" not in text and len(re.findall(r"[- ]Sort \[", text)) == 2
    assert sorted(map(tuple, compared.collect()), key=str) == sorted([
        ("p", 1, "y", "y", "same"), (None, 1, "x", "z", "different"),
        ("q", None, None, None, "only_a"), ("r", None, None, "w", "only_b"),
    ], key=str)


def test_a_hop_reads_citations_once_per_use(spark, works, no_broadcast):
    edges = spark.range(50).select(
        F.col("id").alias("src"), F.lit(1).alias("pos"), (F.col("id") + 1).alias("dst")
    )
    hop = expand_citations(spark.range(5).toDF("doi"), edges)
    assert "SortMergeJoin" in plan(hop)
    assert hop.count() == 5
