"""Resolution, accounting and the citation graph against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from snowlit.operators import skew
from snowlit.operators.citations import (
    citation_counts,
    expand_citations,
    frontier_ok,
    snowball,
    snowball_walks,
)
from snowlit.operators.fanout import fan_out
from snowlit.operators.resolve import (
    classify_download,
    reference_counts,
    reference_totals,
    resolve_dois,
    status_counts,
    unresolved_dois,
    write_catalogue,
)
from snowlit.operators.skew import hot_keys, split_join
from snowlit.operators.worklist import merge_worklists


def edge_rows():
    """A hub, a cycle, a self-citation, copies of one edge, and random links."""
    rng = random.Random(11)
    edges = [("hub", i, f"n{i}") for i in range(400)]
    edges += [("a", 1, "b"), ("b", 1, "c"), ("c", 1, "a"), ("s", 1, "s"), ("n1", 1, None)]
    edges += [("a", 2, "hub")] * 300
    edges += [(f"n{rng.randrange(400)}", i, f"n{rng.randrange(400)}") for i in range(300)]
    return edges


@pytest.fixture(scope="module")
def citations(spark):
    return spark.createDataFrame(edge_rows(), "src STRING, pos INT, dst STRING").repartition(6)


def seeds(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "doi STRING")


def brute_levels(start, depth, usable=None):
    edges = {(s, d) for s, _, d in edge_rows() if d is not None}
    found, frontier = {}, set(start)
    for level in range(1, depth + 1):
        if usable is not None:
            frontier &= usable
        frontier = {d for s, d in edges if s in frontier} - set(found)
        found |= {d: level for d in frontier}
    return found


def levels(df):
    return {r.doi: r.level for r in df.collect()}


@pytest.fixture
def small_splits(monkeypatch):
    """Treat a key as hot from 20 rows on."""
    monkeypatch.setattr(skew, "ROWS_PER_SPLIT", 20)


@pytest.mark.parametrize("start", [("a",), ("a", "n5"), ("s",), ("nobody",)])
@pytest.mark.parametrize("depth", [0, 1, 2, 3, 9])
def test_snowball(spark, citations, start, depth):
    assert levels(snowball(seeds(spark, *start, start[0]), citations, depth)) == brute_levels(start, depth)


def test_snowball_splits_hubs(spark, citations, conf, small_splits):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert levels(snowball(seeds(spark, "a"), citations, 4)) == brute_levels(["a"], 4)


def test_snowball_expands_only_downloaded(spark, citations):
    log = spark.createDataFrame(
        [("a", "SUCCESS"), ("a", "ERROR"), ("hub", "NOT_OPEN_ACCESS"), ("b", "SUCCESS")],
        "doi STRING, status STRING",
    )
    got = levels(snowball(seeds(spark, "a"), citations, 5, log))
    assert got == brute_levels(["a"], 5, {"a", "b"}) == {"b": 1, "hub": 1, "c": 2}


def test_deeper_contains_shallower(spark, citations):
    one, two = (levels(snowball(seeds(spark, "hub"), citations, d)) for d in (1, 2))
    assert one.items() <= two.items()


def test_walks_count_repeats(spark, citations, small_splits):
    edges = [(s, d) for s, _, d in edge_rows() if d is not None]
    frontier, expected = Counter({"a": 2}), {}
    for level in (1, 2, 3):
        step = Counter()
        for s, d in edges:
            step[d] += frontier[s]
        frontier = Counter({k: v for k, v in step.items() if v})
        expected |= {(k, level): v for k, v in frontier.items()}
    got = {(r.doi, r.level): r.n for r in snowball_walks(seeds(spark, "a", "a"), citations, 3).collect()}
    assert got == expected
    assert got["n7", 2] >= 600


def test_hop_keeps_repeats(spark, citations, small_splits):
    got = Counter(map(tuple, expand_citations(seeds(spark, "a", "a", "n1"), citations).collect()))
    expected = Counter()
    for edge in edge_rows():
        if edge[2] is not None:
            expected[edge] += {"a": 2, "n1": 1}.get(edge[0], 0)
    assert got == +expected


def test_hot_keys_and_splits(spark):
    many = spark.createDataFrame(
        [("hot", i) for i in range(95)] + [("warm", i) for i in range(10)] + [(None, 1)], "k STRING, i INT"
    )
    hot = hot_keys(many, "k", 10)
    assert [tuple(r) for r in hot.collect()] == [("hot", 10)]
    assert hot_keys(many, "k", 100) is None
    one = spark.createDataFrame([("hot", "H"), ("cold", "C")], "k STRING, v STRING")
    for how in ("inner", "left"):
        plain = Counter(map(tuple, many.join(one, "k", how).select("k", "i", "v").collect()))
        split = split_join(many, one, "k", ["i"], hot, how)
        assert Counter(map(tuple, split.select("k", "i", "v").collect())) == plain


def test_hot_key_is_spread_over_tasks(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    many = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("i"))
    one = spark.createDataFrame([("hot", "H")], "k STRING, v STRING")
    joined = split_join(many, one, "k", ["i"], hot_keys(many, "k", 100))
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000
    assert max(sizes) < 2500  # one task would hold all 4000 without splitting


def test_fan_out_pairs_everything(spark, conf):
    large, small = spark.range(50).toDF("a"), spark.range(7).toDF("b")
    expected = {(a, b) for a in range(50) for b in range(7)}
    for threshold in ("10m", "-1"):
        conf("spark.sql.autoBroadcastJoinThreshold", threshold)
        rows = fan_out(large, small, ["a"], 5).collect()
        assert len(rows) == 350 and {(r.a, r.b) for r in rows} == expected


def test_frontier_ok(spark):
    log = spark.createDataFrame([("a", "SUCCESS"), ("a", "SUCCESS"), ("b", "ERROR")], "doi STRING, status STRING")
    assert [r.doi for r in frontier_ok(seeds(spark, "a", "b", "c"), log).collect()] == ["a"]


def test_citation_counts_ignore_copies(spark, citations):
    expected = Counter(d for _, d in {(s, d) for s, _, d in edge_rows() if d is not None})
    assert {r.doi: r.cited_by for r in citation_counts(citations).collect()} == expected


WORK = "doi STRING, title STRING, primary_location STRUCT<pdf_url: STRING>"


@pytest.fixture(scope="module")
def tables(spark):
    works = spark.createDataFrame(
        [
            ("10.1/OK", "A study: of (things)", ("u",)), ("10.1/ok", "A study: of (things)", ("u",)),
            ("10.1/closed", "c", None), ("10.1/empty", "e", ("",)), ("10.1/nourl", "n", (None,)),
            ("10.1/html", "h", ("u",)), ("10.1/down", "d", ("u",)), ("10.1/never", "v", ("u",)),
            ("10.1/untitled", None, ("u",)), (None, "nothing", ("u",)),
        ],
        WORK,
    )
    crawl = spark.createDataFrame(
        [
            ("10.1/ok", 500, False), ("https://doi.org/10.1/OK", 200, True), ("10.1/html", 200, False),
            ("10.1/down", 404, True), ("10.1/untitled", 200, True), ("10.1/unknown", 200, True),
        ],
        "doi STRING, http_status INT, body_is_pdf BOOLEAN",
    )
    return works, crawl


EXPECTED = {
    " https://doi.org/10.1/ok ": ("SUCCESS", "A_study_of_things.pdf"),
    "10.1/closed": ("NOT_OPEN_ACCESS", None), "10.1/empty": ("NOT_OPEN_ACCESS", None),
    "10.1/nourl": ("NOT_OPEN_ACCESS", None), "10.1/html": ("ERROR", None),
    "10.1/down": ("ERROR", None), "10.1/never": ("ERROR", None),
    "10.1/untitled": ("SUCCESS", "unknown.pdf"), "10.1/unknown": ("ERROR", None),
    "doi:10.1/ok": ("ERROR", None), "": ("ERROR", None), None: ("ERROR", None),
}


def test_classification(spark, tables):
    works, crawl = tables
    dois = spark.createDataFrame(list(enumerate(EXPECTED)), "pos INT, doi STRING")
    got = {r.doi: (r.status, r.path) for r in classify_download(dois, works, crawl).collect()}
    assert got == EXPECTED


def test_classification_of_a_worklist(spark, tables):
    works, crawl = tables
    dois = spark.createDataFrame(list(enumerate(EXPECTED)), "pos INT, doi STRING")
    got = {r.doi_key: (r.status, r.path) for r in classify_download(merge_worklists(dois), works, crawl).collect()}
    assert got == {
        (k.strip().removeprefix("https://doi.org/")): v for k, v in EXPECTED.items() if k
    }


def test_repeated_dois_keep_their_rows(spark, tables, small_splits):
    works, _ = tables
    rows = [(i, "10.1/ok") for i in range(150)] + [(1000 + i, None) for i in range(150)] + [(5000, "10.1/closed")]
    got = resolve_dois(spark.createDataFrame(rows, "pos INT, doi STRING"), works).select("pos", "work.title")
    assert Counter(r.title for r in got.collect()) == {"A study: of (things)": 150, None: 150, "c": 1}
    assert got.select("pos").distinct().count() == 301


def test_catalogue_is_stored_once_and_not_shuffled_again(spark, tables, conf):
    from snowlit.operators.resolve import write_catalogue

    works, crawl = tables
    spark.sql("CREATE DATABASE IF NOT EXISTS trial")
    stored = write_catalogue(works, "trial.works", 4)
    try:
        assert stored.count() == 8
        dois = spark.createDataFrame(list(enumerate(EXPECTED)), "pos INT, doi STRING")
        got = {r.doi: (r.status, r.path) for r in classify_download(dois, stored, crawl).collect()}
        assert got == EXPECTED
        assert unresolved_dois(dois, stored).first().doi_key == "10.1/unknown"
        conf("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = resolve_dois(merge_worklists(dois), stored)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # the worklist's own
    finally:
        spark.sql("DROP DATABASE trial CASCADE")


def test_stored_citations_are_not_shuffled_again(spark, conf, monkeypatch):
    from snowlit.operators import skew
    from snowlit.operators.citations import read_citations, snowball_walks, write_citations

    monkeypatch.setattr(skew, "ROWS_PER_SPLIT", 5)
    edges = spark.createDataFrame(
        [("10.1/HUB", i, f"10.1/{i}") for i in range(23)] + [("10.1/3", 0, "10.1/x"), ("10.1/x", 0, "10.1/hub"), ("10.1/4", 0, None)],
        "src STRING, pos INT, dst STRING",
    )
    seeds = spark.createDataFrame([("10.1/hub",)], "doi STRING")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sql("CREATE DATABASE IF NOT EXISTS graphs")
    write_citations(edges, "graphs.citations", 4)
    try:
        stored = read_citations(spark, "graphs.citations")
        assert stored.hot.count() == 1 and stored.edges.select("_split").distinct().count() > 1
        for run in (lambda e: snowball(seeds, e, depth=None), lambda e: snowball_walks(seeds, e, depth=4)):
            assert sorted(map(tuple, run(stored).collect())) == sorted(map(tuple, run(edges).collect()))
        plan = stored.of(seeds)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3  # the frontier's only
        assert "Bucketed: true" in plan
    finally:
        spark.sql("DROP DATABASE graphs CASCADE")


@pytest.mark.parametrize("hubs", [False, True])
def test_levels_shuffle_only_what_they_cite(spark, citations, conf, monkeypatch, hubs):
    """From level 2 on neither edges, nor earlier levels, nor downloads are shuffled."""
    from snowlit.operators import citations as module

    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    if hubs:
        monkeypatch.setattr(skew, "ROWS_PER_SPLIT", 20)
    plans = []
    original = module._next_level

    def seen(*tables):
        df = original(*tables)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(module, "_next_level", seen)
    log = spark.createDataFrame([(n, "SUCCESS") for n in ("a", "b", "c", "hub")], "doi STRING, status STRING")
    for given in (None, log):
        plans.clear()
        snowball(seeds(spark, "a"), citations, 4, given).collect()
        for plan in plans[1:]:
            # What is cited; and the frontier and list of hubs, where there are hubs.
            assert plan.count("Exchange hashpartitioning") == (3 if hubs else 1), plan


def test_unresolved(spark, tables):
    dois = spark.createDataFrame([("10.1/OK",), ("10.9/x",), ("10.9/X ",), ("bad",), (None,)], "doi STRING")
    assert [r.doi_key for r in unresolved_dois(dois, tables[0]).collect()] == ["10.9/x"]


def test_status_counts_show_zero(spark):
    log = spark.createDataFrame([("SUCCESS",), ("SUCCESS",), ("ERROR",)], "status STRING")
    assert {r.status: r.n for r in status_counts(log).collect()} == {
        "SUCCESS": 2, "NOT_OPEN_ACCESS": 0, "ERROR": 1
    }
    assert {r.n for r in status_counts(log.limit(0)).collect()} == {0}


def test_reference_counts(spark):
    refs = spark.createDataFrame(
        [("p", "10.1/a"), ("p", "10.1/a"), ("p", None), ("q", "10.1/b")], "paper_id STRING, doi STRING"
    )
    assert {tuple(r) for r in reference_counts(refs).collect()} == {("p", 3, 2, 1), ("q", 1, 1, 1)}
    assert tuple(reference_totals(refs).first()) == (4, 3, 2)


def test_the_fullest_copy_of_a_work_wins(spark):
    from snowlit.operators.resolve import unique_works

    schema = "doi STRING, title STRING, primary_location STRUCT<pdf_url: STRING>"
    works = spark.createDataFrame([("10.1/a", None, None), ("10.1/A", "T", ("http://u",)), ("10.1/a", "S", (None,))], schema)
    best = unique_works(works, ("title", "primary_location")).first().work
    assert (best.title, best.primary_location.pdf_url) == ("T", "http://u")


def test_empty_and_other_case_dois_in_counts(spark):
    refs = spark.createDataFrame([("p", ""), ("p", "10.1/A"), ("p", "10.1/a"), ("p", None)], "paper_id STRING, doi STRING")
    assert tuple(reference_counts(refs).first()) == ("p", 4, 2, 1)


def test_spellings_of_a_doi_are_one_work(spark):
    edges = spark.createDataFrame(
        [("10.1/a", 1, "10.1/B"), ("10.1/b", 1, " https://doi.org/10.1/C"), ("10.1/A", 2, ""), ("10.1/c", 1, "10.1/b")],
        "src STRING, pos INT, dst STRING",
    )
    assert levels(snowball(seeds(spark, "10.1/A"), edges, depth=None)) == {"10.1/b": 1, "10.1/c": 2}
    assert levels(snowball(seeds(spark, "10.1/A"), edges, None, case_sensitive=True)) == {}
    log = spark.createDataFrame([("10.1/A", "SUCCESS")], "doi STRING, status STRING")
    assert levels(snowball(seeds(spark, "10.1/a"), edges, None, log)) == {"10.1/b": 1}
    assert [r.doi for r in frontier_ok(seeds(spark, "https://doi.org/10.1/a", "10.1/b"), log).collect()] == ["https://doi.org/10.1/a"]
    assert {r.doi: r.cited_by for r in citation_counts(edges).collect()} == {"10.1/b": 2, "10.1/c": 1}
    hop = expand_citations(seeds(spark, "10.1/B"), edges)
    assert [tuple(r) for r in hop.collect()] == [("10.1/b", 1, " https://doi.org/10.1/C")]


def test_a_chain_of_any_length_is_followed(spark):
    edges = spark.range(60).select(F.col("id").alias("src"), F.lit(1).alias("pos"), (F.col("id") + 1).alias("dst"))
    got = snowball(spark.createDataFrame([(0,)], "doi BIGINT"), edges, depth=None)
    assert levels(got) == {i: i for i in range(1, 61)}


def test_walk_counts_that_no_long_holds_are_null(spark):
    edges = spark.createDataFrame([("a", 1, "a")] * 2**16, "src STRING, pos INT, dst STRING")
    got = snowball_walks(seeds(spark, "a"), edges, 5).collect()
    assert {r.level: r.n for r in got} == {1: 2**16, 2: 2**32, 3: 2**48, 4: None, 5: None}


def test_a_worklist_that_keeps_spellings_is_resolved(spark):
    from snowlit.operators.worklist import merge_worklists

    works = spark.createDataFrame([("10.1/a", "T")], "doi STRING, title STRING")
    refs = spark.createDataFrame([("10.1/A",), ("10.1/a",)], "doi STRING")
    found = resolve_dois(merge_worklists(refs, case_sensitive=True), works, ["title"])
    assert sorted((r.doi, r.work.title) for r in found.collect()) == [("10.1/A", "T"), ("10.1/a", "T")]


def test_a_column_called_doi_key_is_just_a_column(spark, tmp_path):
    dois = spark.createDataFrame([("10.1/a", "other"), ("10.1/A", None), ("x", "10.1/a")], "doi STRING, doi_key STRING")
    works = spark.createDataFrame(
        [("10.1/a", "T", ("u",), "wrong"), ("10.1/A", "T", ("u",), "10.1/b")],
        "doi STRING, title STRING, primary_location STRUCT<pdf_url: STRING>, doi_key STRING",
    )
    got = sorted((r.doi, r.doi_key, r.work and r.work.title) for r in resolve_dois(dois, works, ["title"]).collect())
    assert got == [("10.1/A", None, "T"), ("10.1/a", "other", "T"), ("x", "10.1/a", None)]
    assert unresolved_dois(dois, works).collect() == []
    crawl = spark.createDataFrame([("10.1/a", 200, True)], "doi STRING, http_status INT, body_is_pdf BOOLEAN")
    log = classify_download(dois, works, crawl)
    assert log.columns == ["doi", "doi_key", "status", "path"]
    assert sorted(r.status for r in log.collect()) == ["ERROR", "SUCCESS", "SUCCESS"]
    stored = write_catalogue(works, f"keyed_{tmp_path.name}", 2)
    assert resolve_dois(merge_worklists(dois), stored, ["title"]).filter("work IS NULL").count() == 1
    merge_worklists(dois).write.parquet(f"{tmp_path}/list")
    again = spark.read.parquet(f"{tmp_path}/list")
    assert "Window" not in classify_download(again, stored, crawl)._jdf.queryExecution().toString()
    assert classify_download(again, stored, crawl).filter("status = 'SUCCESS'").count() == 1
    spark.sql(f"DROP TABLE keyed_{tmp_path.name}")
