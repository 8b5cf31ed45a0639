"""Shares of sources, epochs and the order in which documents are taken."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import clashing
from snowlit.llm import mixing


def shares(sizes, weights=(5, 2, 1), most=3):
    """Sources in order, null last, to their targets, reshared one round at a time."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else weight[s] * rest / share for s in names}
        above = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def checked(rows, most=3):
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= most * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
    assert targets == pytest.approx(shares(sizes), rel=1e-12)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.5
        # Whole epochs first: within a source one document at most is cut.
        epochs = {r.taken // r.size for r in rows if r.source == s and r.size}
        assert max(epochs, default=0) - min(epochs, default=0) <= 1
        assert sum(1 for r in rows if r.source == s and r.size and r.taken % r.size) <= 1


def test_shares_on_the_table(documents):
    rows = mixing.mix(documents, keep=["doc_id", "source"]).collect()
    assert len(rows) == documents.count()
    checked(rows)


def test_small_sources_stop_at_three_times_their_size(spark):
    sizes = {"a": 10, "b": 400, "c": 5, "d": 30, "é": 700, None: 60}
    rows = [(i, "w " * (n // 5), s) for s, n in sizes.items() for i in range(5)]
    docs = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id BIGINT, text STRING, source STRING")
    got = mixing.mix(docs).collect()
    checked(got)
    assert {r.taken for r in got if r.source == "a"} == {6} and {r.target for r in got if r.source == "a"} == {30.0}


def test_large_sources_give_the_same_mix(documents):
    cut = mixing.mix(documents, keep=["doc_id"], rows_per_group=3)
    whole = mixing.mix(documents, keep=["doc_id"])
    assert sorted(cut.collect()) == sorted(whole.collect()) == sorted(mixing.mix(documents.repartition(7), keep=["doc_id"]).collect())


def test_smallest_keys_are_taken_first(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("w").alias("text"),
        F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0).alias("q"),
    )
    rows = mixing.mix(docs, quality=F.col("q"), budget=800).collect()
    assert sum(r.taken for r in rows) == 800
    # Keys below t = 0.0953 are expected to be 800: 2000 (1 - exp(-4 t)) heavy and 2000 (1 - exp(-t)) others.
    heavy = sum(r.taken for r in rows if r.q == 4.0)
    assert abs(heavy - 2000 * (1 - math.exp(-4 * 0.0953))) < 50


def test_odd_rows(odd, none):
    got = mixing.mix(clashing(odd).withColumns({n: F.lit("x") for n in ("size", "group", "key", "tie", "before", "_row", "target", "weight")}))
    rows = got.collect()
    assert len(rows) == odd.count()
    checked(rows)
    assert {r.taken for r in rows if r.doc_id in (None, 2, 3)} == {0}
    assert mixing.mix(none).collect() == []
    assert {r.taken for r in mixing.mix(odd.filter("doc_id IN (2, 3)")).collect()} == {0}
    bad = mixing.mix(odd, quality=F.when(F.col("doc_id") > 4, F.lit(-1.0))).collect()
    checked(bad)
