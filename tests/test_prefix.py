"""Running sums over groups of any size, in any order."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from snowlit.operators import pages
from snowlit.operators.prefix import running_sums


@pytest.fixture(scope="module")
def crowd(spark):
    """A third of the rows share one key, which is NULL, and one position."""
    hot = F.col("id") % 3 == 0
    return spark.range(60_000).select(
        F.when(~hot, F.col("id") % 400).alias("paper_id"),
        F.when(hot, F.lit(7)).otherwise((F.col("id") / 400).cast("int")).alias("page_no"),
        (F.col("id") % 100).alias("tie"), F.lit("x").alias("_row"),
    )


def spread(df):
    """The largest partition of a result, against the mean of those that have rows."""
    sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / (sum(sizes) / len(sizes))


def test_a_third_of_the_rows_on_one_position_spreads(crowd, monkeypatch, conf):
    conf("spark.sql.adaptive.enabled", "false")
    monkeypatch.setattr(pages, "ROWS_PER_BLOCK", 2_000)
    numbered = pages.number_rows(crowd, ["paper_id"], "page_no", ["tie"])
    assert numbered.columns == [*crowd.columns, "number"]
    assert spread(numbered) < 3
    papers = defaultdict(list)
    for r in numbered.collect():
        papers[r.paper_id].append((r.number, (r.page_no, r.tie)))
    assert len(papers[None]) == 20_000
    for rows in papers.values():
        rows.sort()
        assert [n for n, _ in rows] == list(range(1, len(rows) + 1))
        assert [o for _, o in rows] == sorted(o for _, o in rows)


def test_sums_do_not_depend_on_how_groups_are_cut(crowd):
    amounts = {"n": F.lit(1), "total": F.col("tie") - 50}
    order = ["page_no", F.col("tie") * -1]
    # Equal rows may change places; their sums as a whole may not.
    got = [
        sorted(map(str, running_sums(crowd, ["paper_id"], order, amounts, rows).select("paper_id", "page_no", "tie", "n", "total").collect()))
        for rows in (3_000, 10**6)
    ]
    assert got[0] == got[1]


def test_without_keys_all_rows_are_one_group(spark):
    df = spark.createDataFrame([(None,), (3,), (1,), (2,)], "v INT")
    for rows in (1, 10**6):
        got = {r.v: r.before for r in running_sums(df.withColumn("a.b", F.lit(1)), [], ["v"], {"before": F.coalesce("v", F.lit(10))}, rows).collect()}
        assert got == {None: 0, 1: 10, 2: 11, 3: 13}
    assert running_sums(df.limit(0), [], ["v"], {"before": F.lit(1)}).collect() == []
