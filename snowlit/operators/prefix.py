"""Running sums along groups of any size.

A group of ordinary size is one window. A group with more rows than one task should sort
is dealt over ranges of its order: each range sums up its rows, a running total over
the ranges gives where each starts, and the positions inside a range follow. The order
ends in a hash of the whole row and in a row number, so rows that are equal in all that they
are ordered by, and even copies of one row, are dealt over several ranges too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snowlit.checkpoints import work_path, write_step
from snowlit.operators.keys import plain_key

# Rows of one group that a single task is asked to sort.
ROWS_PER_PART = 1_000_000

# Ranges for each shuffle partition; a few, so that hashing them spreads well.
RANGES_PER_PLACE = 4


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def comparable(kind: T.DataType) -> bool:
    """Whether values of the type have a hash and an order."""
    if isinstance(kind, T.ArrayType):
        return comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(comparable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    amounts: Mapping[str, Column],
    rows_per_group: int | None = None,
) -> DataFrame:
    """Add, under each name of ``amounts``, the sum of that amount (whole numbers) over the
    earlier rows of the same ``keys``, in ascending ``order``, NULL first.

    NULL keys are a group like others; without keys all rows are one. Which of several rows
    that are equal in ``order`` comes first is not defined. The sizes of the groups are counted
    when this is called; where one has more than ``rows_per_group`` rows, the rows of such
    groups are written once, dealt by range. Columns may have any names.
    """
    spark = df.sparkSession
    rows_per_group = rows_per_group or ROWS_PER_PART
    plain = [c for name in keys for c in plain_key(name, df.schema[name].dataType, df.schema[name].nullable)]
    plain = plain or [F.lit(0)]
    by, along = [f"_k{i}" for i in range(len(plain))], [f"_o{i}" for i in range(len(order))]
    given, summed = [f"_a{i}" for i in range(len(amounts))], [f"_s{i}" for i in range(len(amounts))]
    rows = df.select(
        *[c.alias(n) for c, n in zip(plain, by)],
        *[(quoted(c) if isinstance(c, str) else c).alias(n) for c, n in zip(order, along)],
        *[c.cast("bigint").alias(n) for c, n in zip(amounts.values(), given)],
        F.struct(*[quoted(c) for c in df.columns]).alias("_row"),
    )

    def summing(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
        before = Window.partitionBy(*groups).orderBy(*along).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumns({s: F.coalesce(F.sum(a).over(before), F.lit(0)) for a, s in zip(given, summed)})

    def result(rows: DataFrame) -> DataFrame:
        return rows.select("_row.*", *[F.col(s).alias(name) for s, name in zip(summed, amounts)])

    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_group)
    large = write_step(sizes, work_path(spark, "large-groups"))
    total = large.agg(F.sum("_n")).first()[0]
    if total is None:
        return result(summing(rows, by))

    small = result(summing(rows.join(large, by, "left_anti"), by))
    places = max(RANGES_PER_PLACE * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_PART))
    fields = [F.col("_row")[f.name] for f in df.schema if comparable(f.dataType)]
    dealt = (
        rows.join(large.select(*by), by, "left_semi")
        .withColumns({"_hash": F.xxhash64(*fields) if fields else F.lit(0), "_copy": F.monotonically_increasing_id()})
        .repartitionByRange(places, *by, *along, "_hash", "_copy")
        .withColumn("_part", F.spark_partition_id())
        .drop("_hash", "_copy")
    )
    # Written, because a range is sampled anew whenever it is planned.
    dealt = write_step(dealt, work_path(spark, "dealt-rows"))
    totals = dealt.groupBy(*by, "_part").agg(*[F.sum(a).alias(a) for a in given])
    parts = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *by, "_part", *[F.coalesce(F.sum(a).over(parts), F.lit(0)).alias(f"_b{i}") for i, a in enumerate(given)]
    )
    inside = summing(dealt, [*by, "_part"]).join(starts, [*by, "_part"])
    inside = inside.withColumns({s: F.col(s) + F.col(f"_b{i}") for i, s in enumerate(summed)})
    return small.unionByName(result(inside))
