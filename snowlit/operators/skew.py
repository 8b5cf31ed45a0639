"""Joins in which one key may hold a large share of the rows.

Runtime skew handling splits a hot partition only where both join inputs come
straight from a shuffle; an aggregate or another join in between rules it out. So
the hot keys are measured, and those keys alone are dealt over several sub-keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.checkpoints import work_path, write_step

# Rows of one key that a single task is asked to join.
ROWS_PER_SPLIT = 1_000_000


def hot_keys(df: DataFrame, key: str, rows_per_split: int | None = None) -> DataFrame | None:
    """``(key, splits)`` of the keys with more rows than one split should have, or
    None if there are none.

    At most one key per ``rows_per_split`` rows of ``df``. Counted with combining
    before the shuffle and written out, so later plans know how small it is.
    """
    rows_per_split = rows_per_split or ROWS_PER_SPLIT
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > rows_per_split).select(
        F.col(key).alias("_hot"),
        F.ceil(F.col("_n") / F.lit(rows_per_split)).cast("int").alias("_splits"),
    )
    hot = write_step(hot, work_path(df.sparkSession, "hot-keys"))
    return None if hot.isEmpty() else hot


def split_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    spread: Sequence[str],
    hot: DataFrame | None,
    how: str = "inner",
) -> DataFrame:
    """Join on ``key``, where ``many`` has any number of rows per key and ``one`` few.

    ``hot`` comes from :func:`hot_keys` of ``many``. Rows of a hot key are dealt over
    its splits by a hash of the ``spread`` columns, and the matching rows of ``one``
    are copied once per split; all other rows are joined as usual. Without hot keys
    this is a plain join. ``how`` is inner or left.
    """
    if hot is None:
        return many.join(one, key, how)
    splits = F.coalesce("_splits", F.lit(1))
    dealt = (
        many.join(hot, F.col(key) == F.col("_hot"), "left")
        .withColumn("_split", F.pmod(F.xxhash64(*spread), splits).cast("int"))
        .drop("_hot", "_splits")
    )
    return join_dealt(dealt, one, key, hot, how)


def join_dealt(dealt: DataFrame, one: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """The join of :func:`split_join` where ``dealt`` has its ``_split`` already."""
    copied = (
        one.join(hot, F.col(key) == F.col("_hot"), "left")
        .withColumn("_split", F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)))
        .drop("_hot", "_splits")
    )
    return dealt.join(copied, [key, "_split"], how).drop("_split")
