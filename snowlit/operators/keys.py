"""Keys that may be NULL, as columns that never are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain_key(name: str, kind: T.DataType, nullable: bool) -> list[Column]:
    """Columns without NULL that tell the values of a column apart, NULL included."""
    if not nullable:
        return [F.col(name)]
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        value, none = F.col(name), F.lit(0).cast(kind)
    else:
        value, none = F.col(name).cast("string"), F.lit("")
    return [F.coalesce(value, none), F.col(name).isNull()]


def with_plain_keys(
    df: DataFrame, keys: Sequence[str], nullable: Sequence[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """Add the plain form of ``keys``, and the names of the new columns. ``nullable`` keys
    may be NULL, by default those of which the schema says so.

    A join on them is a plain equality, so it keeps the partitioning of a window or
    grouping over the same columns; a null-safe one shuffles its rows again.
    """
    fields = [df.schema[k] for k in keys]
    open_keys = [f.name for f in fields if f.nullable] if nullable is None else nullable
    columns = [c for f in fields for c in plain_key(f.name, f.dataType, f.name in open_keys)]
    names = [f"_key{i}" for i in range(len(columns))]
    return df.withColumns(dict(zip(names, columns))), names
