"""Building and checking the DOI worklist."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from snowlit.functions.doi import doi_key, has_doi, is_valid_doi, normalize_doi, unique_key
from snowlit.schemas import with_field

# Reasons a DOI row is rejected.
MISSING = "missing DOI"
MALFORMED = "not a DOI"


def merge_worklists(*lists: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Concatenate DOI lists and keep the first occurrence of each DOI.

    Order is data: by list, then by ``pos`` where a list has one, then by DOI. The
    spelling shown is the first one seen. One shuffle, combined before it, so a DOI
    repeated in a third of the rows is no hot spot. ``case_sensitive`` keeps every
    spelling as a row; ``doi_key`` is what works are found by either way.
    """
    tagged = [
        df.filter(has_doi(F.col("doi"))).select(
            doi_key(F.col("doi")).alias("doi_key"),
            doi_key(F.col("doi"), case_sensitive=True).alias("exact"),
            F.struct(
                F.lit(source).alias("source"),
                (F.col("pos") if "pos" in df.columns else F.lit(0)).cast("bigint").alias("pos"),
                normalize_doi(F.col("doi")).alias("doi"),
            ).alias("seen"),
        )
        for source, df in enumerate(lists)
    ]
    return (
        reduce(DataFrame.unionAll, tagged)
        .groupBy("doi_key", *(["exact"] if case_sensitive else []))
        .agg(F.min("seen").alias("seen"))
        .select("doi_key" if case_sensitive else unique_key(), "seen.doi", "seen.source", "seen.pos")
    )


def first_occurrence(df: DataFrame, key: str = "doi", order: str = "pos") -> DataFrame:
    """The row of smallest ``order`` for each ``key``; other columns break ties."""
    rest = [c for c in df.columns if c not in (key, order)]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(order, *rest)).alias("first"))
        .select(key, "first.*")
        .select(*df.columns)
    )


def check_dois(df: DataFrame) -> DataFrame:
    """Add ``error``: NULL for a usable DOI, else why the row is rejected."""
    doi = F.col("doi")
    error = (
        F.when(~has_doi(doi), F.lit(MISSING))
        .when(~is_valid_doi(normalize_doi(doi)), F.lit(MALFORMED))
    )
    return df.withColumn("error", error)


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without an error, rows with one). A failing row never stops the rest."""
    return df.filter("error IS NULL").drop("error"), df.filter("error IS NOT NULL")


def write_split(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """As :func:`split_errors`, but computed once: written in one pass to ``path``,
    partitioned by outcome, so that each half reads only its own files."""
    rejected = F.col("error").isNotNull().alias("rejected")
    df.select("*", rejected).write.mode("overwrite").partitionBy("rejected").parquet(path)
    written = df.sparkSession.read.schema(
        with_field(df.schema, "rejected", BooleanType())
    ).parquet(path)
    return (
        written.filter("not rejected").drop("rejected", "error"),
        written.filter("rejected").drop("rejected"),
    )
