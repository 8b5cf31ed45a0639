"""Looking DOIs up in the works table and accounting for every outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snowlit.functions.doi import doi_key, has_unique_key, is_valid_doi, normalize_doi, title_key, unique_key
from snowlit.operators.skew import hot_keys, split_join

# Outcome names, the HTTP status of a good fetch, the file suffix.
SUCCESS = "SUCCESS"
NOT_OPEN_ACCESS = "NOT_OPEN_ACCESS"
ERROR = "ERROR"
STATUSES = (SUCCESS, NOT_OPEN_ACCESS, ERROR)
HTTP_OK = 200
PDF_SUFFIX = ".pdf"


def _gaps(works: DataFrame, columns: Sequence[str]) -> F.Column:
    """How many of the named columns, or of their fields, are empty."""
    leaves = []
    for name in columns:
        kind = works.schema[name].dataType
        inner = kind.names if isinstance(kind, StructType) else []
        leaves += [F.col(name)[field] for field in inner] or [F.col(name)]
    empty = [(leaf.isNull() | F.coalesce(leaf.cast("string") == "", F.lit(False))).cast("int") for leaf in leaves]
    return sum(empty, F.lit(0))


def unique_works(works: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per DOI key: ``(doi_key, work)``, the named columns in a struct.

    Copies of a work combine before the shuffle, which is the one the lookup join
    needs anyway; the one with the fewest empty values stands for all. A
    table with the ``doi_key`` of :func:`write_catalogue`, is taken as it is; a column that only has the name is not.
    """
    work = F.struct(*[F.col(c).alias(c) for c in columns])
    if has_unique_key(works):
        return works.select("doi_key", work.alias("work"))
    return (
        works.filter(is_valid_doi(normalize_doi(F.col("doi"))))
        .groupBy(doi_key(F.col("doi")).alias("doi_key"))
        .agg(F.min(F.struct(_gaps(works, columns).alias("gaps"), work.alias("work")))["work"].alias("work"))
    )


def write_catalogue(works: DataFrame, table: str, buckets: int) -> DataFrame:
    """Store the works once per DOI key, bucketed by it, as a table of the catalog.

    Lookups against the result neither shuffle nor de-duplicate the works again.
    """
    columns = [c for c in works.columns if c != "doi_key"]
    rows = unique_works(works, columns).select(unique_key(), "work.*")
    (
        rows.repartition(buckets, "doi_key")
        .write.mode("overwrite")
        .bucketBy(buckets, "doi_key")
        .sortBy("doi_key")
        .saveAsTable(table)
    )
    return works.sparkSession.table(table)


def _lookup(dois: DataFrame, *tables: DataFrame) -> DataFrame:
    """Left-join tables with one row per ``doi_key`` to the rows of ``dois``.

    A worklist brings the ``doi_key`` that :func:`merge_worklists` marked, one row each, and
    the partitioning it was grouped by, so it is joined as it is. Other rows, whatever
    columns they have, are met by the key of their ``doi``. They may repeat it any number of
    times: hot keys are split, and rows that cannot match get scattered keys instead
    of one NULL, so that they do not pile up in one task.
    """
    if has_unique_key(dois):
        for table in tables:
            dois = dois.join(table, "doi_key", "left")
        return dois
    doi = F.col("doi")
    scattered = F.concat(F.lit("\0"), F.hex(F.xxhash64(*dois.columns)))
    key = F.when(is_valid_doi(normalize_doi(doi)), doi_key(doi)).otherwise(scattered)
    keyed = dois.withColumn("_lookup", key)
    joined = tables[0]
    for table in tables[1:]:
        joined = joined.join(table, "doi_key", "left")
    joined = joined.withColumnRenamed("doi_key", "_lookup")
    hot = hot_keys(keyed, "_lookup")
    return split_join(keyed, joined, "_lookup", dois.columns, hot, "left").drop("_lookup")


def resolve_dois(
    dois: DataFrame,
    works: DataFrame,
    columns: Sequence[str] = ("title", "primary_location"),
) -> DataFrame:
    """Every row of ``dois`` with its ``work`` struct, NULL where there is none."""
    return _lookup(dois, unique_works(works, columns))


def unresolved_dois(dois: DataFrame, works: DataFrame) -> DataFrame:
    """Well-formed DOIs, one row per key, that have no work."""
    wanted = (
        dois.filter(is_valid_doi(normalize_doi(F.col("doi"))))
        .select(doi_key(F.col("doi")).alias("doi_key"))
        .distinct()
    )
    if has_unique_key(works):
        known = works.select("doi_key")
    else:
        known = works.select(doi_key(F.col("doi")).alias("doi_key")).distinct()
    return wanted.join(known, "doi_key", "left_anti")


def fetched_dois(crawl: DataFrame) -> DataFrame:
    """Per DOI key: did any attempt return a PDF?"""
    good = (F.col("http_status") == HTTP_OK) & F.col("body_is_pdf")
    return crawl.groupBy(doi_key(F.col("doi")).alias("doi_key")).agg(
        F.bool_or(F.coalesce(good, F.lit(False))).alias("fetched")
    )


def classify_download(dois: DataFrame, works: DataFrame, crawl: DataFrame) -> DataFrame:
    """Add ``status``, and ``path`` for a success, to every row of ``dois``.

    In order: bad DOI, no work -> ERROR; no PDF address -> NOT_OPEN_ACCESS; no good
    fetch -> ERROR; else SUCCESS. Works and fetches are shuffled once each, by DOI key.
    """
    url = F.col("work.primary_location.pdf_url")
    label = F.concat(title_key(F.col("work.title")), F.lit(PDF_SUFFIX))
    status = (
        F.when(~is_valid_doi(normalize_doi(F.col("doi"))), F.lit(ERROR))
        .when(F.col("work").isNull(), F.lit(ERROR))
        .when(url.isNull() | (url == ""), F.lit(NOT_OPEN_ACCESS))
        .when(F.coalesce("fetched", F.lit(False)), F.lit(SUCCESS))
        .otherwise(F.lit(ERROR))
    )
    found = unique_works(works, ("title", "primary_location"))
    return (
        _lookup(dois, found, fetched_dois(crawl))
        .withColumn("status", status)
        .withColumn("path", F.when(F.col("status") == SUCCESS, label))
        .drop("work", "fetched")
    )


def status_counts(log: DataFrame) -> DataFrame:
    """One row per status, also for those that never occurred."""
    counts = log.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    )
    rows = F.array(*[
        F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in STATUSES
    ])
    return counts.select(F.inline(rows))


def reference_counts(refs: DataFrame, paper: str = "paper_id") -> DataFrame:
    """References, DOIs and distinct DOIs of each paper; a DOI counts by its key."""
    given = F.nullif(doi_key(F.col("doi")), F.lit(""))
    return refs.groupBy(paper).agg(
        F.count(F.lit(1)).alias("n_references"),
        F.count(given).alias("n_dois"),
        F.count_distinct(given).alias("n_distinct"),
    )


def reference_totals(refs: DataFrame) -> DataFrame:
    """The same three figures over all papers."""
    given = F.nullif(doi_key(F.col("doi")), F.lit(""))
    return refs.agg(
        F.count(F.lit(1)).alias("n_references"),
        F.count(given).alias("n_dois"),
        F.count_distinct(given).alias("n_distinct"),
    )
