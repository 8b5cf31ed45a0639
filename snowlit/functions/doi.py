"""DOI, title and identifier columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from snowlit.functions.text import UNICODE, WHITESPACE_CLASS, strip

# Address prefixes, DOI start, PDF signature, file-key rules, and
# the leading letters of term identifiers.
DOI_URL = "https://doi.org/"
DOI_START = "10."
TOPIC_URL = "https://openalex.org/"
PDF_SIGNATURE = b"%PDF"
TITLE_KEY_LENGTH = 200
NO_TITLE = "unknown"
TOPIC_LETTER = "T"
CONCEPT_LETTER = "C"

# Text of printable ASCII characters other than the space.
NO_SPACE = r"\A[!-~]+\z"


def has_doi(col: Column) -> Column:
    """Present means neither NULL nor empty."""
    return col.isNotNull() & (col != "")


def is_valid_doi(col: Column) -> Column:
    """Stripped text starts with ``10.``; NULL and empty are not valid."""
    return F.coalesce(F.startswith(strip(col), F.lit(DOI_START)), F.lit(False))


def normalize_doi(col: Column) -> Column:
    """Stripped, without the resolver address."""
    # Most identifiers have nothing to strip, which a look at them tells for a quarter of the cost.
    stripped = F.when(col.rlike(NO_SPACE), col).otherwise(strip(col))
    return F.replace(stripped, F.lit(DOI_URL), F.lit(""))


def doi_key(col: Column, case_sensitive: bool = False) -> Column:
    """What joins and de-duplication compare. DOIs differ only by case are equal."""
    plain = normalize_doi(col)
    return plain if case_sensitive else F.lower(plain)


# How a column says that it is the DOI key this library made, one row for each.
_MADE_HERE = {"unique DOI key": True}


def unique_key() -> Column:
    """The ``doi_key`` of a table that has each key once, marked as such. The mark stays with the
    column, also in stored tables; another column of that name does not have it."""
    return F.col("doi_key").alias("doi_key", metadata=_MADE_HERE)


def has_unique_key(df: DataFrame) -> bool:
    return "doi_key" in df.columns and _MADE_HERE.items() <= df.schema["doi_key"].metadata.items()


def graph_key(df: DataFrame, column: str, case_sensitive: bool = False) -> Column:
    """What graph steps and sets compare: the key of a DOI, NULL where there is none.
    Identifiers that are no text are compared as they are."""
    if not isinstance(df.schema[column].dataType, StringType):
        return F.col(column)
    return F.nullif(doi_key(F.col(column), case_sensitive), F.lit(""))


def title_key(col: Column) -> Column:
    """Label made from a title: word characters, ``-`` and ``_`` only, 200 at most."""
    kept = F.regexp_replace(col, rf"{UNICODE}[^\p{{L}}\p{{N}}_\-{WHITESPACE_CLASS}]", "")
    joined = F.regexp_replace(kept, f"{UNICODE}[{WHITESPACE_CLASS}]+", "_")
    return F.coalesce(F.substring(joined, 1, TITLE_KEY_LENGTH), F.lit(NO_TITLE))


def topic_code(col: Column) -> Column:
    """Topic identifier without its address."""
    return F.replace(col, F.lit(TOPIC_URL), F.lit(""))


def is_pdf(content: Column) -> Column:
    """The first bytes are the PDF signature."""
    return F.coalesce(F.startswith(content, F.lit(PDF_SIGNATURE)), F.lit(False))


def term_kind(col: Column) -> Column:
    """``topic``, ``concept`` or ``keyword``, by the leading letter."""
    return (
        F.when(F.startswith(col, F.lit(TOPIC_LETTER)), F.lit("topic"))
        .when(F.startswith(col, F.lit(CONCEPT_LETTER)), F.lit("concept"))
        .otherwise(F.lit("keyword"))
    )
