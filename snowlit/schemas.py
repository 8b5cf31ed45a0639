"""Explicit schemas, as DDL. Every reader uses one of these; nothing is inferred."""

from pyspark.sql.types import DataType, StructField, StructType

# A bibliography entry as stored in a reference file.
REFERENCE = "STRUCT<title: STRING, doi: STRING>"

# The same entry once it is a table row: which paper it came from, and where.
REFERENCE_ROW = "paper_id STRING, pos INT, title STRING, doi STRING"

WORKS = (
    "doi STRING, title STRING, primary_location STRUCT<pdf_url: STRING>, "
    "publication_year INT, is_oa BOOLEAN, topics ARRAY<STRING>, "
    "concepts ARRAY<STRING>, text STRING"
)

TOPICS = "id STRING, display_name STRING"

QUESTIONS = "q_idx INT, question STRING"

# Why a paper without words is skipped.
NO_TEXT = "no text"

RESPONSES = "paper_id STRING, q_idx INT, response STRING, skipped BOOLEAN"

ANSWER_DOCUMENTS = "paper_id STRING, q_idx INT, value STRING"

# The part of a model reply that is read.
REPLY = "message STRUCT<content: STRING>"

# What a reply without an answer may say instead, and what is said of one that does not.
REPLY_ERROR = "error STRING"
NO_CONTENT = "no message content"

RELEVANCE = "relevant BOOLEAN"


def with_field(schema: StructType, name: str, kind: DataType) -> StructType:
    """A copy of ``schema`` with one more field."""
    return StructType([*schema.fields, StructField(name, kind)])
