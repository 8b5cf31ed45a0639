"""Reading saved answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snowlit.functions.text import strip

# The heading before a response, the rule above that heading, and
# the reply that means "nothing found".
RESPONSE_HEADING = "# Response"
RULE = "---"
NO_DATA = "NO USEFUL DATA"


def answer_response(document: Column) -> Column:
    """What follows the last response heading (the question may contain one too)."""
    return strip(F.substring_index(document, RESPONSE_HEADING, -1))


def answer_question(document: Column) -> Column:
    """The question text: between the first line and the rule above the last heading."""
    tail = F.length(F.substring_index(document, RESPONSE_HEADING, -1))
    head = F.left(document, F.length(document) - tail - F.lit(len(RESPONSE_HEADING)))
    body = F.regexp_replace(strip(head), rf"{RULE}\z", "")
    return strip(F.regexp_replace(body, r"\A# Question \d+", ""))


def has_data(response: Column) -> Column:
    """False where the stripped response is exactly the no-data reply."""
    return F.coalesce(strip(response) != NO_DATA, F.lit(False))
