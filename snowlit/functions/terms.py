"""Search terms as Boolean columns over a works table.

Compose them with ``&``, ``|`` and ``~`` (Python precedence: ``~``, then ``&``,
then ``|``). Any composition is one predicate over one scan. Each term is never
NULL, so ``~term`` is its true complement.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

Terms = Column | str | Sequence[Column | str]


def has_topic(topic_id: str) -> Column:
    return F.coalesce(F.array_contains("topics", topic_id), F.lit(False))


def has_concept(concept_id: str) -> Column:
    return F.coalesce(F.array_contains("concepts", concept_id), F.lit(False))


def has_keyword(phrase: str, columns: Sequence[str] = ("title", "text")) -> Column:
    """Case-insensitive phrase match in any of the text columns, whole texts."""
    needle = F.lower(F.lit(phrase))
    return any_of([
        F.coalesce(F.contains(F.lower(F.col(c)), needle), F.lit(False)) for c in columns
    ])


def all_of(terms: Sequence[Column]) -> Column:
    """A list of terms means all of them; an empty list matches nothing."""
    return reduce(and_, terms) if terms else F.lit(False)


def any_of(terms: Sequence[Column]) -> Column:
    return reduce(or_, terms) if terms else F.lit(False)


def topic_terms(terms: Terms) -> Column:
    """A condition from identifiers and/or columns; a list means all of them."""
    return _condition(terms, _identifier)


def keyword_terms(terms: Terms) -> Column:
    """A condition from phrases and/or columns; a list means all of them."""
    return _condition(terms, has_keyword)


def named_terms(terms: Terms) -> list[str]:
    """The identifiers or phrases given as text; what stands inside columns is not seen."""
    items = [terms] if isinstance(terms, (str, Column)) else terms
    return [t.strip() for t in items if isinstance(t, str) and t.strip()]


def _identifier(term: str) -> Column:
    if term.startswith("T"):
        return has_topic(term)
    if term.startswith("C"):
        return has_concept(term)
    raise ValueError(f"not a topic (T...) or concept (C...) identifier: {term!r}")


def _condition(terms: Terms, from_text) -> Column:
    if isinstance(terms, (str, Column)):
        terms = [terms] if not isinstance(terms, str) or terms.strip() else []
    return all_of([from_text(t.strip()) if isinstance(t, str) else t for t in terms])
