"""Filters and search over the works table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snowlit.functions.doi import has_doi, topic_code
from snowlit.functions.prompts import reply_relevant
from snowlit.functions.terms import Terms, keyword_terms, named_terms, topic_terms
from snowlit.functions.text import split_squeezed, squeeze
from snowlit.operators.postings import require_known_terms


def filter_year(df: DataFrame, year_min: int | None = None, year_max: int | None = None) -> DataFrame:
    """Inclusive bounds; 0 or None leaves that side open; unknown years are dropped."""
    year = F.col("publication_year")
    keep = year.isNotNull()
    if year_min:
        keep &= year >= year_min
    if year_max:
        keep &= year <= year_max
    return df.filter(keep)


def filter_open_access(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_oa"))


def pdf_url(df: DataFrame) -> DataFrame:
    """Add ``pdf_url`` from the nested location; only that leaf is read."""
    return df.withColumn("pdf_url", F.col("primary_location.pdf_url"))


def matching_works(
    works: DataFrame,
    topics: Terms | None = None,
    keywords: Terms | None = None,
    year_min: int | None = None,
    year_max: int | None = None,
    open_access_only: bool = True,
) -> DataFrame:
    """DOIs of the works that match topics AND keywords, in no order.

    Each of ``topics`` and ``keywords`` is a term, a list of terms (all must
    match), or a Column made of terms. Neither given, or one given but empty,
    selects nothing. Everything is one predicate over one scan of ``works``: no
    shuffle, so copies of a work are still there.
    """
    parts: list[Column] = []
    if topics is not None:
        parts.append(topic_terms(topics))
    if keywords is not None:
        parts.append(keyword_terms(keywords))
    if not parts:
        parts.append(F.lit(False))
    if year_min or year_max:
        works = filter_year(works, year_min, year_max)
    if open_access_only:
        works = filter_open_access(works)
    for part in parts:
        works = works.filter(part)
    return works.filter(has_doi(F.col("doi"))).select("doi")


def check_topics(topics: Terms | None, catalogue: DataFrame | None) -> None:
    """Raise ``ValueError`` if ``topics`` names identifiers that ``catalogue``, a table
    with a column ``code``, does not hold. One small job; without a catalogue, none."""
    named = [] if topics is None or catalogue is None else named_terms(topics)
    if named:
        terms = catalogue.sparkSession.createDataFrame([(t,) for t in named], "term STRING")
        require_known_terms(terms, catalogue)


def search_works(
    works: DataFrame,
    topics: Terms | None = None,
    keywords: Terms | None = None,
    year_min: int | None = None,
    year_max: int | None = None,
    open_access_only: bool = True,
    max_papers: int | None = None,
    catalogue: DataFrame | None = None,
) -> DataFrame:
    """:func:`matching_works` made distinct and sorted by DOI. ``max_papers`` caps
    the result (a top-k, no full sort); by default all of it is kept. With a
    ``catalogue`` of codes, identifiers in ``topics`` that it lacks are an error."""
    check_topics(topics, catalogue)
    found = matching_works(
        works, topics, keywords, year_min, year_max, open_access_only
    ).distinct().orderBy("doi")
    return found if max_papers is None else found.limit(max_papers)


def find_topics(topics: DataFrame, term: str, n: int = 15) -> DataFrame:
    """The ``n`` best topics for a search text, as (name, code).

    A topic scores one per search word found in its name, and one more for the
    whole phrase. A name listed twice keeps its last code.
    """
    name = F.lower(F.col("display_name"))
    name_words = split_squeezed(squeeze(name))
    wanted = sorted(set(term.lower().split()))
    score = F.contains(name, F.lit(" ".join(term.lower().split()))).cast("int")
    for word in wanted:
        score = score + F.array_contains(name_words, word).cast("int")
    best = (
        topics.select(
            F.col("display_name").alias("name"),
            topic_code(F.col("id")).alias("code"),
            score.alias("score"),
        )
        .filter("score > 0")
        .orderBy(F.desc("score"), "name", "code")
        .limit(n)
    )
    return best.groupBy("name").agg(F.max("code").alias("code"), F.max("score").alias("score"))


def filter_relevant(replies: DataFrame) -> DataFrame:
    """Keep rows whose structured ``reply`` says the paper is relevant."""
    return replies.filter(reply_relevant(F.col("reply")))
