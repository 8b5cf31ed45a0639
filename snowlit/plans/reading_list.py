"""What to read next: references and search results, resolved and accounted for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.functions.terms import Terms
from snowlit.operators.extract import extract_references
from snowlit.operators.resolve import SUCCESS, classify_download
from snowlit.operators.works import check_topics, matching_works, search_works
from snowlit.operators.worklist import merge_worklists


def reading_list(
    references: DataFrame,
    works: DataFrame,
    crawl: DataFrame,
    topics: Terms | None = None,
    keywords: Terms | None = None,
    year_min: int | None = None,
    year_max: int | None = None,
    open_access_only: bool = True,
    max_papers: int | None = None,
    catalogue: DataFrame | None = None,
) -> DataFrame:
    """References first, then search results; one row per DOI with its outcome. With a
    ``catalogue`` of topics, unknown identifiers are an error.

    References, works and fetches are each shuffled once, by DOI key: the worklist
    leaves its grouping partitioned by that key, and both lookups join on it.
    """
    check_topics(topics, catalogue)
    terms = (works, topics, keywords, year_min, year_max, open_access_only)
    # Only a cap needs distinct, sorted results: the worklist does both itself.
    found = matching_works(*terms) if max_papers is None else search_works(*terms, max_papers)
    worklist = merge_worklists(references, found)
    return classify_download(worklist, works, crawl).select(
        "doi_key", "doi", "source", F.col("pos"), "status", "path"
    )


def follow_references(
    listed: DataFrame, bibliographies: DataFrame, works: DataFrame, crawl: DataFrame
) -> DataFrame:
    """The second pass: what the downloaded papers cite and the list does not hold.

    ``listed`` is a reading list; ``bibliographies`` has the parsed XML of papers,
    ``paper_id`` being their DOI key. Only papers with a successful download are
    read. The result has the shape of the list, so passes can be chained; ``listed``
    is read twice and is best a stored table.
    """
    done = listed.filter(F.col("status") == SUCCESS).select(F.col("doi_key").alias("paper_id"))
    cited = extract_references(bibliographies.join(done, "paper_id", "left_semi"))
    fresh = merge_worklists(cited).join(listed.select("doi_key"), "doi_key", "left_anti")
    return classify_download(fresh, works, crawl).select(
        "doi_key", "doi", "source", "pos", "status", "path"
    )
