"""Resolving DOIs, accounting, and the citation graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.cases import case
from checks.search_cases import SEARCH, catalogue
from snowlit.checkpoints import work_path, write_step
from snowlit.functions.terms import has_concept, has_keyword, has_topic
from snowlit.operators.citations import (
    citation_counts,
    expand_citations,
    frontier_ok,
    snowball,
    snowball_walks,
)
from snowlit.operators.pages import number_rows
from snowlit.operators.resolve import (
    classify_download,
    reference_counts,
    reference_totals,
    resolve_dois,
    status_counts,
    unresolved_dois,
)
from snowlit.plans.reading_list import follow_references, reading_list

KEY = "lower(replace(trim(r.doi), 'https://doi.org/', ''))"
VALID = "starts_with(replace(trim(r.doi), 'https://doi.org/', ''), '10.')"
PATH = r"""regexp_replace(regexp_replace(w.title, '[^\p{L}\p{N}_\s\-]', '', 'g'), '\s+', '_', 'g') || '.pdf'"""


@case("resolve_dois", views="raw_dois works", sql=f"""
    SELECT r.pos, r.doi, w.title, w.pdf_url
    FROM raw_dois r LEFT JOIN works w ON {VALID} AND lower(w.doi) = {KEY}
""")
def _(t):
    return resolve_dois(t.raw_dois, catalogue(t)).select(
        "pos", "doi", "work.title", "work.primary_location.pdf_url"
    )


@case("unresolved_dois", views="raw_dois works", sql=f"""
    SELECT DISTINCT {KEY} AS doi_key FROM raw_dois r
    WHERE {VALID} AND {KEY} NOT IN (SELECT lower(doi) FROM works)
""")
def _(t):
    return unresolved_dois(t.raw_dois, catalogue(t))


STATUS = """
    CASE WHEN NOT coalesce(valid, false) THEN 'ERROR'
         WHEN w.doi IS NULL THEN 'ERROR'
         WHEN w.pdf_url IS NULL OR w.pdf_url = '' THEN 'NOT_OPEN_ACCESS'
         WHEN coalesce(c.fetched, false) THEN 'SUCCESS' ELSE 'ERROR' END
"""
FETCHED = """
    SELECT lower(doi) AS k, bool_or(http_status = 200 AND body_is_pdf) AS fetched
    FROM crawl GROUP BY 1
"""


@case("download_status", views="raw_dois works crawl", sql=f"""
    WITH listed AS (SELECT r.pos, r.doi, {VALID} AS valid, {KEY} AS k FROM raw_dois r),
    fetches AS ({FETCHED}),
    outcome AS (
        SELECT l.pos, l.doi, {STATUS} AS status, {PATH} AS path
        FROM listed l LEFT JOIN works w ON l.valid AND lower(w.doi) = l.k
        LEFT JOIN fetches c ON l.valid AND c.k = l.k)
    SELECT pos, doi, status, CASE WHEN status = 'SUCCESS' THEN path END AS path FROM outcome
""")
def _(t):
    return classify_download(t.raw_dois, catalogue(t), t.crawl)


READING = """
    WITH found AS (""" + SEARCH + f"""),
    listed AS (
        SELECT 0 AS source, pos, replace(trim(doi), 'https://doi.org/', '') AS doi
        FROM raw_dois WHERE doi IS NOT NULL AND doi <> ''
        UNION ALL SELECT 1, 0, doi FROM found),
    ranked AS (
        SELECT lower(doi) AS doi_key, doi, source, pos, starts_with(doi, '10.') AS valid,
               row_number() OVER (PARTITION BY lower(doi) ORDER BY source, pos, doi) AS r
        FROM listed),
    fetches AS ({FETCHED}),
    outcome AS (
        SELECT l.doi_key, l.doi, CAST(l.source AS INTEGER) AS source, CAST(l.pos AS BIGINT) AS pos,
               {STATUS} AS status, {PATH} AS path
        FROM ranked l LEFT JOIN works w ON l.valid AND lower(w.doi) = l.doi_key
        LEFT JOIN fetches c ON l.valid AND c.k = l.doi_key
        WHERE l.r = 1)
"""


def reading(t):
    return reading_list(
        t.raw_dois,
        catalogue(t),
        t.crawl,
        topics=[has_topic("T1") | has_topic("T2"), ~has_concept("C1998")],
        keywords=["Work", ~has_keyword("77")],
        year_min=1996,
        year_max=2000,
        max_papers=None,
    )


@case("reading_list", views="raw_dois works crawl", sql=READING + """
    SELECT doi_key, doi, source, pos, status, CASE WHEN status = 'SUCCESS' THEN path END AS path
    FROM outcome
""")
def _(t):
    return reading(t)


@case("reading_list_status", views="raw_dois works crawl", sql=READING + """
    SELECT s.status, (SELECT count(*) FROM outcome o WHERE o.status = s.status) AS n
    FROM (VALUES ('SUCCESS'), ('NOT_OPEN_ACCESS'), ('ERROR')) AS s(status)
""")
def _(t):
    return status_counts(reading(t))


def bibliographies(t):
    """Each citation as a parsed bibliography of one entry."""
    name = lambda c: F.concat(F.lit("10.5555/w"), F.col(c).cast("string"))
    xml = F.concat(
        F.lit('<listBibl><biblStruct><title>W</title><idno type="DOI">'),
        name("dst"),
        F.lit("</idno></biblStruct></listBibl>"),
    )
    return t.citations.select(name("src").alias("paper_id"), xml.alias("xml"))


@case("second_pass", views="raw_dois works crawl citations", sql=READING + f""",
    cited AS (
        SELECT DISTINCT '10.5555/w' || c.dst AS doi FROM citations c
        WHERE '10.5555/w' || c.src IN (SELECT doi_key FROM outcome WHERE status = 'SUCCESS')),
    fresh AS (
        SELECT doi AS k, doi, true AS valid FROM cited
        WHERE doi NOT IN (SELECT doi_key FROM outcome)),
    second AS (
        SELECT l.k AS doi_key, l.doi, {STATUS} AS status, {PATH} AS path
        FROM fresh l LEFT JOIN works w ON lower(w.doi) = l.k LEFT JOIN fetches c ON c.k = l.k)
    SELECT doi_key, doi, status, CASE WHEN status = 'SUCCESS' THEN path END AS path FROM second
""")
def _(t):
    first = write_step(reading(t), work_path(t.spark, "reading-list"))
    return follow_references(first, bibliographies(t), catalogue(t), t.crawl).drop("source", "pos")


@case("status_counts", views="download_log", sql="""
    SELECT s.status, (SELECT count(*) FROM download_log d WHERE d.status = s.status) AS n
    FROM (VALUES ('SUCCESS'), ('NOT_OPEN_ACCESS'), ('ERROR')) AS s(status)
""")
def _(t):
    return status_counts(t.download_log)


@case("reference_counts", views="citations", sql="""
    SELECT src AS paper_id, count(*) AS n_references, count(dst) AS n_dois,
           count(DISTINCT dst) AS n_distinct
    FROM citations GROUP BY src
""")
def _(t):
    return reference_counts(
        t.citations.select(F.col("src").alias("paper_id"), F.col("dst").alias("doi"))
    )


@case("reference_totals", views="citations", sql="""
    SELECT count(*) AS n_references, count(dst) AS n_dois, count(DISTINCT dst) AS n_distinct
    FROM citations
""")
def _(t):
    return reference_totals(t.citations.select(F.col("dst").alias("doi")))


SEEDS = "SELECT work_id AS doi FROM works WHERE topic = '1-URGENT' AND publication_year = 2001 AND is_oa"


def seeds(t):
    return (
        t.works.filter("topic = '1-URGENT' AND publication_year = 2001 AND is_oa")
        .select(F.col("work_id").alias("doi"))
    )


@case("citation_hop", views="works citations", sql=f"""
    SELECT c.src, c.pos, c.dst FROM citations c JOIN ({SEEDS}) s ON c.src = s.doi
""")
def _(t):
    return expand_citations(seeds(t), t.citations)


@case("snowball_depth2", views="works citations", sql=f"""
    WITH one AS (SELECT DISTINCT dst FROM citations WHERE src IN ({SEEDS})),
    two AS (SELECT DISTINCT dst FROM citations WHERE src IN (SELECT dst FROM one))
    SELECT dst AS doi, CAST(1 AS INTEGER) AS level FROM one
    UNION ALL
    SELECT dst, CAST(2 AS INTEGER) FROM two WHERE dst NOT IN (SELECT dst FROM one)
""")
def _(t):
    return snowball(seeds(t), t.citations, depth=2)


@case("snowball_closure", views="works citations", sql=f"""
    WITH RECURSIVE reached(doi) AS (
        SELECT dst FROM citations WHERE src IN ({SEEDS})
        UNION SELECT c.dst FROM reached r JOIN citations c ON c.src = r.doi)
    SELECT doi FROM reached
""")
def _(t):
    return snowball(seeds(t), t.citations, depth=None).select("doi")


@case("snowball_walks", views="works citations", sql=f"""
    WITH one AS (SELECT dst, count(*) AS n FROM citations WHERE src IN ({SEEDS}) GROUP BY dst),
    two AS (SELECT c.dst, sum(one.n) AS n FROM one JOIN citations c ON c.src = one.dst GROUP BY c.dst)
    SELECT dst AS doi, CAST(n AS BIGINT) AS n, CAST(1 AS INTEGER) AS level FROM one
    UNION ALL SELECT dst, CAST(n AS BIGINT), CAST(2 AS INTEGER) FROM two
""")
def _(t):
    return snowball_walks(seeds(t), t.citations, depth=2)


def by_doi(t):
    name = lambda c: F.concat(F.lit("10.5555/w"), F.col(c).cast("string"))
    return t.citations.select(name("src").alias("src"), "pos", name("dst").alias("dst"))


@case("snowball_downloaded", views="works citations download_log", sql="""
    WITH ok AS (SELECT DISTINCT doi FROM download_log WHERE status = 'SUCCESS'),
    edges AS (SELECT '10.5555/w' || src AS src, '10.5555/w' || dst AS dst FROM citations),
    one AS (SELECT DISTINCT dst FROM edges
            WHERE src IN (SELECT doi FROM works WHERE topic = '1-URGENT')
              AND src IN (SELECT doi FROM ok)),
    two AS (SELECT DISTINCT dst FROM edges
            WHERE src IN (SELECT dst FROM one) AND src IN (SELECT doi FROM ok))
    SELECT dst AS doi, CAST(1 AS INTEGER) AS level FROM one
    UNION ALL
    SELECT dst, CAST(2 AS INTEGER) FROM two WHERE dst NOT IN (SELECT dst FROM one)
""")
def _(t):
    start = t.works.filter("topic = '1-URGENT'").select("doi")
    return snowball(start, by_doi(t), depth=2, log=t.download_log)


@case("frontier_ok", views="works download_log", sql="""
    SELECT doi FROM works
    WHERE doi IN (SELECT doi FROM download_log WHERE status = 'SUCCESS')
""")
def _(t):
    return frontier_ok(t.works.select("doi"), t.download_log)


@case("citation_counts", views="citations", sql="""
    SELECT dst AS doi, count(DISTINCT src) AS cited_by FROM citations GROUP BY dst
""")
def _(t):
    return citation_counts(t.citations)


@case("numbered_citations", views="citations", sql="""
    SELECT src, pos, dst, row_number() OVER (PARTITION BY src ORDER BY pos, dst) AS number
    FROM citations
""")
def _(t):
    return number_rows(t.citations, ["src"], "pos", ties=["dst"])
