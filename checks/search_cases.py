"""Worklists, search, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.cases import case
from snowlit.functions.doi import (
    doi_key,
    has_doi,
    is_valid_doi,
    normalize_doi,
    term_kind,
    title_key,
    topic_code,
)
from snowlit.functions.terms import all_of, has_concept, has_keyword, has_topic
from snowlit.operators.postings import (
    a_and_b,
    a_or_b,
    ban_complements,
    cap_per_term,
    complement,
    match_ban_searches,
    match_saved_searches,
    seen_universe,
    term_counts,
    unknown_terms,
)
from snowlit.operators.works import (
    filter_open_access,
    filter_relevant,
    filter_year,
    find_topics,
    pdf_url,
    search_works,
)
from snowlit.operators.worklist import check_dois, first_occurrence, merge_worklists, split_errors


def catalogue(t):
    """The ``works`` view in the catalogue's shape: nested location, term arrays."""
    return t.works.select(
        "work_id",
        "doi",
        "title",
        F.struct("pdf_url").alias("primary_location"),
        "publication_year",
        "is_oa",
        F.array(F.concat(F.lit("T"), F.left("topic", F.lit(1)))).alias("topics"),
        F.array(F.concat(F.lit("C"), F.col("publication_year").cast("string"))).alias("concepts"),
        F.lit(None).cast("string").alias("text"),
    )


def library(t):
    return t.library.select(
        "work_id", "doi", "title", "text",
        F.array("source").alias("topics"), F.array("lang").alias("concepts"),
        F.lit(True).alias("is_oa"),
    )


@case("doi_present", views="raw_dois", sql="""
    SELECT pos, doi FROM raw_dois WHERE doi IS NOT NULL AND doi <> ''
""")
def _(t):
    return t.raw_dois.filter(has_doi(F.col("doi")))


@case("doi_valid", views="raw_dois", sql="""
    SELECT pos, doi, coalesce(starts_with(trim(doi), '10.'), false) AS valid FROM raw_dois
""")
def _(t):
    return t.raw_dois.withColumn("valid", is_valid_doi(F.col("doi")))


@case("doi_normalized", views="raw_dois", sql="""
    SELECT pos, replace(trim(doi), 'https://doi.org/', '') AS doi,
           lower(replace(trim(doi), 'https://doi.org/', '')) AS doi_key
    FROM raw_dois
""")
def _(t):
    doi = F.col("doi")
    return t.raw_dois.select("pos", normalize_doi(doi).alias("doi"), doi_key(doi).alias("doi_key"))


@case("works_by_year", views="works", sql="""
    SELECT work_id, doi, publication_year FROM works
    WHERE publication_year >= 1996 AND publication_year <= 1999
""")
def _(t):
    return filter_year(t.works, 1996, 1999).select("work_id", "doi", "publication_year")


@case("works_open_access", views="works", sql="SELECT work_id, doi FROM works WHERE is_oa")
def _(t):
    return filter_open_access(t.works).select("work_id", "doi")


@case("works_pdf_url", views="works", sql="SELECT doi, pdf_url FROM works")
def _(t):
    return pdf_url(catalogue(t)).select("doi", "pdf_url")


@case("term_kind", views="postings topics", sql="""
    SELECT term, CASE WHEN starts_with(term, 'T') THEN 'topic'
                      WHEN starts_with(term, 'C') THEN 'concept' ELSE 'keyword' END AS kind
    FROM (SELECT term FROM postings
          UNION SELECT replace(id, 'https://openalex.org/', '') FROM topics
          UNION SELECT display_name FROM topics) AS u
""")
def _(t):
    terms = (
        t.postings.select("term")
        .unionAll(t.topics.select(topic_code(F.col("id"))))
        .unionAll(t.topics.select("display_name"))
        .distinct()
    )
    return terms.withColumn("kind", term_kind(F.col("term")))


@case("term_match", views="library", sql="""
    SELECT doi, source = 'src3' AS in_topic, lang = 'en' AS in_concept,
           contains(lower(title), 'mit license') OR contains(lower(text), 'mit license')
             AS with_keyword
    FROM library
""")
def _(t):
    return library(t).select(
        "doi",
        has_topic("src3").alias("in_topic"),
        has_concept("en").alias("in_concept"),
        has_keyword("MIT License").alias("with_keyword"),
    )


@case("boolean_search", views="library", sql="""
    SELECT doi FROM library
    WHERE (source = 'src3' OR source = 'src4' OR lang = 'fr')
      AND NOT (contains(lower(title), 'license') OR contains(lower(text), 'license'))
""")
def _(t):
    found = (has_topic("src3") | has_topic("src4") | has_concept("fr")) & ~has_keyword("license")
    return library(t).filter(found).select("doi")


@case("all_of_terms", views="library", sql="""
    SELECT doi FROM library
    WHERE lang = 'en' AND contains(lower(text), 'the') AND contains(lower(text), 'license')
""")
def _(t):
    terms = [has_concept("en"), has_keyword("the"), has_keyword("License")]
    return library(t).filter(all_of(terms)).select("doi")


SEARCH = """
    SELECT DISTINCT doi FROM works
    WHERE topic IN ('1-URGENT', '2-HIGH') AND publication_year <> 1998
      AND contains(lower(title), 'work') AND NOT contains(lower(title), '77')
      AND publication_year BETWEEN 1996 AND 2000 AND is_oa
"""


def searched(t, max_papers):
    return search_works(
        catalogue(t),
        topics=[has_topic("T1") | has_topic("T2"), ~has_concept("C1998")],
        keywords=["Work", ~has_keyword("77")],
        year_min=1996,
        year_max=2000,
        max_papers=max_papers,
    )


@case("search_works", views="works", sql=SEARCH)
def _(t):
    return searched(t, None)


@case("search_works_capped", views="works", sql=SEARCH + " ORDER BY doi LIMIT 1000")
def _(t):
    return searched(t, 1000)


@case("title_key", views="papers", sql=r"""
    SELECT paper_id, substr(regexp_replace(regexp_replace(
               text, '[^\p{L}\p{N}_\s\-]', '', 'g'), '\s+', '_', 'g'), 1, 200)
             AS title_key
    FROM papers
""")
def _(t):
    return t.papers.select("paper_id", title_key(F.col("text")).alias("title_key"))


@case("topic_code", views="topics", sql="""
    SELECT display_name AS name, replace(id, 'https://openalex.org/', '') AS code FROM topics
""")
def _(t):
    return t.topics.select(F.col("display_name").alias("name"), topic_code(F.col("id")).alias("code"))


@case("rejected_rows", views="raw_dois", sql="""
    SELECT pos, doi, CASE WHEN doi IS NULL OR doi = '' THEN 'missing DOI' ELSE 'not a DOI' END AS error
    FROM raw_dois
    WHERE doi IS NULL OR doi = ''
       OR NOT starts_with(replace(trim(doi), 'https://doi.org/', ''), '10.')
""")
def _(t):
    return split_errors(check_dois(t.raw_dois))[1]


@case("relevant_only", views="relevance", sql="""
    SELECT paper_id FROM relevance WHERE contains(reply, 'true')
""")
def _(t):
    return filter_relevant(t.relevance).select("paper_id")


def posting(t, term):
    return t.postings.filter(F.col("term") == term)


@case("postings_intersect", views="postings", sql="""
    SELECT doi FROM postings WHERE term = 'PROMO'
    INTERSECT SELECT doi FROM postings WHERE term = 'Brand#13'
""")
def _(t):
    return a_and_b(posting(t, "PROMO"), posting(t, "Brand#13"))


@case("postings_union", views="postings", sql="""
    SELECT doi FROM postings WHERE term = 'PROMO'
    UNION SELECT doi FROM postings WHERE term = 'Brand#13'
""")
def _(t):
    return a_or_b(posting(t, "PROMO"), posting(t, "Brand#13"))


@case("postings_except", views="postings", sql="""
    SELECT doi FROM postings EXCEPT SELECT doi FROM postings WHERE term = 'PROMO'
""")
def _(t):
    return complement(seen_universe(t.postings), posting(t, "PROMO"))


@case("postings_universe", views="postings", sql="SELECT DISTINCT doi FROM postings")
def _(t):
    return seen_universe(t.postings)


@case("doi_worklist", views="raw_dois works", sql="""
    WITH found AS (""" + SEARCH + """),
    listed AS (
        SELECT 0 AS source, pos, replace(trim(doi), 'https://doi.org/', '') AS doi
        FROM raw_dois WHERE doi IS NOT NULL AND doi <> ''
        UNION ALL SELECT 1, 0, doi FROM found),
    ranked AS (
        SELECT lower(doi) AS doi_key, doi, source, pos,
               row_number() OVER (PARTITION BY lower(doi) ORDER BY source, pos, doi) AS r
        FROM listed)
    SELECT doi_key, doi, CAST(source AS INTEGER) AS source, CAST(pos AS BIGINT) AS pos
    FROM ranked WHERE r = 1
""")
def _(t):
    return merge_worklists(t.raw_dois, searched(t, None))


@case("first_occurrence", views="raw_dois", sql="""
    SELECT min(pos) AS pos, lower(replace(trim(doi), 'https://doi.org/', '')) AS doi
    FROM raw_dois WHERE doi IS NOT NULL AND doi <> '' GROUP BY 2
""")
def _(t):
    keyed = t.raw_dois.filter(has_doi(F.col("doi"))).select(
        "pos", doi_key(F.col("doi")).alias("doi")
    )
    return first_occurrence(keyed)


@case("saved_search_match", views="postings searches", sql="""
    WITH need AS (SELECT search_id, count(*) FILTER (WHERE required) AS n FROM searches GROUP BY 1)
    SELECT s.search_id, p.doi
    FROM postings p JOIN searches s ON s.term = p.term JOIN need ON need.search_id = s.search_id
    GROUP BY s.search_id, p.doi, need.n
    HAVING count(DISTINCT CASE WHEN s.required THEN s.term END) = need.n
       AND count(*) FILTER (WHERE NOT s.required) = 0
""")
def _(t):
    return match_saved_searches(t.postings, t.searches, ban_only=False)


def brand_bans(t):
    """A search for each brand, which bans it."""
    brands = t.postings.filter(F.startswith("term", F.lit("Brand"))).select("term").distinct()
    return brands.select(F.col("term").alias("search_id"), "term", F.lit(False).alias("required"))


@case("saved_search_bans", views="postings", sql="""
    WITH banned AS (SELECT DISTINCT term FROM postings WHERE starts_with(term, 'Brand'))
    SELECT b.term AS search_id, u.doi
    FROM banned b, (SELECT DISTINCT doi FROM postings) u
    WHERE NOT EXISTS (SELECT 1 FROM postings p WHERE p.term = b.term AND p.doi = u.doi)
""")
def _(t):
    return match_ban_searches(t.postings, brand_bans(t))


@case("saved_search_ban_counts", views="postings", sql="""
    WITH banned AS (SELECT DISTINCT term FROM postings WHERE starts_with(term, 'Brand'))
    SELECT b.term AS search_id, (SELECT count(DISTINCT doi) FROM postings)
         - (SELECT count(DISTINCT doi) FROM postings p WHERE p.term = b.term) AS n_dois
    FROM banned b
""")
def _(t):
    return ban_complements(t.postings, brand_bans(t)).counts()


@case("saved_search_ban_members", views="postings", sql="""
    SELECT DISTINCT x.term AS search_id, p.doi FROM postings p, postings x
    WHERE x.term IN ('Brand#13', 'Brand#21')
      AND NOT EXISTS (SELECT 1 FROM postings b WHERE b.term = x.term AND b.doi = p.doi)
""")
def _(t):
    # Two of all searches are asked for; only these are written out.
    kept = ban_complements(t.postings, brand_bans(t))
    return kept.of(kept.searches.filter("search_id IN ('Brand#13', 'Brand#21')"))


@case("term_counts", views="postings", sql="""
    SELECT term, count(DISTINCT doi) AS n_dois FROM postings GROUP BY term
""")
def _(t):
    return term_counts(t.postings)


@case("capped_postings", views="postings", sql="""
    SELECT term, doi FROM (
        SELECT term, doi, row_number() OVER (PARTITION BY term ORDER BY doi) AS r FROM postings) x
    WHERE r <= 50
""")
def _(t):
    return cap_per_term(t.postings, 50)


@case("unknown_terms", views="searches postings", sql="""
    SELECT DISTINCT term FROM searches WHERE term NOT IN (SELECT term FROM postings)
""")
def _(t):
    known = t.postings.select(F.col("term").alias("code"))
    return unknown_terms(t.searches, known)


@case("find_topics", views="topics", sql="""
    WITH scored AS (
        SELECT display_name AS name, replace(id, 'https://openalex.org/', '') AS code,
               CAST(contains(lower(display_name), 'red widget') AS INTEGER)
               + CAST(list_contains(string_split(lower(display_name), ' '), 'red') AS INTEGER)
               + CAST(list_contains(string_split(lower(display_name), ' '), 'widget') AS INTEGER)
                 AS score
        FROM topics)
    SELECT name, max(code) AS code, max(score) AS score FROM (
        SELECT * FROM scored WHERE score > 0 ORDER BY score DESC, name, code LIMIT 15) AS best
    GROUP BY name
""")
def _(t):
    return find_topics(t.topics, "Red widget")
