"""Derived input tables, in SQL that runs unchanged on Spark and on DuckDB.

See FIXTURES.md for what each stands for.
"""

VIEWS: dict[str, str] = {
    "works": """
        SELECT o_orderkey AS work_id,
               '10.5555/w' || CAST(o_orderkey AS STRING) AS doi,
               'Work ' || CAST(o_orderkey AS STRING) || ': ' || o_orderpriority AS title,
               CASE WHEN o_orderstatus = 'P' THEN NULL
                    ELSE 'https://x.example/' || CAST(o_orderkey AS STRING) || '.pdf' END AS pdf_url,
               CAST(year(o_orderdate) AS INT) AS publication_year,
               o_orderstatus = 'F' AS is_oa,
               o_orderpriority AS topic
        FROM orders
    """,
    "citations": """
        SELECT l_orderkey AS src, l_linenumber AS pos,
               (l_partkey * 7 + l_suppkey) % (SELECT count(*) FROM orders) AS dst
        FROM lineitem
    """,
    "raw_dois": """
        SELECT o_orderkey AS pos,
               CASE o_orderkey % 10
                 WHEN 0 THEN '10.5555/w' || CAST(o_orderkey AS STRING)
                 WHEN 5 THEN '10.5555/W' || CAST(o_orderkey - 5 AS STRING)
                 WHEN 1 THEN '  10.5555/w' || CAST(o_orderkey - 1 AS STRING) || ' '
                 WHEN 6 THEN '10.5555/w' || CAST(o_orderkey AS STRING)
                 WHEN 2 THEN 'https://doi.org/10.5555/w' || CAST(o_orderkey AS STRING)
                 WHEN 7 THEN 'https://doi.org/10.5555/missing' || CAST(o_orderkey AS STRING)
                 WHEN 4 THEN NULL
                 WHEN 9 THEN ''
                 ELSE 'doi:w' || CAST(o_orderkey AS STRING) END AS doi
        FROM orders
    """,
    "postings": """
        SELECT p_type AS term, '10.5555/p' || CAST(p_partkey AS STRING) AS doi FROM part
        UNION ALL
        SELECT p_brand AS term, '10.5555/p' || CAST(p_partkey AS STRING) AS doi FROM part
    """,
    "download_log": """
        SELECT event_id, ts, '10.5555/w' || CAST(user_id AS STRING) AS doi,
               CASE event_type WHEN 'error' THEN 'ERROR'
                               WHEN 'view' THEN 'NOT_OPEN_ACCESS'
                               ELSE 'SUCCESS' END AS status
        FROM events
    """,
    "page_text": """
        SELECT conv_id AS paper_id, turn AS page_no, text FROM conversations
    """,
    "papers": """
        SELECT doc_id AS paper_id, text FROM documents
    """,
    "questions": """
        SELECT CAST(r_regionkey + 1 AS INT) AS q_idx, 'Which data come from ' || r_name || '?' AS question FROM region
    """,
    "answered": """
        SELECT doc_id AS paper_id, CAST(quality + 1 AS INT) AS q_idx FROM labels
    """,
    "bibl_xml": """
        SELECT p_partkey AS paper_id,
               '<listBibl><biblStruct><analytic><title> ' || p_name || ' </title>' ||
               CASE WHEN p_partkey % 3 = 0 THEN ''
                    ELSE '<idno type="DOI">10.5555/p' || CAST(p_partkey AS STRING) || '</idno>' END ||
               '</analytic></biblStruct></listBibl>' AS xml
        FROM part
    """,
    # Entries inside of entries: self-closing ones, tags in comments and attributes, bad XML
    # and, in every fifth bibliography, an entry that never ends.
    "bibl_nested": """
        SELECT p_partkey AS paper_id,
               '<listBibl><!-- <biblStruct> --><biblStruct n="a>b"><analytic><title>' || p_name || '</title><biblStruct/>' ||
               '<biblStruct><title> ' || p_brand || ' </title>' ||
               CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '<idno type="DOI">10.5555/i' || CAST(p_partkey AS STRING) || '</idno>' END ||
               '<biblStruct><title>' || p_type || '</title></biblStruct></biblStruct></analytic>' ||
               '<idno type="DOI">10.5555/o' || CAST(p_partkey AS STRING) || '</idno></biblStruct>' ||
               CASE WHEN p_partkey % 4 = 0 THEN '</biblStruct><biblStruct><title>bad <b>x</title></b><biblStruct><title>good</title></biblStruct></biblStruct>' ELSE '' END ||
               CASE WHEN p_partkey % 5 = 0 THEN '<biblStruct><title>open</title><biblStruct ><title>last</title></biblStruct >' ELSE '' END ||
               '</listBibl>' AS xml
        FROM part
    """,
    "responses": """
        SELECT p_partkey AS paper_id, 1 AS q_idx,
               CASE p_partkey % 4
                 WHEN 0 THEN 'NO USEFUL DATA'
                 WHEN 1 THEN p_brand || ',' || p_type || ',7.5,' || CAST(p_size AS STRING) || ',NaN'
                 WHEN 2 THEN p_brand || ',' || p_type || ',NaN,' || CAST(p_size AS STRING) || ',1.25'
                 ELSE 'see table ' || CAST(p_size AS STRING) || ', second row' END AS response
        FROM part
    """,
    "crawl": """
        SELECT '10.5555/w' || CAST(event_id AS STRING) AS doi,
               CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS http_status,
               event_type <> 'click' AS body_is_pdf
        FROM events
    """,
    "topics": """
        SELECT 'https://openalex.org/T' || CAST(min(p_partkey) AS STRING) AS id, p_name AS display_name
        FROM part GROUP BY p_name
    """,
    "searches": """
        SELECT * FROM (VALUES (1, 'PROMO', true), (1, 'Brand#13', true), (2, 'ECONOMY', true),
                              (2, 'Brand#5', false), (3, 'NO SUCH TERM', true))
          AS v(search_id, term, required)
    """,
    "replies": """
        SELECT p_partkey AS paper_id,
               CASE p_partkey % 3
                 WHEN 0 THEN '{"message":{"content":"' || p_name || '"}}'
                 WHEN 1 THEN '{"error":"busy"}'
                 ELSE '{"message":{"role":"assistant"}}' END AS reply
        FROM part
    """,
    "relevance": """
        SELECT p_partkey AS paper_id,
               CASE WHEN p_size > 25 THEN '{"relevant": true}' ELSE '{"relevant": false}' END AS reply
        FROM part
    """,
    "run_b": """
        SELECT p_partkey AS paper_id, 1 AS q_idx,
               CASE WHEN p_partkey % 2 = 0 THEN 'NO USEFUL DATA'
                    ELSE p_brand || ',' || p_type || ',7.5,' || CAST(p_size AS STRING) || ',NaN' END AS response
        FROM part WHERE p_size <= 45
    """,
}

# Documents as works with full text, for searches that read it; the first line is
# the title.
VIEWS["library"] = """
        SELECT doc_id AS work_id, '10.5555/d' || CAST(doc_id AS STRING) AS doi,
               split_part(text, chr(10), 1) AS title, text, lang, source
        FROM documents
    """

# Answers with the no-data reply counted as skipped.
VIEWS["answers_given"] = """
        SELECT paper_id, q_idx, response, response = 'NO USEFUL DATA' AS skipped
        FROM (""" + VIEWS["responses"] + """) AS r
    """

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)
