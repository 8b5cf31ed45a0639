"""Text, questions, prompts, answers, extraction."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from checks.cases import case
from snowlit.functions.answers import has_data
from snowlit.functions.prompts import (
    messages,
    page_name,
    page_prompt,
    render_answer,
    reply_content,
    text_prompt,
)
from snowlit.functions.text import base64_text, estimate_tokens, word_count
from snowlit.operators.content import answer, check_replies
from snowlit.operators.extract import (
    compare_runs,
    dedup_measurements,
    extract_measurements,
    extract_references,
    parse_answers,
    rejected_entries,
    run_agreement,
)
from snowlit.operators.pages import (
    assemble_parts,
    assemble_text,
    cap_chunks,
    chunk_pages,
    chunk_text,
    join_chunks,
    join_page_replies,
    number_rows,
    page_reply_parts,
)
from snowlit.operators.questions import (
    flatten_questions,
    pair_questions,
    pending_pairs,
    question_counts,
    question_rollup,
)
from snowlit.operators.worklist import split_errors
from snowlit.plans.question_run import chat_answers, page_requests, request_bodies, text_requests

# The words of a text, and the words cut into groups of {size}, in SQL.
WORDS = r"list_filter(regexp_split_to_array({text}, '\s+'), lambda w: w <> '')"
CHUNKS = """
    list_transform(range(0, CAST(ceil(len(ws) / {size}.0) AS BIGINT)),
                   lambda i: array_to_string(list_slice(ws, i * {size} + 1, i * {size} + {size}), ' '))
"""


def split_sql(source: str, text: str = "text") -> str:
    return f"SELECT paper_id, {WORDS.format(text=text)} AS ws FROM {source}"


def chunk_sql(size: int) -> str:
    return f"""
        SELECT paper_id, CAST(u.i - 1 AS INTEGER) AS chunk_idx, cs[u.i] AS chunk
        FROM (SELECT paper_id, {CHUNKS.format(size=size)} AS cs FROM split) AS c,
             LATERAL (SELECT unnest(range(1, len(cs) + 1)) AS i) AS u
    """


# One context per paper: at most ten chunks of 8192 words.
CONTEXT = f"""
    split AS ({split_sql('papers')}),
    ctx AS (SELECT paper_id, CASE WHEN len(ws) > 0 THEN
                array_to_string({CHUNKS.format(size=8192)},
                                chr(10) || chr(10) || '---' || chr(10) || chr(10)) END AS context
            FROM split)
"""
PENDING = """
    SELECT p.paper_id, q.q_idx, q.question FROM papers p, questions q
    WHERE NOT EXISTS (SELECT 1 FROM answered a
                      WHERE a.paper_id = p.paper_id AND a.q_idx = q.q_idx)
"""
NL2 = "chr(10) || chr(10)"
PROMPT = f"""
    'Paper:' || {NL2} || c.context || {NL2} || '---' || {NL2} || 'Question: ' || p.question
    || {NL2} || 'Please answer based only on the paper above.'
"""
REQUESTS = f"""
    WITH {CONTEXT}, pending AS ({PENDING}),
    requests AS (
        SELECT p.paper_id, p.q_idx, p.question, {PROMPT} AS prompt
        FROM pending p JOIN ctx c ON c.paper_id = p.paper_id)
"""
REQUEST_VIEWS = "papers questions answered"
SYSTEM = "You are a helpful scientific research assistant."


@case("word_counts", views="papers", sql=f"""
    SELECT paper_id, CAST(len({WORDS.format(text='text')}) AS INTEGER) AS n_words FROM papers
""")
def _(t):
    return t.papers.select("paper_id", word_count(F.col("text")).alias("n_words"))


@case("token_estimate", views="papers", sql="""
    SELECT paper_id, CAST(length(text) // 4 AS BIGINT) AS n_tokens FROM papers
""")
def _(t):
    return t.papers.select("paper_id", estimate_tokens(F.col("text")).alias("n_tokens"))


@case("chunked_papers", views="papers", sql=f"WITH split AS ({split_sql('papers')}) {chunk_sql(256)}")
def _(t):
    return chunk_text(t.papers, max_context_tokens=1024)


@case("capped_chunks", views="papers", sql=f"""
    WITH split AS ({split_sql('papers')}) SELECT * FROM ({chunk_sql(64)}) x WHERE chunk_idx < 2
""")
def _(t):
    # The bound of the chunk table is wider than the cap, and the cap cuts it.
    return cap_chunks(chunk_text(t.papers, max_context_tokens=256, max_chunks=4), 2)


PAPER_TEXT = """
    SELECT paper_id, string_agg(text, chr(10) || chr(10) ORDER BY page_no) AS text
    FROM page_text WHERE text <> '' GROUP BY paper_id
"""


@case("chunked_pages", views="page_text", sql=f"""
    WITH whole AS ({PAPER_TEXT}), split AS ({split_sql('whole')}) {chunk_sql(32)}
""")
def _(t):
    return chunk_pages(t.page_text, max_context_tokens=128)


@case("chunked_pages_capped", views="page_text", sql=f"""
    WITH whole AS ({PAPER_TEXT}), split AS ({split_sql('whole')})
    SELECT * FROM ({chunk_sql(16)}) x WHERE chunk_idx < 3
""")
def _(t):
    return chunk_pages(t.page_text, max_context_tokens=64, max_chunks=3)


@case("paper_text", views="page_text", sql=PAPER_TEXT)
def _(t):
    return assemble_text(t.page_text)


@case("paper_text_parts", views="page_text", sql="""
    SELECT paper_id, CAST(page_no // 2 AS BIGINT) AS part,
           string_agg(text, chr(10) || chr(10) ORDER BY page_no) AS text
    FROM page_text WHERE text <> '' GROUP BY 1, 2
""")
def _(t):
    return assemble_parts(t.page_text, pages_per_part=2)


@case("joined_context", views="papers", sql=f"""
    WITH split AS ({split_sql('papers')}), chunks AS ({chunk_sql(64)})
    SELECT paper_id, string_agg(chunk, chr(10) || chr(10) || '---' || chr(10) || chr(10)
                                ORDER BY chunk_idx) AS context
    FROM chunks GROUP BY paper_id
""")
def _(t):
    return join_chunks(chunk_text(t.papers, max_context_tokens=256))


@case("joined_page_replies", views="page_text", sql="""
    SELECT paper_id, string_agg('--- Page ' || (page_no + 1) || ' ---' || chr(10) || text,
                                chr(10) || chr(10) ORDER BY page_no) AS response
    FROM page_text GROUP BY paper_id
""")
def _(t):
    replies = t.page_text.select("paper_id", (F.col("page_no") + 1).alias("page_no"),
                                 F.col("text").alias("reply"))
    return join_page_replies(replies)


@case("page_reply_parts", views="page_text", sql="""
    SELECT paper_id, CAST((page_no + 1) // 2 AS BIGINT) AS part,
           string_agg('--- Page ' || (page_no + 1) || ' ---' || chr(10) || text,
                      chr(10) || chr(10) ORDER BY page_no) AS response
    FROM page_text GROUP BY 1, 2
""")
def _(t):
    replies = t.page_text.select("paper_id", (F.col("page_no") + 1).alias("page_no"),
                                 F.col("text").alias("reply"))
    return page_reply_parts(replies, pages_per_part=2)


@case("numbered_pages", views="page_text", sql="""
    SELECT paper_id, page_no, row_number() OVER (PARTITION BY paper_id ORDER BY page_no) AS number
    FROM page_text
""")
def _(t):
    return number_rows(t.page_text.select("paper_id", "page_no"), ["paper_id"], "page_no")


@case("page_name", views="page_text", sql="""
    SELECT paper_id, page_no, 'page_' || CASE WHEN page_no + 1 < 1000
        THEN lpad(CAST(page_no + 1 AS VARCHAR), 3, '0') ELSE CAST(page_no + 1 AS VARCHAR) END
        || '.png' AS name
    FROM page_text
""")
def _(t):
    return t.page_text.select("paper_id", "page_no", page_name(F.col("page_no") + 1).alias("name"))


@case("base64_text", views="papers", sql="SELECT paper_id, base64(encode(text)) AS data FROM papers")
def _(t):
    return t.papers.select("paper_id", base64_text(F.col("text").cast("binary")).alias("data"))


@case("flattened_list", sql="""
    WITH nested AS (
        SELECT doc_id, flatten(list_transform(string_split(text, chr(10)),
                                              lambda l: string_split(l, '. '))) AS items
        FROM documents)
    SELECT doc_id, CAST(u.i AS INTEGER) AS q_idx, items[u.i] AS question
    FROM nested, LATERAL (SELECT unnest(range(1, len(items) + 1)) AS i) AS u
""")
def _(t):
    nested = t.documents.select(
        "doc_id",
        F.transform(F.split("text", "\n"), lambda line: F.split(line, r"\. ")).alias("questions"),
    )
    return flatten_questions(nested, keys=("doc_id",))


@case("paper_question_pairs", views="papers questions", sql="""
    SELECT p.paper_id, q.q_idx, q.question FROM papers p, questions q
""")
def _(t):
    return pair_questions(t.papers.select("paper_id"), t.questions)


@case("pending_pairs", views=REQUEST_VIEWS, sql=PENDING)
def _(t):
    return pending_pairs(t.papers.select("paper_id"), t.questions, t.answered)


@case("pending_pairs_long_list", sql="""
    SELECT r_regionkey % 3 AS paper_id, r_name AS text, CAST(p_partkey AS INTEGER) AS q_idx, p_name AS question
    FROM region, part WHERE NOT (p_size > 25 AND p_partkey % 3 = r_regionkey % 3)
""")
def _(t):
    # Papers share ids, and the questions are as many as the parts.
    papers = t.region.select((F.col("r_regionkey") % 3).alias("paper_id"), F.col("r_name").alias("text"))
    number = F.col("p_partkey").cast("int").alias("q_idx")
    questions = t.part.select(number, F.col("p_name").alias("question"))
    answered = t.part.filter("p_size > 25").select((F.col("p_partkey") % 3).alias("paper_id"), number)
    return pending_pairs(papers, questions, answered)


@case("text_prompt", views=REQUEST_VIEWS, sql=REQUESTS + "SELECT paper_id, q_idx, prompt FROM requests")
def _(t):
    return text_requests(t.papers, t.questions, t.answered).drop("question")


@case("request_json", views=REQUEST_VIEWS, sql=REQUESTS + f"""
    SELECT paper_id, q_idx, CAST(to_json({{
        'model': 'tinyllama',
        'messages': [{{'role': 'system', 'content': '{SYSTEM}'}},
                     {{'role': 'user', 'content': prompt}}],
        'stream': false,
        'options': {{'temperature': CAST(1.0 AS DOUBLE), 'num_ctx': CAST(32768 AS INTEGER)}}
    }}) AS VARCHAR) AS body
    FROM requests
""")
def _(t):
    return request_bodies(text_requests(t.papers, t.questions, t.answered)).select(
        "paper_id", "q_idx", "body"
    )


@case("answers", views=REQUEST_VIEWS, sql=REQUESTS + """
    SELECT paper_id, q_idx, 'read ' || length(prompt) || ' characters' AS response,
           false AS skipped, CAST(NULL AS VARCHAR) AS error
    FROM requests
""")
def _(t):
    def reader(prompts):
        return [f"read {len(prompt)} characters" for prompt in prompts]

    return answer(text_requests(t.papers, t.questions, t.answered), reader, batch_size=16)


@case("chat_answers", views=REQUEST_VIEWS, sql=REQUESTS + """
    SELECT paper_id, q_idx, CASE WHEN length(prompt) % 2 = 0 THEN 'read ' || length(prompt) END AS response,
           length(prompt) % 2 = 1 AS skipped, CASE WHEN length(prompt) % 2 = 1 THEN 'busy' END AS error
    FROM requests
""")
def _(t):
    # The function takes request bodies and gives JSON replies; some are errors.
    def reader(bodies):
        sent = [len(json.loads(body)["messages"][1]["content"]) for body in bodies]
        return [json.dumps({"error": "busy"} if n % 2 else {"message": {"content": f"read {n}"}}) for n in sent]

    return chat_answers(text_requests(t.papers, t.questions, t.answered), reader, batch_size=16)


PAGE_PROMPT = f"""
    '[image]' || {NL2} || 'Page ' || (page_no + 1) || ' of the paper:' || {NL2} || 'Question: '
    || question || {NL2} || 'Please answer based only on the page image above.'
"""


def numbered(t):
    return t.page_text.select("paper_id", (F.col("page_no") + 1).alias("page_no"), "text")


@case("page_prompt", views="page_text questions", sql=f"""
    SELECT paper_id, page_no + 1 AS page_no, q_idx, {PAGE_PROMPT} AS prompt
    FROM page_text, questions
""")
def _(t):
    pages = numbered(t).select("paper_id", "page_no")
    return page_requests(pages, t.questions).drop("question")


@case("page_request_json", views="page_text questions", sql=f"""
    SELECT paper_id, page_no + 1 AS page_no, q_idx, CAST(to_json({{
        'model': 'tinyllama',
        'messages': [{{'role': 'system', 'content': '{SYSTEM}'}}]
    }}) AS VARCHAR) AS system_part,
    CAST(to_json({{'role': 'user', 'content': {PAGE_PROMPT}, 'images': [base64(encode(text))]}})
         AS VARCHAR) AS user_part
    FROM page_text, questions
""")
def _(t):
    pages = numbered(t).select(
        "paper_id", "page_no", F.array(base64_text(F.col("text").cast("binary"))).alias("images")
    )
    bodies = request_bodies(
        page_requests(pages, t.questions), max_context_tokens=256, images="images"
    )
    user = F.regexp_extract("body", r'(?s)(\{"role":"user".*\})\],"stream":false\}\z', 1)
    system = F.regexp_extract("body", r'(?s)\A(.*?\}),\{"role":"user"', 1)
    return bodies.select(
        "paper_id", "page_no", "q_idx",
        F.concat(system, F.lit("]}")).alias("system_part"), user.alias("user_part"),
    )


@case("chat_messages", views="papers", sql=f"""
    SELECT paper_id, CAST(to_json([{{'role': 'system', 'content': '{SYSTEM}'}},
                                   {{'role': 'user', 'content': text}}]) AS VARCHAR) AS messages
    FROM papers
""")
def _(t):
    sent = messages(F.lit(SYSTEM), F.col("text"))
    return t.papers.select("paper_id", F.to_json(sent).alias("messages"))


@case("parse_reply", views="replies", sql="""
    SELECT paper_id, json_extract_string(reply, '$.message.content') AS content FROM replies
""")
def _(t):
    return t.replies.select("paper_id", reply_content(F.col("reply")).alias("content"))


@case("rejected_replies", views="replies", sql="""
    SELECT paper_id, CASE paper_id % 3 WHEN 1 THEN 'busy' ELSE 'no message content' END AS error
    FROM replies WHERE paper_id % 3 <> 0
""")
def _(t):
    return split_errors(check_replies(t.replies))[1].select("paper_id", "error")


def documents_answered(t):
    """Saved answer documents: the paper's text stands for the response."""
    pairs = t.answered.join(t.questions, "q_idx").join(t.papers, "paper_id")
    return pairs.select(
        "paper_id", "q_idx",
        render_answer(F.col("q_idx"), F.col("question"), F.col("text")).alias("value"),
    )


@case("rendered_answer", views=REQUEST_VIEWS, sql=f"""
    SELECT a.paper_id, a.q_idx, '# Question ' || a.q_idx || {NL2} || q.question || {NL2} || '---'
           || {NL2} || '# Response' || {NL2} || p.text AS value
    FROM answered a JOIN questions q ON q.q_idx = a.q_idx JOIN papers p ON p.paper_id = a.paper_id
""")
def _(t):
    return documents_answered(t)


@case("parsed_answer", views=REQUEST_VIEWS, sql=r"""
    SELECT a.paper_id, a.q_idx, regexp_replace(q.question, '^\s+|\s+$', '', 'g') AS question,
           regexp_replace(p.text, '^\s+|\s+$', '', 'g') AS response
    FROM answered a JOIN questions q ON q.q_idx = a.q_idx JOIN papers p ON p.paper_id = a.paper_id
""")
def _(t):
    return parse_answers(documents_answered(t))


@case("answer_has_data", views="responses", sql="""
    SELECT paper_id, trim(response) <> 'NO USEFUL DATA' AS has_data FROM responses
""")
def _(t):
    return t.responses.select("paper_id", has_data(F.col("response")).alias("has_data"))


@case("question_counts", views="answers_given", sql="""
    SELECT q_idx, count(*) FILTER (WHERE NOT skipped) AS answered,
           count(*) FILTER (WHERE skipped) AS skipped
    FROM answers_given GROUP BY q_idx
""")
def _(t):
    return question_counts(t.answers_given)


@case("question_rollup", views="answers_given", sql="""
    SELECT q_idx, left(md5(CAST(paper_id AS VARCHAR)), 2) AS part,
           coalesce(string_agg(paper_id || '=' || response, ';' ORDER BY paper_id)
               FILTER (WHERE NOT skipped), '') AS papers,
           coalesce(string_agg(CAST(paper_id AS VARCHAR), ';' ORDER BY paper_id)
               FILTER (WHERE skipped), '') AS skipped_papers
    FROM answers_given GROUP BY 1, 2
""")
def _(t):
    shown = F.transform("papers", lambda p: F.concat(p["paper_id"].cast("string"), F.lit("="), p["response"]))
    return question_rollup(t.answers_given, digits=2).select(
        "q_idx", "part",
        F.array_join(shown, ";").alias("papers"),
        F.array_join(F.col("skipped_papers").cast("array<string>"), ";").alias("skipped_papers"),
    )


@case("extract_references", views="bibl_xml", sql="""
    SELECT paper_id, CAST(0 AS INTEGER) AS pos,
           trim(regexp_extract(xml, '<title>(.*)</title>', 1)) AS title,
           nullif(regexp_extract(xml, '<idno type="DOI">(.*)</idno>', 1), '') AS doi
    FROM bibl_xml
""")
def _(t):
    return extract_references(t.bibl_xml)


@case("nested_references", sql="""
    SELECT p_partkey AS paper_id, CAST(0 AS INTEGER) AS pos, p_name AS title,
           CASE WHEN p_partkey % 3 = 0 THEN '10.5555/o' ELSE '10.5555/i' END || p_partkey AS doi FROM part
    UNION ALL SELECT p_partkey, 1, p_brand, CASE WHEN p_partkey % 3 <> 0 THEN '10.5555/i' || p_partkey END FROM part
    UNION ALL SELECT p_partkey, 2, p_type, NULL FROM part
    UNION ALL SELECT p_partkey, 4, 'good', NULL FROM part WHERE p_partkey % 4 = 0
    UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 6 ELSE 4 END, 'last', NULL FROM part WHERE p_partkey % 5 = 0
""")
def _(t):
    return extract_references(t.bibl_nested)


@case("rejected_entries", sql="""
    SELECT p_partkey AS paper_id, CAST(3 AS INTEGER) AS pos, 'malformed XML' AS error FROM part WHERE p_partkey % 4 = 0
    UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 5 ELSE 3 END, 'no end tag' FROM part WHERE p_partkey % 5 = 0
""")
def _(t):
    return rejected_entries(t.bibl_nested).select("paper_id", "pos", "error")


NUMBER = "nullif(TRY_CAST(f[{i}] AS DOUBLE), CAST('NaN' AS DOUBLE))"
MEASUREMENTS = f"""
    WITH fields AS (SELECT paper_id, q_idx, string_split(response, ',') AS f FROM {{source}}),
    measured AS (
        SELECT paper_id, q_idx, CAST(0 AS INTEGER) AS line_no,
               nullif(f[1], 'NaN') AS polymer, nullif(f[2], 'NaN') AS drug,
               {NUMBER.format(i=3)} AS water_ph, {NUMBER.format(i=4)} AS concentration,
               {NUMBER.format(i=5)} AS capacity
        FROM fields WHERE len(f) = 5)
"""


@case("extract_measurements", views="responses",
      sql=MEASUREMENTS.format(source="responses") + "SELECT * FROM measured")
def _(t):
    return extract_measurements(t.responses)


@case("dedup_measurements", views="responses", sql=MEASUREMENTS.format(source="responses") + """
    SELECT polymer, drug, water_ph, concentration, capacity, count(*) AS n_rows
    FROM measured GROUP BY ALL
""")
def _(t):
    return dedup_measurements(extract_measurements(t.responses))


COMPARED = """
    WITH compared AS (
        SELECT coalesce(a.paper_id, b.paper_id) AS paper_id, coalesce(a.q_idx, b.q_idx) AS q_idx,
               a.response AS response_a, b.response AS response_b,
               CASE WHEN b.paper_id IS NULL THEN 'only_a' WHEN a.paper_id IS NULL THEN 'only_b'
                    WHEN a.response = b.response THEN 'same' ELSE 'different' END AS outcome
        FROM responses a FULL OUTER JOIN run_b b ON a.paper_id = b.paper_id AND a.q_idx = b.q_idx)
"""


@case("compare_runs", views="responses run_b", sql=COMPARED + "SELECT * FROM compared")
def _(t):
    return compare_runs(t.responses, t.run_b)


@case("run_agreement", views="responses run_b",
      sql=COMPARED + "SELECT q_idx, outcome, count(*) AS n FROM compared GROUP BY q_idx, outcome")
def _(t):
    return run_agreement(compare_runs(t.responses, t.run_b))
