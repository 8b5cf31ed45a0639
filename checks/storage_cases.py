"""Readers and writers: derived tables stored, read back, and compared."""

from __future__ import annotations

import base64
import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from checks.cases import case
from snowlit.plans.paper_run import answer_documents, answer_papers
from snowlit.plans.question_run import run_page_questions, run_questions, text_requests, whole_page_answers
from checks.search_cases import catalogue
from checks.text_cases import (
    CONTEXT,
    MEASUREMENTS,
    PAGE_PROMPT,
    PAPER_TEXT,
    PROMPT,
    REQUEST_VIEWS,
    REQUESTS,
    numbered,
)
from snowlit.checkpoints import work_path
from snowlit.functions.doi import has_doi, is_pdf, topic_code
from snowlit.functions.prompts import render_answer
from snowlit.functions.text import base64_text
from snowlit.operators.content import extract_content, register_handler
from snowlit.operators.extract import extract_measurements, extract_references, parse_answers
from snowlit.operators.questions import pair_questions
from snowlit.operators.worklist import check_dois, write_split
from snowlit.sources.files import (
    collect_questions,
    export_answer_files,
    opened,
    read_answer_files,
    read_documents,
    read_exported_answers,
    read_questions,
    read_references,
    read_responses,
    read_saved_questions,
    read_topics,
    read_works,
    read_written_answers,
    scan_pdfs,
    write_answer_files,
    write_documents,
    write_papers,
    write_questions,
    write_references,
    write_responses,
)
from snowlit.streaming.jobs import append_table, ingest_stream

REFERENCES = """
    SELECT CAST(paper_id AS VARCHAR) AS paper_id, CAST(0 AS INTEGER) AS pos,
           trim(regexp_extract(xml, '<title>(.*)</title>', 1)) AS title,
           nullif(regexp_extract(xml, '<idno type="DOI">(.*)</idno>', 1), '') AS doi
    FROM bibl_xml
"""


def references(t):
    return extract_references(t.bibl_xml).withColumn("paper_id", F.col("paper_id").cast("string"))


@case("stored_references", views="bibl_xml",
      sql=f"SELECT * FROM ({REFERENCES}) r WHERE doi IS NOT NULL")
def _(t):
    path = work_path(t.spark, "references")
    write_references(references(t), path)
    return read_references(t.spark, path, "parquet").filter(has_doi(F.col("doi")))


@case("reference_files", views="bibl_xml", sql=f"SELECT title, doi FROM ({REFERENCES}) r")
def _(t):
    # One JSON array file per group of papers, as a reference parser leaves them.
    path = work_path(t.spark, "reference-files")
    grouped = references(t).groupBy(
        F.expr("cast(paper_id AS bigint) div 500").alias("part")
    ).agg(F.to_json(F.collect_list(F.struct("title", "doi"))).alias("value"))
    grouped.repartition("part").write.partitionBy("part").text(path)
    return read_references(t.spark, path).select("title", "doi")


@case("stored_questions", views="questions", sql="SELECT q_idx, question FROM questions")
def _(t):
    path = work_path(t.spark, "questions")
    write_questions(t.questions, path)
    return read_saved_questions(t.spark, path)


@case("question_files", views="questions", sql="SELECT q_idx, question FROM questions")
def _(t):
    # One Markdown file for each question, numbered by path.
    path = work_path(t.spark, "question-files")
    t.questions.write.option("extension", "md").option("quote", "").partitionBy("q_idx").csv(path)
    return read_questions(t.spark, f"{path}/*")


@case("mixed_questions", views="questions", sql="""
    WITH listed AS (
        SELECT 1 AS part, 'q' || s_suppkey || '.md' AS name, 'Who is ' || s_name || '?' AS question FROM supplier
        UNION ALL SELECT 2, CAST(q_idx AS VARCHAR), question FROM questions
        UNION ALL SELECT 3, 'q' || s_suppkey || '.md', 'Who is ' || s_name || '?' FROM supplier WHERE s_suppkey = 7)
    SELECT CAST(row_number() OVER (ORDER BY part, name) AS INTEGER) AS q_idx, question FROM listed
""")
def _(t):
    # A folder of files, a nested list of texts, and one file.
    path = work_path(t.spark, "mixed-questions")
    asked = F.concat(F.lit(" Who is "), "s_name", F.lit("?\n")).alias("value")
    export_answer_files(t.supplier.select(F.lit("set").alias("paper_id"), F.col("s_suppkey").cast("int").alias("q_idx"), asked), path)
    texts = [r.question for r in t.questions.orderBy("q_idx").collect()]
    return collect_questions(t.spark, f"{path}/set", [texts[:2], [texts[2:]], [f"{path}/set/q7.md"]])


@case("answer_files", views="questions", sql="""
    SELECT CAST(s_suppkey AS VARCHAR) AS paper_id, q_idx, question, s_name AS response
    FROM supplier JOIN questions ON q_idx = s_nationkey % 5 + 1
""")
def _(t):
    # Answers rendered, kept packed, exported one file each, read and parsed again.
    path, packed = work_path(t.spark, "answer-files"), work_path(t.spark, "answer-documents")
    answers = t.supplier.select(
        "s_suppkey", "s_name", (F.col("s_nationkey") % 5 + 1).cast("int").alias("q_idx")
    ).join(t.questions, "q_idx")
    document = render_answer(F.col("q_idx"), F.col("question"), F.col("s_name"))
    write_documents(answers.select(F.col("s_suppkey").cast("string").alias("paper_id"), "q_idx", document.alias("value")), packed)
    export_answer_files(read_documents(t.spark, packed), path)
    return parse_answers(read_answer_files(t.spark, path))


@case("written_answers", views="questions", sql="""
    SELECT CAST(n_nationkey AS VARCHAR) AS paper_id, q_idx, question, n_name AS response
    FROM nation JOIN questions ON q_idx = n_regionkey + 1
""")
def _(t):
    # Answers rendered, written by Spark's own text writer, a folder each, read and parsed again.
    path = work_path(t.spark, "written-answers")
    answers = t.nation.select("n_nationkey", "n_name", (F.col("n_regionkey") + 1).cast("int").alias("q_idx")).join(t.questions, "q_idx")
    document = render_answer(F.col("q_idx"), F.col("question"), F.col("n_name"))
    write_answer_files(answers.select(F.col("n_nationkey").alias("paper_id"), "q_idx", document.alias("value")), path)
    return parse_answers(read_written_answers(t.spark, path))


@case("stored_responses", views="responses run_b", sql="""
    SELECT CAST(paper_id AS VARCHAR) AS paper_id, q_idx, response, false AS skipped FROM run_b
    UNION ALL
    SELECT CAST(paper_id AS VARCHAR), q_idx, response, false FROM responses
    WHERE paper_id NOT IN (SELECT paper_id FROM run_b)
""")
def _(t):
    # The first run stays; the second adds only what is missing.
    path = work_path(t.spark, "responses")
    for run in (t.run_b, t.responses):
        write_responses(
            run.select(F.col("paper_id").cast("string"), "q_idx", "response",
                       F.lit(False).alias("skipped")),
            path,
        )
    return read_responses(t.spark, path)


@case("responses_of_two_jobs", views="responses", sql="""
    SELECT CAST(paper_id AS VARCHAR) AS paper_id, q_idx, response, false AS skipped FROM responses
""")
def _(t):
    # Two jobs at the same time, with a third of the papers in both: each has one answer.
    path = work_path(t.spark, "responses")
    rows = t.responses.select(F.col("paper_id").cast("string"), "q_idx", "response", F.lit(False).alias("skipped"))
    halves = [rows.filter("CAST(paper_id AS INT) % 3 <> 0"), rows.filter("CAST(paper_id AS INT) % 3 <> 1")]
    with ThreadPoolExecutor(2) as jobs:
        list(jobs.map(lambda half: write_responses(half, path), halves))
    return read_responses(t.spark, path)


@case("measured_responses", views="responses", sql=MEASUREMENTS.format(source="responses") + """
    SELECT CAST(paper_id AS VARCHAR) AS paper_id, polymer, drug, water_ph, concentration, capacity
    FROM measured
""")
def _(t):
    path = work_path(t.spark, "responses")
    write_responses(
        t.responses.select(F.col("paper_id").cast("string"), "q_idx", "response",
                           F.lit(False).alias("skipped")),
        path,
    )
    return extract_measurements(read_responses(t.spark, path)).drop("q_idx", "line_no")


@case("stored_works", views="works", sql="""
    SELECT doi, title, pdf_url, publication_year, is_oa, 'T' || left(topic, 1) AS topic FROM works
""")
def _(t):
    path = work_path(t.spark, "works")
    catalogue(t).drop("work_id").write.parquet(path)
    return read_works(t.spark, path).select(
        "doi", "title", "primary_location.pdf_url", "publication_year", "is_oa",
        F.col("topics")[0].alias("topic"),
    )


@case("stored_topics", views="topics", sql="""
    SELECT replace(id, 'https://openalex.org/', '') AS code, display_name AS name FROM topics
""")
def _(t):
    path = work_path(t.spark, "topics")
    t.topics.write.json(path)
    topics = read_topics(t.spark, path, "json")
    return topics.select(topic_code(F.col("id")).alias("code"), F.col("display_name").alias("name"))


@case("split_rows", views="raw_dois", sql="""
    SELECT pos, doi, starts_with(replace(trim(coalesce(doi, '')), 'https://doi.org/', ''), '10.') AS kept
    FROM raw_dois
""")
def _(t):
    good, bad = write_split(check_dois(t.raw_dois), work_path(t.spark, "split"))
    return good.withColumn("kept", F.lit(True)).unionAll(
        bad.drop("error").withColumn("kept", F.lit(False))
    )


# Pages of one file: a file does not grow with the table, as no paper does.
PAGES_PER_FILE = 1000


def pdf_folder(t):
    """Documents in files named ``*.pdf`` that start like one; each document is a
    marked page in Base64."""
    path = work_path(t.spark, "pdf")
    page = F.concat(F.lit("%PDF"), F.translate(F.base64(F.col("text").cast("binary")), "\r\n", ""))
    t.papers.select(page).write.option("extension", "pdf").option("maxRecordsPerFile", PAGES_PER_FILE).csv(path)
    return path


def paper_files(t):
    """A file for each conversation, named by it, with its turns as marked pages in Base64."""
    path = work_path(t.spark, "paper-files")
    page = F.concat(F.lit("%PDF"), base64_text(F.col("text").cast("binary")))
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", page.alias("page")))), lambda p: p["page"]), "")
    files = t.page_text.groupBy("paper_id").agg(content.alias("content")).select(F.col("paper_id").cast("string"), "content")

    def write(batches):
        for batch in batches:
            store, root = opened(path)
            store.create_dir(root, recursive=True)
            for name, value in zip(*[column.to_pylist() for column in batch.columns]):
                with store.open_output_stream(f"{root}/{name}.pdf") as out:
                    out.write(value.encode())
            yield batch.select(["paper_id"])

    files.mapInArrow(write, "paper_id STRING").count()
    return path


@case("answers_from_files", views="page_text questions", sql=f"""
    WITH whole AS ({PAPER_TEXT}),
    papers AS (SELECT CAST(paper_id AS VARCHAR) AS paper_id, text FROM whole), {CONTEXT},
    asked AS (SELECT paper_id, q_idx, question FROM papers, questions)
    SELECT p.paper_id, p.q_idx, p.question, 'read ' || length({PROMPT}) || ' characters' AS response
    FROM asked p JOIN ctx c ON c.paper_id = p.paper_id WHERE c.context IS NOT NULL
""")
def _(t):
    # PDF files and question texts to answers, which are exported as files, read and parsed again.
    def texts(content):
        return [base64.b64decode(page).decode() for page in content.decode().split("%PDF")[1:]]

    def reader(prompts):
        return [f"read {len(prompt)} characters" for prompt in prompts]

    register_handler("marked texts", texts)
    path, tree = work_path(t.spark, "paper-answers"), work_path(t.spark, "paper-documents")
    answer_papers(t.spark, paper_files(t), t.questions, "marked texts", path, reader, batch_size=16)
    export_answer_files(answer_documents(t.questions, read_responses(t.spark, path)), tree)
    return parse_answers(read_exported_answers(t.spark, tree))


def register_pages():
    def marked_pages(content):
        return content.decode().split("%PDF")[1:]

    register_handler("marked pages", marked_pages)


PAGES = "SELECT text FROM papers"


def page_text(pages):
    return pages.filter("error IS NULL").select(
        F.unbase64(F.trim(F.regexp_replace("text", r"\s+", ""))).cast("string").alias("text")
    )


@case("scanned_pages", views="papers", sql=PAGES)
def _(t):
    register_pages()
    files = scan_pdfs(t.spark, pdf_folder(t)).filter(is_pdf(F.col("content")))
    return page_text(extract_content(files, "marked pages"))


@case("ingested_pages", views="papers", sql=PAGES)
def _(t):
    register_pages()
    base = work_path(t.spark, "ingest")
    pages = extract_content(ingest_stream(t.spark, pdf_folder(t)), "marked pages")
    for _ in range(2):  # the second run finds nothing new
        append_table(pages, f"{base}/table", f"{base}/progress").awaitTermination()
    return page_text(
        t.spark.read.schema("path STRING, page_no INT, text STRING, error STRING").parquet(f"{base}/table")
    )


@case("retried_answers", views="papers questions", sql="""
    SELECT p.paper_id, q.q_idx, 'second' AS response, false AS skipped FROM papers p, questions q
""")
def _(t):
    # A first run in which every call fails, then one that works: nothing stays unanswered.
    path = work_path(t.spark, "retried")

    def broken(prompts):
        raise RuntimeError("busy")

    run_questions(t.papers, t.questions, path, broken, batch_size=16)
    run_questions(t.papers, t.questions, path, lambda prompts: ["second"] * len(prompts), batch_size=16)
    return read_responses(t.spark, path, "paper_id BIGINT, q_idx INT, response STRING, skipped BOOLEAN")


@case("page_answers_changed", views="page_text questions", sql="""
    WITH pages AS (
        SELECT paper_id, CAST(page_no AS INTEGER) AS page_no FROM page_text WHERE page_no % 3 <> 1),
    asked AS (SELECT * FROM pages, questions WHERE paper_id % 7 <> 0 OR page_no <> 2)
    SELECT paper_id, q_idx, string_agg('--- Page ' || page_no || ' ---' || chr(10) || 'page ' || page_no || ' of ' || paper_id,
                                       chr(10) || chr(10) ORDER BY page_no) AS response,
           false AS skipped
    FROM asked GROUP BY paper_id, q_idx
    HAVING count(*) = (SELECT count(*) FROM pages p WHERE p.paper_id = asked.paper_id)
""")
def _(t):
    # Answers to pages of which every third is gone, and one of some papers was not asked yet.
    said = F.concat(F.lit("page "), "page_no", F.lit(" of "), "paper_id")
    every = t.page_text.select("paper_id", F.col("page_no").cast("int").alias("page_no"))
    asked = pair_questions(every.filter("paper_id % 7 <> 0 OR page_no <> 2"), t.questions)
    answers = asked.select("paper_id", "page_no", "q_idx", said.alias("response"), F.lit(False).alias("skipped"))
    return whole_page_answers(answers, every.filter("page_no % 3 <> 1"))


@case("text_prompt_stored", views=REQUEST_VIEWS, sql=REQUESTS + "SELECT paper_id, q_idx, prompt FROM requests")
def _(t):
    # Papers stored by id: no text is shuffled, whatever the lists of papers weigh.
    path = work_path(t.spark, "papers")
    papers = write_papers(t.papers, path.rsplit("/", 1)[-1].replace("-", "_"), 8, path)
    return text_requests(papers, t.questions, t.answered).drop("question")


@case("page_answers", views="page_text questions", sql=f"""
    WITH pages AS (
        SELECT paper_id, page_no, q_idx, length({PAGE_PROMPT}) || '/' || length(base64(encode(text))) AS reply
        FROM page_text, questions)
    SELECT paper_id, q_idx, string_agg('--- Page ' || (page_no + 1) || ' ---' || chr(10) || reply,
                                       chr(10) || chr(10) ORDER BY page_no) AS response,
           false AS skipped
    FROM pages GROUP BY paper_id, q_idx
""")
def _(t):
    # The first run fails at every first page; the second asks only about these.
    def measure(bodies):
        sent = [json.loads(body)["messages"][1] for body in bodies]
        return [f"{len(m['content'])}/{len(m['images'][0])}" for m in sent]

    def busy(bodies):
        if any("Page 1 of" in body for body in bodies):
            raise RuntimeError("busy")
        return measure(bodies)

    path, pages = work_path(t.spark, "answers"), work_path(t.spark, "page-answers")
    images = numbered(t).select("paper_id", "page_no", F.col("text").cast("binary").alias("image"))
    for fn in (busy, measure):
        run_page_questions(images, t.questions, path, pages, fn, batch_size=16)
    return read_responses(t.spark, path, "paper_id BIGINT, q_idx INT, response STRING, skipped BOOLEAN")
