"""From PDF files and question files to stored and exported answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snowlit.checkpoints import work_path, write_step
from snowlit.functions.prompts import render_answer
from snowlit.functions.text import file_stem
from snowlit.operators.content import Answerer, extract_content
from snowlit.operators.pages import assemble_text
from snowlit.operators.questions import open_questions
from snowlit.plans.question_run import CONTEXT_TOKENS, MODEL, run_page_questions, run_questions
from snowlit.sources.files import collect_questions, read_responses, scan_pdfs

NO_PAGES = "no pages"

PAPER_RESPONSES = "paper_id STRING, q_idx INT, response STRING, skipped BOOLEAN"


def answer_papers(
    spark: SparkSession,
    files: str | Sequence[str],
    questions: DataFrame | str | Sequence,
    handler: str,
    path: str,
    fn: Answerer,
    batch_size: int = 1,
    tasks: int | None = None,
    max_context_tokens: int = CONTEXT_TOKENS,
    max_chunks: int | None = None,
    model: str | None = None,
) -> DataFrame:
    """Answer every question for every paper among the files and store it at ``path``; what is there
    already is not asked again. The rows ``(path, error)`` of files without pages are returned.

    A paper is named by its file, without folder and suffix; of files of one name, and of names that differ by
    folder only, the pages become one paper, so such files belong in different runs. ``questions`` are numbered rows, or
    what :func:`collect_questions` takes. A file of which all questions are answered is not given to the content
    ``handler``; each of the others is read once and its pages are stored, so a later step that
    is tried again does not read it again. A handler of images asks page by page, with the answers to pages kept at
    ``path`` + ``-pages``. A paper whose pages hold no word is a skipped answer.
    """
    if not isinstance(questions, DataFrame):
        questions = collect_questions(spark, questions)
    questions = write_step(questions, work_path(spark, "asked"))
    found = scan_pdfs(spark, files).withColumn("paper_id", file_stem(F.col("path")))
    left = open_questions(questions, read_responses(spark, path, PAPER_RESPONSES)).of(found)
    pages = write_step(extract_content(left.select("path", "content"), handler), work_path(spark, "pages"))
    good = pages.filter("error IS NULL").withColumn("paper_id", file_stem(F.col("path")))
    if "image" in good.columns:
        images = good.select("paper_id", "page_no", "image")
        run_page_questions(
            images, questions, path, f"{path}-pages", fn, batch_size, tasks,
            model=model or MODEL, max_context_tokens=max_context_tokens,
        )
    else:
        # Papers without a word have a row too: they are skipped, not lost.
        texts = assemble_text(good.select("paper_id", "page_no", "text"))
        papers = good.select("paper_id").distinct().join(texts, "paper_id", "left")
        run_questions(papers, questions, path, fn, batch_size, tasks, max_context_tokens, max_chunks, model)
    empty = left.select("path").join(pages.select("path"), "path", "left_anti").select("path", F.lit(NO_PAGES).alias("error"))
    return pages.filter("error IS NOT NULL").select("path", "error").unionAll(empty)


def answer_documents(questions: DataFrame, responses: DataFrame) -> DataFrame:
    """The answers as documents ``(paper_id, q_idx, value)`` for :func:`snowlit.sources.files.export_answer_files`;
    skipped ones have none."""
    given = responses.filter("NOT coalesce(skipped, false) AND response IS NOT NULL")
    return given.join(questions, "q_idx").select(
        "paper_id", "q_idx", render_answer(F.col("q_idx"), F.col("question"), F.col("response")).alias("value")
    )
