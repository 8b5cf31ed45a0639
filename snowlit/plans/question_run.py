"""From papers and questions to stored answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.functions.prompts import messages, page_prompt, request_json, text_prompt
from snowlit.functions.text import base64_text
from snowlit.operators.content import Answerer, answer, answer_bodies, reply_answers
from snowlit.operators.pages import contexts, join_page_replies
from snowlit.operators.questions import open_questions, pair_questions, pending_pairs
from snowlit.sources.files import read_responses, write_responses

# Default system prompt and model settings.
SYSTEM_PROMPT = "You are a helpful scientific research assistant."
MODEL = "tinyllama"
CONTEXT_TOKENS = 32768

PAGE_KEYS = ("paper_id", "page_no")


def text_requests(
    papers: DataFrame,
    questions: DataFrame,
    responses: DataFrame,
    max_context_tokens: int = CONTEXT_TOKENS,
    max_chunks: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Prompts for the pairs still to be answered: ``(paper_id, q_idx, question, prompt)``.

    Which papers are open is found by key; finished ones are dropped before any text is cut, and
    their text is in no shuffle if the papers are stored with
    :func:`snowlit.sources.files.write_papers`. Each context is built once per paper. ``tasks`` deals
    the contexts over that many tasks, one copy for each paper, and prompts are made inside of them. A
    paper without words gives a NULL prompt. A paper without an id has no key for an answer and
    is left out; each row of a repeated id gets its prompts.
    """
    left = open_questions(questions, responses)
    context = contexts(left.of(papers), max_context_tokens, max_chunks).select("paper_id", "context")
    if tasks is not None:
        context = context.repartition(tasks)
    prompt = text_prompt(F.col("context"), F.col("question"))
    return left.ask(context).select("paper_id", "q_idx", "question", prompt.alias("prompt"))


def page_requests(
    images: DataFrame,
    questions: DataFrame,
    responses: DataFrame | None = None,
) -> DataFrame:
    """One request per page image and question; with ``responses``, which have a
    ``page_no``, only for what they do not answer."""
    if responses is None:
        pairs = pair_questions(images, questions)
    else:
        pairs = pending_pairs(images, questions, responses, PAGE_KEYS)
    return pairs.withColumn("prompt", page_prompt(F.col("page_no"), F.col("question")))


def request_bodies(
    requests: DataFrame,
    model: str = MODEL,
    system_prompt: str = SYSTEM_PROMPT,
    temperature: float = 1.0,
    max_context_tokens: int = CONTEXT_TOKENS,
    images: str | None = None,
) -> DataFrame:
    """Add ``body``, the JSON request for each prompt."""
    sent = messages(
        F.lit(system_prompt), F.col("prompt"), None if images is None else F.col(images)
    )
    return requests.withColumn(
        "body", request_json(model, sent, temperature, max_context_tokens)
    )


def run_questions(
    papers: DataFrame,
    questions: DataFrame,
    path: str,
    fn: Answerer,
    batch_size: int = 1,
    tasks: int | None = None,
    max_context_tokens: int = CONTEXT_TOKENS,
    max_chunks: int | None = None,
    model: str | None = None,
) -> None:
    """Answer what is not yet stored at ``path`` and append it there.

    ``fn`` gets prompts and gives responses. With a ``model`` it gets JSON request bodies for it and gives JSON
    replies; one without content is stored as a failed attempt.
    """
    spark = papers.sparkSession
    key = papers.schema["paper_id"].dataType.simpleString()
    stored = read_responses(
        spark, path, f"paper_id {key}, q_idx INT, response STRING, skipped BOOLEAN"
    )
    requests = text_requests(papers, questions, stored, max_context_tokens, max_chunks, tasks)
    if model is None:
        write_responses(answer(requests, fn, batch_size), path)
    else:
        write_responses(chat_answers(requests, fn, batch_size, model, max_context_tokens=max_context_tokens), path)


def chat_answers(requests: DataFrame, fn: Answerer, batch_size: int = 1, model: str = MODEL, **settings) -> DataFrame:
    """Answers to requests from a function that takes request bodies and gives JSON replies."""
    body = F.when(F.col("prompt").isNotNull(), F.col("body"))
    bodies = request_bodies(requests, model, **settings).withColumn("body", body)
    return reply_answers(answer_bodies(bodies, fn, batch_size))


def whole_page_answers(answers: DataFrame, images: DataFrame) -> DataFrame:
    """One response ``(paper_id, q_idx, response, skipped)`` from the answers to all pages
    of a paper. Only the pages that ``images`` has now count, each once: a question that lacks
    one of them has no answer yet, and what was said of a page that is gone is left out. A paper of
    which no page has a reply is skipped."""
    pages = images.dropna(subset=list(PAGE_KEYS)).select(*PAGE_KEYS).distinct()
    wanted = pages.groupBy("paper_id").agg(F.count(F.lit(1)).alias("_pages"))
    current = answers.join(pages, list(PAGE_KEYS), "left_semi")
    given = current.groupBy("paper_id", "q_idx").agg(F.count_distinct("page_no").alias("_given"))
    full = given.join(wanted, "paper_id").filter("_given = _pages").select("paper_id", "q_idx")
    replies = current.filter("response IS NOT NULL").withColumnRenamed("response", "reply")
    joined = join_page_replies(replies, ("paper_id", "q_idx"))
    return full.join(joined, ["paper_id", "q_idx"], "left").withColumn("skipped", F.col("response").isNull())


def run_page_questions(
    images: DataFrame,
    questions: DataFrame,
    path: str,
    pages_path: str,
    fn: Answerer,
    batch_size: int = 1,
    tasks: int | None = None,
    model: str = MODEL,
    system_prompt: str = SYSTEM_PROMPT,
    temperature: float = 1.0,
    max_context_tokens: int = CONTEXT_TOKENS,
) -> None:
    """Answer from page images ``(paper_id, page_no, image)`` what is not yet stored.

    ``fn`` gets request bodies, each with the image of one page. Its answers are kept page
    by page at ``pages_path``, so a run that fails goes on where it stopped; what is complete
    is joined and appended at ``path``.
    """
    spark = images.sparkSession
    kind = {c: images.schema[c].dataType.simpleString() for c in PAGE_KEYS}
    schema = f"paper_id {kind['paper_id']}, page_no {kind['page_no']}, q_idx INT, response STRING, skipped BOOLEAN"
    shown = images.select(*PAGE_KEYS, F.array(base64_text(F.col("image"))).alias("images"))
    requests = page_requests(shown, questions, read_responses(spark, pages_path, schema))
    bodies = request_bodies(requests, model, system_prompt, temperature, max_context_tokens, "images")
    write_responses(answer_bodies(bodies, fn, batch_size, tasks), pages_path)
    write_responses(whole_page_answers(read_responses(spark, pages_path, schema), images), path)
