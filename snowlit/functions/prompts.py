"""Prompts, messages, requests and replies as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snowlit.schemas import NO_CONTENT, RELEVANCE, REPLY, REPLY_ERROR

# Separators, prompt wording, file-name pattern, and the option
# values for which no options are sent.
CHUNK_SEPARATOR = "\n\n---\n\n"
PAGE_SEPARATOR = "\n\n"
PAGE_HEADER = "--- Page %d ---\n"
TEXT_PROMPT = (
    "Paper:\n\n",
    "\n\n---\n\nQuestion: ",
    "\n\nPlease answer based only on the paper above.",
)
PAGE_PROMPT = (
    "[image]\n\nPage ",
    " of the paper:\n\nQuestion: ",
    "\n\nPlease answer based only on the page image above.",
)
ANSWER_DOCUMENT = ("# Question ", "\n\n", "\n\n---\n\n# Response\n\n")
PAGE_FILE = "page_%03d.png"
DEFAULT_TEMPERATURE = 1.0
DEFAULT_CONTEXT = 256


def text_prompt(context: Column, question: Column) -> Column:
    head, middle, tail = (F.lit(part) for part in TEXT_PROMPT)
    return F.concat(head, context, middle, question, tail)


def page_prompt(page_no: Column, question: Column) -> Column:
    head, middle, tail = (F.lit(part) for part in PAGE_PROMPT)
    return F.concat(head, page_no.cast("string"), middle, question, tail)


def messages(system: Column, user: Column, images: Column | None = None) -> Column:
    """The system and user messages. Only the user message may carry images."""
    none = F.lit(None).cast("array<string>")

    def message(role: str, content: Column, attached: Column) -> Column:
        return F.struct(
            F.lit(role).alias("role"),
            content.alias("content"),
            attached.alias("images"),
        )

    return F.array(
        message("system", system, none),
        message("user", user, none if images is None else images),
    )


def request_json(
    model: str,
    message_array: Column,
    temperature: float = DEFAULT_TEMPERATURE,
    max_context_tokens: int = DEFAULT_CONTEXT,
) -> Column:
    """One request body. Options appear only where one differs from its default."""
    fields = [
        F.lit(model).alias("model"),
        message_array.alias("messages"),
        F.lit(False).alias("stream"),
    ]
    if temperature != DEFAULT_TEMPERATURE or max_context_tokens != DEFAULT_CONTEXT:
        fields.append(
            F.struct(
                F.lit(float(temperature)).alias("temperature"),
                F.lit(int(max_context_tokens)).alias("num_ctx"),
            ).alias("options")
        )
    return F.to_json(F.struct(*fields))


def reply_content(reply: Column) -> Column:
    """``message.content`` of a reply, NULL where the reply has none."""
    return F.from_json(reply, REPLY)["message"]["content"]


def reply_error(reply: Column) -> Column:
    """Why a reply is no answer: what it calls its ``error``, or :data:`NO_CONTENT`; NULL if it is one."""
    said = F.from_json(reply, REPLY_ERROR)["error"]
    return F.when(reply_content(reply).isNull(), F.coalesce(F.nullif(said, F.lit("")), F.lit(NO_CONTENT)))


def reply_relevant(reply: Column) -> Column:
    """``relevant`` of a structured reply; anything unreadable is not relevant."""
    return F.coalesce(F.from_json(reply, RELEVANCE)["relevant"], F.lit(False))


def page_name(page_no: Column) -> Column:
    return F.format_string(PAGE_FILE, page_no)


def render_answer(q_idx: Column, question: Column, response: Column) -> Column:
    """The saved answer document."""
    heading, gap, divider = (F.lit(part) for part in ANSWER_DOCUMENT)
    return F.concat(heading, q_idx.cast("string"), gap, question, divider, response)
