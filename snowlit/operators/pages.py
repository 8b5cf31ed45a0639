"""Pages, paper text and chunks.

A single paper may hold a large share of all pages, so anything that runs along a
paper's pages works in blocks of page numbers: totals per block first, then a
running total over the blocks, then positions inside each block. Where very many rows
share a block, because they repeat a page number or have none, the rows of that paper are
dealt over ranges of their order instead, see :mod:`snowlit.operators.prefix`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snowlit.functions.prompts import CHUNK_SEPARATOR, PAGE_HEADER, PAGE_SEPARATOR
from snowlit.functions.text import (
    chunk_array,
    chunk_words,
    count_squeezed,
    split_squeezed,
    squeeze,
)
from snowlit.checkpoints import work_path, write_step
from snowlit.operators.keys import with_plain_keys
from snowlit.operators.prefix import running_sums

BLOCK = 4096

# Rows of one block that a single task is asked to sort.
ROWS_PER_BLOCK = 16 * BLOCK


def _ordered(order: Sequence[str], value: Column, separator: str) -> Column:
    """Aggregate: ``value`` in ``order``, joined by ``separator``."""
    items = F.array_sort(F.collect_list(F.struct(*order, value.alias("_value"))))
    return F.array_join(F.transform(items, lambda item: item["_value"]), separator)


def running_offset(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    amount: Column,
    ties: Sequence[str] = (),
    block: int = BLOCK,
) -> DataFrame:
    """Add ``offset``: the sum of ``amount`` over earlier rows of the same keys.

    ``position`` is an integer; rows come in the order (position, ties). The rows of each
    block are counted when this is called. The groups that have a block of more than
    ``ROWS_PER_BLOCK`` rows are dealt over ranges, all others stay in blocks.
    """
    place = F.expr(f"`{position}` div {block}").alias("_block")
    sizes = df.select(*keys, place).groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    crowded = sizes.filter(F.col("_n") > ROWS_PER_BLOCK).select(*keys).distinct()
    crowded = write_step(crowded, work_path(df.sparkSession, "crowded"))
    if crowded.isEmpty():
        return _offset_in_blocks(df, keys, position, amount, ties, block)
    nullable = [k for k in keys if df.schema[k].nullable]
    keyed, names = with_plain_keys(df, keys, nullable)
    listed = with_plain_keys(crowded, keys, nullable)[0].select(*names)
    few = keyed.join(listed, names, "left_anti").drop(*names)
    many = keyed.join(listed, names, "left_semi").drop(*names)
    dealt = running_sums(many, keys, [position, *ties], {"offset": amount}, ROWS_PER_BLOCK)
    return _offset_in_blocks(few, keys, position, amount, ties, block).unionByName(dealt)


def _offset_in_blocks(
    df: DataFrame, keys: Sequence[str], position: str, amount: Column, ties: Sequence[str], block: int
) -> DataFrame:
    blocked = df.withColumns({"_block": F.expr(f"`{position}` div {block}"), "_amount": amount.cast("bigint")})
    along = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    nullable = [f.name for f in blocked.schema if f.nullable]
    totals = blocked.groupBy(*keys, "_block").agg(F.sum("_amount").alias("_total"))
    starts, names = with_plain_keys(
        totals.withColumn("_start", F.coalesce(F.sum("_total").over(along), F.lit(0))), [*keys, "_block"], nullable
    )
    blocked, names = with_plain_keys(blocked, [*keys, "_block"], nullable)
    inside = (
        Window.partitionBy(*names)
        .orderBy(position, *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        blocked.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
        .join(starts.select(*names, "_start"), names)
        .withColumn("offset", F.col("_start") + F.col("_inside"))
        .select(*df.columns, "offset")
    )


def number_rows(
    df: DataFrame, keys: Sequence[str], position: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Add ``number``: 1, 2, 3, ... within ``keys``, in (position, ties) order."""
    numbered = running_offset(df, keys, position, F.lit(1), ties)
    return numbered.select(*df.columns, (F.col("offset") + 1).alias("number"))


def assemble_text(pages: DataFrame) -> DataFrame:
    """One text per paper: non-empty pages in order, a blank line between.

    The result is one value per paper, so a paper must fit in a row. For papers of
    any size use :func:`assemble_parts`, or :func:`chunk_pages` for chunks.
    """
    return (
        pages.filter(F.col("text") != "")
        .groupBy("paper_id")
        .agg(_ordered(["page_no"], F.col("text"), PAGE_SEPARATOR).alias("text"))
    )


def assemble_parts(pages: DataFrame, pages_per_part: int = BLOCK) -> DataFrame:
    """Paper text in parts of bounded page ranges; joining them in ``part`` order
    with a blank line gives :func:`assemble_text`."""
    return (
        pages.filter(F.col("text") != "")
        .groupBy("paper_id", F.expr(f"page_no div {pages_per_part}").alias("part"))
        .agg(_ordered(["page_no"], F.col("text"), PAGE_SEPARATOR).alias("text"))
    )


def page_reply_parts(
    replies: DataFrame, keys: Sequence[str] = ("paper_id",), pages_per_part: int = BLOCK
) -> DataFrame:
    """The reply of :func:`join_page_replies` in parts of bounded page ranges; joining
    them in ``part`` order with a blank line gives the whole."""
    part = F.expr(f"page_no div {pages_per_part}").alias("part")
    return replies.groupBy(*keys, part).agg(
        _ordered(["page_no"], _headed(), PAGE_SEPARATOR).alias("response")
    )


def chunk_text(
    papers: DataFrame, max_context_tokens: int, max_chunks: int | None = None
) -> DataFrame:
    """Chunks ``(paper_id, chunk_idx, chunk)`` of each paper's text, row by row."""
    size = chunk_words(max_context_tokens)
    text = squeeze(F.coalesce("text", F.lit("")))
    needed = None if max_chunks is None else size * max_chunks
    split = papers.select("paper_id", split_squeezed(text, needed).alias("_words"))
    return split.select(
        "paper_id",
        F.posexplode(chunk_array(F.col("_words"), max_context_tokens, max_chunks)).alias(
            "chunk_idx", "chunk"
        ),
    )


def chunk_pages(
    pages: DataFrame, max_context_tokens: int, max_chunks: int | None = None
) -> DataFrame:
    """The chunks of :func:`chunk_text` straight from pages.

    The paper's text is never put together: each page knows how many words come
    before it, cuts itself at the chunk borders, and every chunk is joined from its
    own pieces. A chunk never has more than one chunk's worth of words, and pages
    past ``max_chunks`` are dropped before their text is grouped.
    """
    size = chunk_words(max_context_tokens)
    counted = pages.select("paper_id", "page_no", squeeze(F.col("text")).alias("_text"))
    placed = running_offset(
        counted, ["paper_id"], "page_no", count_squeezed(F.col("_text")), ties=["_text"]
    ).filter(F.col("_text") != "")
    first = F.expr(f"offset div {size}")
    placed = placed.withColumn("_words", split_squeezed(F.col("_text")))
    last = F.expr(f"(offset + size(_words) - 1) div {size}")
    if max_chunks is not None:
        placed = placed.filter(first < max_chunks)
        last = F.least(last, F.lit(max_chunks - 1).cast("bigint"))
    start = F.greatest(F.col("chunk_idx") * size - F.col("offset"), F.lit(0))
    stop = F.least((F.col("chunk_idx") + 1) * size - F.col("offset"), F.size("_words"))
    pieces = placed.withColumn("chunk_idx", F.explode(F.sequence(first, last))).select(
        "paper_id",
        F.col("chunk_idx").cast("int").alias("chunk_idx"),
        "offset",
        F.array_join(
            F.slice("_words", (start + 1).cast("int"), (stop - start).cast("int")), " "
        ).alias("piece"),
    )
    return pieces.groupBy("paper_id", "chunk_idx").agg(
        _ordered(["offset"], F.col("piece"), " ").alias("chunk")
    )


def cap_chunks(chunks: DataFrame, n: int) -> DataFrame:
    """At most the first ``n`` chunks of each paper."""
    return chunks.filter(F.col("chunk_idx") < n)


def contexts(
    papers: DataFrame, max_context_tokens: int, max_chunks: int | None = None
) -> DataFrame:
    """One context per paper, chunked and joined inside the row: no shuffle.

    NULL for a paper without words, which later becomes a skipped answer.
    """
    size = chunk_words(max_context_tokens)
    text = F.col("_text")
    cleaned = papers.withColumn("_text", squeeze(F.coalesce("text", F.lit(""))))
    # Text of one chunk is already its own context and is never cut into words.
    needed = None if max_chunks is None else size * max_chunks
    several = F.when(count_squeezed(text) > size, split_squeezed(text, needed))
    chunks = chunk_array(F.col("_words"), max_context_tokens, max_chunks)
    context = (
        F.when(F.col("_words").isNotNull(), F.array_join(chunks, CHUNK_SEPARATOR))
        .otherwise(F.nullif(text, F.lit("")))
    )
    return (
        cleaned.withColumn("_words", several)
        .withColumn("context", context)
        .drop("_text", "_words", "text")
    )


def join_chunks(chunks: DataFrame) -> DataFrame:
    """One context per paper from a chunk table. Cap the chunks first: the cap
    bounds each group."""
    return chunks.groupBy("paper_id").agg(
        _ordered(["chunk_idx"], F.col("chunk"), CHUNK_SEPARATOR).alias("context")
    )


def join_page_replies(replies: DataFrame, keys: Sequence[str] = ("paper_id",)) -> DataFrame:
    """One reply from the replies to each page, each under a header with its number.

    The result is one value per paper; :func:`page_reply_parts` has no such bound.
    """
    return replies.groupBy(*keys).agg(
        _ordered(["page_no"], _headed(), PAGE_SEPARATOR).alias("response")
    )


def _headed() -> Column:
    return F.concat(F.format_string(PAGE_HEADER, F.col("page_no")), F.col("reply"))
