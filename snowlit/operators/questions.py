"""Pairing papers with questions, and rolling answers up.

Question lists of any length take one path. The list is cut by number into blocks, written so
that its size is known; which pairs are open is found from keys and numbers alone; and papers
meet the list last, when only those with an open question are left.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.checkpoints import work_path, write_step
from snowlit.operators.fanout import fan_out

# Question numbers in one block of the list.
NUMBERS_PER_BLOCK = 500

# Papers in one part of a question's roll-up.
PAPERS_PER_PART = 10_000


def flatten_questions(df: DataFrame, column: str = "questions", keys: tuple[str, ...] = ()) -> DataFrame:
    """Nested question lists as numbered rows, from 1."""
    return df.select(
        *keys, F.posexplode(F.flatten(column)).alias("_pos", "question")
    ).select(*keys, (F.col("_pos") + 1).alias("q_idx"), "question")


def _block(number: str = "q_idx") -> F.Column:
    return F.expr(f"CAST(`{number}` AS INT) div {NUMBERS_PER_BLOCK}")


def pair_questions(papers: DataFrame, questions: DataFrame) -> DataFrame:
    """Every paper with every question: an equi-join on slot numbers, see :func:`fan_out`.

    The list is written first, so Spark knows whether it is small enough to be broadcast;
    then papers are not shuffled.
    """
    asked = questions.select(F.col("q_idx").cast("int").alias("q_idx"), "question")
    keys = [c for c in ("paper_id", "page_no") if c in papers.columns]
    return fan_out(papers, write_step(asked, work_path(papers.sparkSession, "questions")), keys)


@dataclass(frozen=True)
class OpenQuestions:
    """What is left to be asked, known from keys and question numbers alone.

    ``blocks``: ``(_block, _questions)``, the question list. ``finished``: the keys of papers
    that have all answers. ``partial``: ``(*keys, _block, _pending)``, the open numbers of the
    papers that have some. Papers in neither have none. All are stored tables.
    """

    keys: tuple[str, ...]
    blocks: DataFrame
    finished: DataFrame
    partial: DataFrame

    def of(self, papers: DataFrame) -> DataFrame:
        """The papers that have an open question. A paper without a key is left out.

        Papers meet the shorter of two lists of keys, those that are finished or those that are
        not: on a first run, or near the end, papers of any number are not shuffled. Papers
        stored with :func:`snowlit.sources.files.write_papers` never are.
        """
        papers = papers.dropna(subset=list(self.keys))
        if self.finished.isEmpty():
            return papers
        left = papers.select(*self.keys).distinct().join(self.finished, list(self.keys), "left_anti")
        left = write_step(left, work_path(papers.sparkSession, "open-papers"))
        if left.count() < self.finished.count():
            return papers.join(left, list(self.keys), "left_semi")
        return papers.join(self.finished, list(self.keys), "left_anti")

    def ask(self, papers: DataFrame) -> DataFrame:
        """``papers``, which :meth:`of` gave, with ``q_idx`` and ``question`` of each open pair."""
        met = fan_out(papers, self.blocks, self.keys)
        if not self.partial.isEmpty():
            met = met.join(self.partial, [*self.keys, "_block"], "left")
        else:
            met = met.withColumn("_pending", F.lit(None).cast("array<int>"))
        asked = F.filter(
            "_questions", lambda q: F.col("_pending").isNull() | F.array_contains("_pending", q["q_idx"])
        )
        return met.select(*papers.columns, F.inline(asked))


def question_blocks(questions: DataFrame) -> DataFrame:
    """``(_block, _questions)``: the question list, cut by number into stored blocks."""
    listed = questions.filter("q_idx IS NOT NULL").select(F.col("q_idx").cast("int").alias("q_idx"), "question")
    blocks = listed.groupBy(_block().alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct("q_idx", "question"))).alias("_questions")
    )
    return write_step(blocks, work_path(questions.sparkSession, "question-blocks"))


def all_pairs(papers: DataFrame, blocks: DataFrame, keys: Sequence[str] = ("paper_id",)) -> DataFrame:
    """Every paper with every question of the blocks."""
    return fan_out(papers, blocks, keys).select(*papers.columns, F.inline("_questions"))


def open_numbers(
    papers: DataFrame, blocks: DataFrame, done: DataFrame, keys: Sequence[str] = ("paper_id",)
) -> DataFrame:
    """``(*keys, q_idx)`` of the pairs that ``done`` has no row for, stored; for few papers at a time."""
    keys = list(keys)
    numbers = blocks.select(F.array_distinct(F.transform("_questions", lambda q: q["q_idx"])).alias("_numbers"))
    asked = fan_out(papers.select(*keys), numbers, keys).select(*keys, F.explode("_numbers").alias("q_idx"))
    left = asked.join(done, [*keys, "q_idx"], "left_anti")
    return write_step(left, work_path(papers.sparkSession, "open-numbers"))


def ask_numbers(
    papers: DataFrame, blocks: DataFrame, numbers: DataFrame, keys: Sequence[str] = ("paper_id",)
) -> DataFrame:
    """``papers`` with ``q_idx`` and ``question`` of the pairs that :func:`open_numbers` gave."""
    asked = papers.join(numbers, list(keys)).join(blocks.select(F.inline("_questions")), "q_idx")
    return asked.select(*papers.columns, "q_idx", "question")


def open_questions(
    questions: DataFrame, responses: DataFrame, keys: Sequence[str] = ("paper_id",)
) -> OpenQuestions:
    """Compare the question list with the keys of the answers.

    A question without a number has no key for an answer and is left out; questions that share
    one are open until it is answered. The answers of a paper to one block of numbers make one row,
    so no row grows with the list. ``keys`` tell papers apart; pages have two.
    """
    spark, keys = questions.sparkSession, tuple(keys)
    blocks = question_blocks(questions)
    done = (
        responses.dropna(subset=[*keys, "q_idx"])
        .groupBy(*keys, _block().alias("_block"))
        .agg(F.collect_set(F.col("q_idx").cast("int")).alias("_done"))
    )
    numbers = blocks.select("_block", F.array_distinct(F.transform("_questions", lambda q: q["q_idx"])).alias("_numbers"))
    touched = done.join(numbers, "_block").select(*keys, "_block", F.array_except("_numbers", "_done").alias("_pending"))
    touched = write_step(touched, work_path(spark, "answered-keys"))
    whole = touched.groupBy(*keys).agg(F.count_if(F.size("_pending") == 0).alias("_full"))
    finished = whole.filter(F.col("_full") == blocks.count()).select(*keys)
    finished = write_step(finished, work_path(spark, "finished-papers"))
    partial = touched.join(finished, list(keys), "left_anti")
    return OpenQuestions(keys, blocks, finished, write_step(partial, work_path(spark, "partial-papers")))


def pending_questions(
    papers: DataFrame, questions: DataFrame, responses: DataFrame, keys: Sequence[str] = ("paper_id",)
) -> DataFrame:
    """The papers that have an open question; finished ones are gone before anything but
    their key is used."""
    return open_questions(questions, responses, keys).of(papers)


def pending_pairs(
    papers: DataFrame, questions: DataFrame, responses: DataFrame, keys: Sequence[str] = ("paper_id",)
) -> DataFrame:
    """Pairs of paper and question that have no answer yet.

    A paper without a key, or a question without a number, has none for its answers either
    and is left out; each row of a repeated key, or number, gets its pairs.
    """
    left = open_questions(questions, responses, keys)
    return left.ask(left.of(papers))


def question_counts(responses: DataFrame) -> DataFrame:
    """Answered and skipped papers of each question; not marked is answered."""
    return responses.groupBy("q_idx").agg(
        F.count_if(~F.coalesce("skipped", F.lit(False))).alias("answered"),
        F.count_if(F.col("skipped")).alias("skipped"),
    )


def rollup_digits(responses: DataFrame, papers_per_part: int | None = None) -> int:
    """Hex digits that keep the parts of the largest question at about that size."""
    papers_per_part = papers_per_part or PAPERS_PER_PART
    largest = (
        responses.groupBy("q_idx").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    )
    digits = 0
    while (largest or 0) > papers_per_part * 16**digits:
        digits += 1
    return digits


def question_rollup(responses: DataFrame, digits: int | None = None) -> DataFrame:
    """The papers of each question, answered and skipped, in parts.

    One question has as many papers as the corpus, so its lists come in parts: the
    leading hex ``digits`` of the MD5 of the paper id, 16**digits even parts per
    question; by default as many as :func:`rollup_digits` measures. Joining the parts
    of a question gives its whole lists; nothing is left out.
    """
    if digits is None:
        digits = rollup_digits(responses)
    part = F.left(F.md5(F.col("paper_id").cast("string").cast("binary")), F.lit(digits))
    answer = F.struct("paper_id", "response")
    return responses.groupBy("q_idx", part.alias("part")).agg(
        F.array_sort(F.collect_list(F.when(~F.coalesce("skipped", F.lit(False)), answer))).alias("papers"),
        F.array_sort(F.collect_list(F.when(F.col("skipped"), F.col("paper_id")))).alias(
            "skipped_papers"
        ),
    )
