"""Where user code plugs in: content readers and answering functions.

Both run over partitions Spark made, as ``mapInPandas`` or, for request bodies, which may hold
images, as ``mapInArrow``; tasks are the only
concurrency. Spark closes a batch at 64 MB, and what a function makes of it leaves in pieces, so a
worker holds no more on larger inputs. A task may be retried, so a function may see the same row twice:
results are keyed, and the sinks keep one row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.functions.doi import is_pdf
from snowlit.functions.prompts import reply_content, reply_error
from snowlit.schemas import NO_TEXT

# bytes of one file -> its pages, as texts or as image bytes
Reader = Callable[[bytes], Sequence[str | bytes]]
# prompts -> responses, same length and order
Answerer = Callable[[Sequence[str]], Sequence[str]]

# Bytes of pages, or of request bodies, in one piece; a longer single one still goes whole.
PIECE_BYTES = 8 << 20

_READERS: dict[str, tuple[Reader, str]] = {}


def register_handler(name: str, fn: Reader, output: str = "text") -> None:
    """Make a content reader known. ``output`` is ``text`` or ``image``."""
    if output not in ("text", "image"):
        raise ValueError(f"output must be 'text' or 'image', not {output!r}")
    _READERS[name] = (fn, output)


def piece_ends(sizes: Sequence[int], limit: int | None = None) -> list[tuple[int, int]]:
    """Where to cut rows of these sizes so that a piece stays near ``limit``."""
    part = np.cumsum(np.asarray(sizes, dtype=np.int64)) // (limit or PIECE_BYTES)
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def extract_content(files: DataFrame, name: str) -> DataFrame:
    """Pages of every file read by the handler called ``name``.

    ``files`` has ``path`` and ``content``. Rows are ``(path, page_no, text | image,
    error)``; a file that is no PDF, or that the reader fails on, gives one row with
    the error and the others go on. An unknown name is an error at once.
    """
    if name not in _READERS:
        raise ValueError(f"unknown content handler {name!r}; known: {sorted(_READERS)}")
    fn, output = _READERS[name]
    kind = "STRING" if output == "text" else "BINARY"

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content, good in zip(frame["path"], frame["content"], frame["good"]):
                try:
                    if not good:
                        raise ValueError("not a PDF file")
                    pages = list(fn(bytes(content)))
                    cuts = piece_ends([len(page or "") for page in pages])
                    numbers = range(1, len(pages) + 1)
                    pieces = ([(path, i, page, None) for i, page in zip(numbers[a:b], pages[a:b])] for a, b in cuts)
                except Exception as problem:  # one bad file must not stop the rest
                    pieces = [[(path, None, None, str(problem) or type(problem).__name__)]]
                for rows in pieces:
                    out = pd.DataFrame(rows, columns=["path", "page_no", output, "error"])
                    out["page_no"] = out["page_no"].astype("Int32")
                    yield out

    return files.select("path", "content", is_pdf(F.col("content")).alias("good")).mapInPandas(
        read, f"path STRING, page_no INT, {output} {kind}, error STRING"
    )


def answer(
    requests: DataFrame,
    fn: Answerer,
    batch_size: int = 1,
    tasks: int | None = None,
    prompt: str = "prompt",
) -> DataFrame:
    """Answers ``(paper_id, q_idx, response, skipped, error)`` to all requests; requests
    about pages keep their ``page_no``.

    ``fn`` gets ``batch_size`` prompts at a time. If a batch fails, its prompts are
    tried one by one, and only those that fail alone are skipped. A NULL prompt (a
    paper without words) is skipped. ``tasks`` sets how many calls run at once, at
    the cost of one shuffle of the prompts; by default the partitions stay as they
    are.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = _replies([t if ok else None for t, ok in zip(frame[prompt], frame[prompt].notna())], fn, batch_size)
            out = frame[frame.columns[:-1]].copy()
            out["response"] = [r[0] for r in rows]
            out["skipped"] = [r[1] for r in rows]
            out["error"] = [r[2] for r in rows]
            yield out

    asked, schema = _asked(requests, tasks, prompt, batch_size)
    return asked.mapInPandas(run, schema)


def answer_bodies(
    requests: DataFrame, fn: Answerer, batch_size: int = 1, tasks: int | None = None, body: str = "body"
) -> DataFrame:
    """:func:`answer` for request bodies, which hold whole contexts or images: a batch stays in Arrow, and
    the bodies of one piece of it at a time become texts, none in two calls."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
            # A piece is a whole number of calls, as long as there are any.
            for start, end in piece_ends(np.add.reduceat(sizes, range(0, len(sizes), batch_size)) if len(sizes) else sizes):
                piece = batch.slice(start * batch_size, (end - start) * batch_size)
                rows = _replies(piece.column(piece.num_columns - 1).to_pylist(), fn, batch_size)
                made = [pa.array([r[i] for r in rows], kind, from_pandas=True) for i, kind in enumerate((pa.string(), pa.bool_(), pa.string()))]
                names = [*piece.schema.names[:-1], "response", "skipped", "error"]
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *made], names=names)

    asked, schema = _asked(requests, tasks, body, batch_size)
    return asked.mapInArrow(run, schema)


def _asked(requests: DataFrame, tasks: int | None, prompt: str, batch_size: int) -> tuple[DataFrame, str]:
    """The keys of requests with their prompt, which comes last, and the schema of answers."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    keys = [c for c in ("paper_id", "page_no", "q_idx") if c in requests.columns]
    kinds = ", ".join(f"{c} {'INT' if c == 'q_idx' else requests.schema[c].dataType.simpleString()}" for c in keys)
    if tasks is not None:
        requests = requests.repartition(tasks, *keys)
    columns = [F.col(c).cast("int") if c == "q_idx" else F.col(c) for c in keys]
    return requests.select(*columns, prompt), f"{kinds}, response STRING, skipped BOOLEAN, error STRING"


def _replies(prompts: Sequence[str | None], fn: Answerer, batch_size: int) -> list[tuple[str | None, bool, str | None]]:
    """(response, skipped, error) for each prompt."""
    def one(text: str) -> tuple[str | None, bool, str | None]:
        try:
            return fn([text])[0], False, None
        except Exception as problem:
            return None, True, str(problem) or type(problem).__name__

    def many(texts: list[str]) -> list[tuple[str | None, bool, str | None]]:
        try:
            replies = list(fn(texts))
            if len(replies) != len(texts):
                raise ValueError("as many responses as prompts are needed")
            return [(reply, False, None) for reply in replies]
        except Exception:
            return [one(text) for text in texts]

    texts = [p for p in prompts if p is not None]
    rest = iter([reply for at in range(0, len(texts), batch_size) for reply in many(texts[at : at + batch_size])])
    return [(None, True, NO_TEXT) if p is None else next(rest) for p in prompts]


def check_replies(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Add ``content`` and ``error`` of JSON replies. A reply that is missing, cut or has no content is a row
    with an error, which :func:`snowlit.operators.worklist.split_errors` sets apart; the others go on."""
    return df.withColumns({"content": reply_content(F.col(reply)), "error": reply_error(F.col(reply))})


def reply_answers(answers: DataFrame) -> DataFrame:
    """What :func:`answer` gives, where ``response`` is a JSON reply, with its content as the response.

    A reply without content is a failed attempt with an error, so its pair stays open; errors of the
    call, and papers without text, stay as they are.
    """
    failed = F.col("error").isNotNull()
    content, error = reply_content(F.col("response")), reply_error(F.col("response"))
    return answers.withColumns({
        "response": F.when(~failed, content),
        "skipped": failed | content.isNull(),
        "error": F.coalesce("error", error),
    })
