"""Packing documents into sequences of a fixed window with little padding.

Cutting: a document of n ids gives n // window full pieces, each a sequence by itself, and
one remainder. Remainders are grouped by length in units (rounded up), which makes the
histogram as long as the window has units, whatever the corpus holds.

Plan: all combinations of up to three lengths that fill the window are enumerated;
non-negative least squares finds how often to repeat each so that together they use up
the histogram; the counts are rounded down. What is left is packed greedily on the
histogram: the longest remainder, then the longest that still fit, the whole repeated
as often as the counts allow. Every step uses up a length, so the plan stays small.

Placing: each remainder gets its rank among those of its length (counts per bucket first,
then ranks inside a bucket), and the rank says which repeat of which combination it joins.

Defined cases. Null or empty text: just the end id. Null or repeated ids: each row is its
own document; equal rows are told apart by a number. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snowlit.llm.common import map_rows, stored, type_of
from snowlit.llm.tokens import encoder

WINDOW = 2048
UNIT = 8
END_ID = 1
# Remainders of one length and bucket, about.
BUCKET_ROWS = 4_000


def cut(docs: DataFrame, path: str, end_id: int = END_ID, window: int = WINDOW, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the pieces of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def make():
        encode = encoder(path, end_id)

        def run(c):
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for key, raw in zip(c["doc_id"], encode(c["text"])):
                n, raw = len(raw) // 4, memoryview(raw)
                for start in range(0, n, window):
                    length = min(window, n - start)
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    for k, v in zip(out, (key, start, length, crc, n)):
                        out[k].append(v)
            return out

        return run

    return map_rows(
        rows, make, f"doc_id {type_of(rows, 'doc_id')}, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT"
    )


@lru_cache
def combinations(units: int) -> np.ndarray:
    """Rows of up to three lengths (0: none) that add up to ``units``, longest first."""
    found = [(units, 0, 0)]
    for a in range(1, units):
        for b in range(1, a + 1):
            c = units - a - b
            if 0 <= c <= b:
                found.append((a, b, c))
    return np.array(found)


def repeat_counts(histogram: np.ndarray, combos: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """x >= 0 that minimises |A x - h|, column c of A counting the lengths of combination
    c; h[k] remainders have k units. Projected coordinate descent."""
    left, x = histogram.astype(float).tolist(), [0.0] * len(combos)
    used = [[(int(v), int(k)) for v, k in zip(*np.unique(c[c > 0], return_counts=True))] for c in combos]
    norm = [sum(k * k for _, k in u) for u in used]
    slack = max(1e-3, 1e-6 * float(histogram.sum()))
    for _ in range(sweeps):
        moved = 0.0
        for i, lengths in enumerate(used):
            step = 0.0
            for v, k in lengths:
                step += left[v] * k
            step = max(-x[i], step / norm[i])
            if step:
                for v, k in lengths:
                    left[v] -= step * k
                moved += abs(step)
                x[i] += step
        if moved < slack:
            break
    return np.array(x)


def plan(histogram: np.ndarray, units: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths in units, repeats)] that places every remainder of the histogram once."""
    left = histogram.astype(np.int64).copy()
    combos = combinations(units)
    combos = combos[((combos == 0) | (left[combos] > 0)).all(axis=1)]
    out: list[tuple[tuple[int, ...], int]] = []
    counts = repeat_counts(left, combos) if len(combos) else np.zeros(0)
    for i in np.argsort(-counts, kind="stable"):
        lengths, k = np.unique(combos[i][combos[i] > 0], return_counts=True)
        n = min(int(counts[i]), int((left[lengths] // k).min()))
        if n > 0:
            left[lengths] -= n * k
            out.append((tuple(int(v) for v in combos[i] if v), n))
    while left.any():
        room, taken = units, np.zeros_like(left)
        while room:
            fits = np.flatnonzero((left - taken)[: room + 1] > 0)
            if not len(fits):
                break
            best = int(fits[-1])
            k = min(room // best, int(left[best] - taken[best]))
            taken[best] += k
            room -= k * best
        some = taken > 0
        n = int((left[some] // taken[some]).min())
        left -= n * taken
        out.append((tuple(int(v) for v in np.repeat(np.arange(len(taken)), taken)[::-1]), n))
    return out


def slots(planned: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(units, first rank, last rank, first sequence, per sequence, first place) by length."""
    rows, next_rank, sequence = [], {}, 0
    for lengths, n in planned:
        place = 0
        for value in dict.fromkeys(lengths):
            k = lengths.count(value)
            rank = next_rank.get(value, 0)
            rows.append((value, rank, rank + n * k - 1, sequence, k, place))
            next_rank[value] = rank + n * k
            place += k
        sequence += n
    return rows


def ranked(rests: DataFrame) -> DataFrame:
    """``rests`` (units, ...) with ``rank`` from 0 within each length; no length is
    gathered in one task."""
    total = rests.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    dealt = rests.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "ids_crc32", "row"), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy("units", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("units").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("units", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("units", "bucket").orderBy("doc_id", "ids_crc32", "row")
    return (
        dealt.withColumn("nth", F.row_number().over(inside) - 1)
        .join(bases, ["units", "bucket"])
        .withColumn("rank", F.col("base") + F.col("nth")).drop("bucket", "nth", "base")
    )


def pack(docs: DataFrame, path: str, end_id: int = END_ID, window: int = WINDOW, unit: int = UNIT, doc_id="doc_id", text="text") -> DataFrame:
    """The pieces with their place: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset)."""
    spark, units = docs.sparkSession, window // unit
    pieces = stored(cut(docs, path, end_id, window, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "pieces")
    rests = pieces.filter(F.col("length") < window).withColumn("units", F.ceil(F.col("length") / unit).cast("int"))
    histogram = np.zeros(units + 1, dtype=np.int64)
    for r in rests.groupBy("units").count().collect():  # as many rows as units at most
        histogram[r["units"]] = r["count"]
    planned = plan(histogram, units)
    table = slots(planned)
    schema = "units INT, first BIGINT, last BIGINT, sequence BIGINT, k BIGINT, place BIGINT"
    # Its rows are bounded by the units and the combinations, not by the corpus.
    lookup = F.broadcast(spark.createDataFrame(table, schema))
    met = ranked(rests).join(lookup, "units").filter("rank BETWEEN first AND last")
    placed = met.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.expr("(rank - first) div k")).alias("sequence_id"),
        (F.col("place") + F.expr("(rank - first) % k")).alias("place"), "row",
    )
    order = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    packed = placed.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))
    # Full pieces are sequences of their own, numbered after the others from their row.
    first = sum(n for _, n in planned)
    full = pieces.filter(F.col("length") == window).select(
        "*", (F.lit(first) + F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return packed.select(*columns).unionByName(full.select(*columns))
