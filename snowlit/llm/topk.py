"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are whole numbers (floor of 256 times each component). A block of vectors becomes
an inverted index: each posting segment holds the vectors of the block whose component in
one dimension has one quantised impact, and the segments stand in descending order of it.
A block of queries goes through the segments in that order, adding weight times impact
to one accumulator per vector and query. After each impact level, what is still missing
from a score is at most the length of the vector's rest times the length of the query
(Cauchy-Schwarz). The scan stops when this proves for enough vectors that they can't be
among the k best of the block; all possible members are then scored exactly.

Every pair of a vector block and a query block is one row of a join, so a task holds two
blocks. The best k of each block are merged by query.

Defined cases. A vector that is null, has a null or non-finite component or a null id takes
no part; so do vectors whose length differs from the query's. Repeated ids: a row never
meets its own id; each other row counts, ties go to the smaller id. Fewer than k others:
all of them. Empty table: no rows. Other columns are not read, so their names don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snowlit.llm.common import stored

SCALE = 256
STEP = 4
# Impact levels after which the scan may stop.
STOPS = (16, 8, 4, 2, 1)
VECTORS = 4096
QUERIES = 1024
# Possible members per query that are worth scoring exactly.
ENOUGH = 40


def quantised(vectors: DataFrame, vec_id="vec_id", vector="embedding") -> DataFrame:
    """(vec_id, dims, vec): components as whole numbers, only where all are finite."""
    x = F.col("vec").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vec"))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & fine).select(
        "vec_id", F.size("vec").alias("dims"), F.transform(x, lambda v: F.floor(v * SCALE)).cast("array<bigint>").alias("vec")
    )


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """(dims, n, ids, values): up to ``rows`` vectors of one length as two binaries."""
    schema = pa.schema([("dims", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("vals", pa.binary()), ("part", pa.int64())])

    def run(batches):
        held: dict[int, list] = {}
        part, made = TaskContext.get().partitionId(), 0

        def close(dims):
            nonlocal made
            ids, values = (np.concatenate(x) for x in zip(*held.pop(dims)))
            made += 1
            return pa.RecordBatch.from_pylist([{
                "dims": dims, "n": len(ids), "ids": ids.astype("<i8").tobytes(), "vals": values.astype("<i8").tobytes(),
                "part": part * 1_000_003 + made,
            }], schema=schema)

        for batch in batches:
            ids, dims = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            flat = np.asarray(batch.column(2).flatten())
            ends = np.cumsum(dims)
            for d in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == d)
                values = flat[(ends[mine] - d)[:, None] + np.arange(d)]
                for at in range(0, len(mine), rows):
                    held.setdefault(d, []).append((ids[mine[at : at + rows]], values[at : at + rows]))
                    if sum(len(i) for i, _ in held[d]) >= rows:
                        yield close(d)
        for d in list(held):
            yield close(d)

    return vectors.mapInArrow(run, "dims INT, n INT, ids BINARY, vals BINARY, part BIGINT")


class ImpactIndex:
    """Posting segments of a block of vectors, highest impact first."""

    def __init__(self, values: np.ndarray, step: int = STEP):
        self.values = values
        impact = np.abs(values) // step
        # What the accumulator adds for a posting: the middle of its impact level.
        self.added = np.sign(values) * (impact * step + step // 2) * (impact > 0)
        self.segments: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        vector, dim = np.nonzero(impact)
        level, sign = impact[vector, dim], values[vector, dim] > 0
        order = np.lexsort((vector, sign, dim, -level))
        vector, dim, level, sign = vector[order], dim[order], level[order], sign[order]
        cuts = np.flatnonzero(np.r_[True, (np.diff(level) != 0) | (np.diff(dim) != 0) | (np.diff(sign.astype(np.int8)) != 0)]) if len(level) else np.zeros(0, dtype=int)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(level)]):
            worth = int(level[a]) * step + step // 2
            self.segments.setdefault(int(level[a]), []).append((int(dim[a]), worth if sign[a] else -worth, vector[a:b]))
        self.impact = impact

    def rest(self, stop: int) -> np.ndarray:
        """Length of what is missing of each vector after all levels from ``stop`` on."""
        left = self.values - np.where(self.impact >= stop, self.added, 0)
        return np.sqrt((left.astype(np.float64) ** 2).sum(axis=1))


def best_of_block(
    index: ImpactIndex, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of the k best of the block for each query, ids not equal."""
    n, m = len(ids), len(queries)
    weights = queries.T.astype(np.float64)  # exact: sums stay far below 2**53
    length = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    total = np.zeros((n, m))
    own = ids[:, None] == query_ids[None, :]
    levels = sorted(index.segments, reverse=True)
    at = 0
    for stop in STOPS:
        while at < len(levels) and levels[at] >= stop:
            for dim, worth, vectors in index.segments[levels[at]]:
                total[vectors] += weights[dim] * worth
            at += 1
        slack = index.rest(stop)[:, None] * length[None, :] * (1 + 1e-9) + 1e-6
        low = np.where(own, -np.inf, total - slack)
        kth = np.partition(low, n - k, axis=0)[n - k] if n > k else np.full(m, -np.inf)
        possible = (total + slack >= kth) & ~own
        if possible.sum() <= ENOUGH * m:
            break
    vector, query = np.nonzero(possible)
    scores = np.empty(len(vector), dtype=np.int64)
    for a in range(0, len(vector), 1 << 17):
        b = a + (1 << 17)
        scores[a:b] = np.einsum("ij,ij->i", index.values[vector[a:b]], queries[query[a:b]])
    order = np.lexsort((ids[vector], -scores, query))
    vector, query, scores = vector[order], query[order], scores[order]
    start = np.searchsorted(query, np.arange(m))
    keep = np.arange(len(query)) - start[query] < k
    return query_ids[query[keep]], ids[vector[keep]], scores[keep]


def place_slots(spark, places: int) -> list[int]:
    """For each place a number that Spark's hash partitioning puts there."""
    tried = spark.range(64 * places).select(F.col("id").cast("int").alias("slot"))
    found = tried.groupBy(F.pmod(F.hash("slot"), F.lit(places)).alias("place")).agg(F.min("slot").alias("slot"))
    slots = {r.place: r.slot for r in found.collect()}  # ``places`` rows
    return [slots.get(p, p) for p in range(places)]


def top_k(
    vectors: DataFrame, queries: F.Column, k: int = 5, vec_id="vec_id", vector="embedding",
    vector_rows: int = VECTORS, query_rows: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row that
    ``queries``, a condition on ``vec_id``, selects."""
    spark = vectors.sparkSession
    whole = quantised(vectors, vec_id, vector)
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = whole.filter(queries)
    # Query blocks are dealt to all places, vector blocks to one each.
    wanted = blocks(asked.repartition(max(1, -(-asked.count() // query_rows)), F.xxhash64("vec_id", "vec")), query_rows)
    wanted = wanted.select(
        "dims", F.col("ids").alias("q_ids"), F.col("vals").alias("q_values"), F.explode(F.sequence(F.lit(0), F.lit(places - 1))).alias("place")
    )
    # Vector blocks are dealt in turn: the factor of a part's number has no divisor in common with them.
    rows = blocks(whole, vector_rows).withColumn("place", F.pmod("part", F.lit(places)).cast("int"))
    slots = place_slots(spark, places)
    # Few bytes but much work: the number of places is kept, and each has a task of its own.
    rows, wanted = (
        side.withColumn("slot", F.get(F.array(*[F.lit(s) for s in slots]), F.col("place"))).repartition(places, "slot")
        for side in (rows, wanted.withColumnRenamed("dims", "q_dims"))
    )
    pairs = rows.join(wanted, "slot").filter("dims = q_dims").select("ids", "vals", "q_ids", "q_values", "dims", "part")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        last, index = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                raw_ids, raw, q_ids, q, dims, part = (batch.column(j)[i].as_py() for j in range(6))
                ids = np.frombuffer(raw_ids, "<i8")
                # Neighbours often share a block. Blocks of one number, if a task ran twice, may still differ.
                if (part, raw_ids, raw) != last:
                    index, last = ImpactIndex(np.frombuffer(raw, "<i8").reshape(len(ids), dims)), (part, raw_ids, raw)
                query_ids = np.frombuffer(q_ids, "<i8")
                found = best_of_block(index, ids, query_ids, np.frombuffer(q, "<i8").reshape(len(query_ids), dims), k)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=schema)

    found = pairs.mapInArrow(run, "query_id BIGINT, vec_id BIGINT, score BIGINT")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
