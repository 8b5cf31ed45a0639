"""Corpora of token ids on disk: blocks of Simple-8b words in ascending document order.

Documents are dealt by ranges of their id, so shard k holds smaller ids than shard k + 1,
and each task sorts and encodes its shard. A shard's rows are blocks (see ``simple8b``)
with the ids of their documents, written by Spark as Parquet, so a retried or lost task
leaves no half-written file. Reading adds the totals of the shards before (a number per
shard) to each shard's own running count.

Defined cases. Null or empty text: only the end id. Null doc_id: first, before all others.
Repeated ids: neighbours, ordered by a hash of the text. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snowlit.llm import simple8b
from snowlit.llm.common import slices, type_of
from snowlit.llm.tokens import encoder

# A block is closed when it holds this many ids.
BLOCK_IDS = 1 << 18


def encode_shards(docs: DataFrame, path: str, end_id: int, doc_id="doc_id", text="text", block_ids: int = BLOCK_IDS) -> DataFrame:
    """(shard, block, doc_ids, payload): all documents as blocks, shards in id order."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    hashed = F.xxhash64("text")
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), hashed).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), hashed
    )
    schema = T._parse_datatype_string(f"shard INT, block INT, doc_ids array<{type_of(rows, 'doc_id')}>, payload BINARY")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, end_id)
        shard, block, ids, documents, held = TaskContext.get().partitionId(), 0, [], [], 0

        def close():
            return pa.RecordBatch.from_pylist(
                [{"shard": shard, "block": block, "doc_ids": ids, "payload": simple8b.pack_block(documents)}], schema=arrow
            )

        for batch in batches:
            for piece in slices(batch):
                for key, raw in zip(piece.column(0).to_pylist(), encode(piece.column(1).to_pylist())):
                    ids.append(key)
                    documents.append(np.frombuffer(raw, "<u4"))
                    held += len(documents[-1])
                    if held >= block_ids:
                        yield close()
                        block, ids, documents, held = block + 1, [], [], 0
        if ids:
            yield close()

    return ordered.mapInArrow(run, schema)


def decode_shards(shards: DataFrame) -> DataFrame:
    """(shard, block, n, doc_id, n_before, n_tokens, ids_crc32): the documents of each block."""
    key = shards.schema["doc_ids"].dataType.elementType.simpleString()
    schema = T._parse_datatype_string(
        f"shard INT, block INT, nth INT, doc_id {key}, block_start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT"
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, starts = simple8b.unpack_block(row["payload"])
                raw = memoryview(ids.astype("<u4").tobytes())
                at = starts.tolist()
                n = len(at) - 1
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip([
                    [row["shard"]] * n, [row["block"]] * n, range(n), row["doc_ids"], at[:-1],
                    [b - a for a, b in zip(at, at[1:])],
                    [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at[1:])],
                ], arrow)], schema=arrow)

    return shards.select("shard", "block", "doc_ids", "payload").mapInArrow(run, schema)


def documents_of(decoded: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before each one. ``decoded`` is stored."""
    blocks = decoded.groupBy("shard", "block").agg(F.sum("n_tokens").alias("n"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    # One number for each shard; the shards are as many as tasks.
    totals = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    offsets = blocks.join(bases, "shard").select("shard", "block", (F.col("base") + F.col("before")).alias("base"))
    return decoded.join(offsets, ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("block_start")).alias("start"), "n_tokens", "ids_crc32"
    )
