"""Incremental forms of the batch jobs.

All run with ``trigger(availableNow=True)`` by default use: process what is new,
then stop. Checkpoint folders must be on shared storage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from snowlit.checkpoints import work_path, write_step
from snowlit.functions.doi import doi_key, has_doi
from snowlit.operators.questions import all_pairs, ask_numbers, open_numbers, question_blocks
from snowlit.sources.files import FINISHED, PDF_FILES, or_empty

# Hash partitions of the tables that streams ask what is known; fixed, for stored tables have it.
KEY_PARTS = 64

# Tasks that write an append to such a table.
WRITERS = 16

# Lists of keys that a run of a stream keeps of one size before it makes one of them.
KEY_LISTS = 16

BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def ingest_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """PDF files as they appear in a folder; the checkpoint remembers those done."""
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", PDF_FILES)
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        .select("path", "length", "content")
    )


def dedup_stream(df: DataFrame, time: str, delay: str, case_sensitive: bool = False) -> DataFrame:
    """First sighting of each DOI. State lasts ``delay`` past the watermark, so a DOI
    seen again after a longer pause is emitted again."""
    return (
        df.filter(has_doi(F.col("doi")))
        .withColumn("doi_key", doi_key(F.col("doi"), case_sensitive))
        .withWatermark(time, delay)
        .dropDuplicatesWithinWatermark(["doi_key"])
    )


def key_part(key: Column) -> Column:
    """The partition of a key in a table of :data:`KEY_PARTS` partitions."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(KEY_PARTS)).cast("int")


def parts_of(keys: DataFrame, key: str) -> list[int]:
    """The partitions that these keys fall into, at most :data:`KEY_PARTS`."""
    return [r[0] for r in keys.select(key_part(F.col(key))).distinct().collect()]


def stored_in(spark: SparkSession, path: str, parts: Sequence[int], schema: StructType) -> DataFrame:
    """What a table stored in folders ``key_part=<n>`` has in these; only they are listed and read."""
    if not parts:
        return spark.createDataFrame([], schema)
    folders = f"{path}/key_part={{{','.join(map(str, parts))}}}"
    stored = or_empty(spark, schema, lambda: spark.read.schema(schema).option("basePath", path).parquet(folders))
    return stored.select(*schema.names)


def known(keys: DataFrame, key: str, path: str, schema: StructType) -> DataFrame:
    """What a table stored in folders ``key_part=<n>`` has of the given keys. Only the folders
    that a key falls into are listed and read."""
    stored = stored_in(keys.sparkSession, path, parts_of(keys, key), schema)
    return stored.join(keys.select(key).distinct(), key, "left_semi")


class KnownKeys:
    """What a table in folders ``key_part=<n>`` has of any keys, for one run of a stream that alone appends to it.

    A partition of the table is read once, when the first key falls into it; its keys, and those that the run
    itself appends, are lists in the work folder. :data:`KEY_LISTS` lists of one size become one of the
    next, so a run of n micro-batches reads some log(n) lists in each, not all files that the earlier
    ones have appended. The table stays what counts: a new run starts from it.
    """

    def __init__(self, spark: SparkSession, key: str, path: str, schema: StructType, where: str = "true"):
        self.spark, self.key, self.path, self.schema, self.where = spark, key, path, schema, where
        self.parts: set[int] = set()
        self.lists: list[list[str]] = []

    def append(self, rows: DataFrame) -> None:
        """Append rows to the table and to what is known. They are made once."""
        aside = work_path(self.spark, "key-list")
        append_by_key(write_step(rows, aside), self.key, self.path)
        self._keep(aside, 0)

    def of(self, keys: DataFrame) -> DataFrame:
        """The rows of the given keys, each of which is there once; stored."""
        new = [] if len(self.parts) == KEY_PARTS else sorted(set(parts_of(keys, self.key)) - self.parts)
        if new:
            stored = stored_in(self.spark, self.path, new, self.schema)
            self._keep(self._packed(stored), 0)
            self.parts.update(new)
        rows = self._read([path for level in self.lists for path in level])
        found = rows.join(keys.select(self.key), self.key, "left_semi").select(*self.schema.names)
        return write_step(found, work_path(self.spark, "known-keys"))

    def _read(self, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths).filter(self.where)

    def _packed(self, rows: DataFrame) -> str:
        """The columns of the schema, in as many files as they need, whatever the number they come from."""
        path = work_path(self.spark, "key-list")
        rows.filter(self.where).select(*self.schema.names).repartition(F.col(self.key)).write.parquet(path)
        return path

    def _keep(self, path: str, level: int) -> None:
        if level == len(self.lists):
            self.lists.append([])
        self.lists[level].append(path)
        if len(self.lists[level]) == KEY_LISTS:
            full, self.lists[level] = self.lists[level], []
            self._keep(self._packed(self._read(full)), level + 1)


def append_by_key(df: DataFrame, key: str, path: str) -> None:
    """Append to such a table, each partition from one task of the write. The number of tasks is given, for
    opening so many files takes longer than their bytes let Spark expect."""
    part = key_part(F.col(key)).alias("key_part")
    df.select("*", part).repartition(WRITERS, "key_part").write.mode("append").partitionBy("key_part").parquet(path)


def first_seen_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    time: str | None = None,
    delay: str | None = None,
    case_sensitive: bool = False,
) -> StreamingQuery:
    """Keep a table of all DOIs ever seen, each once, by ``doi_key``, however long ago it was.

    A micro-batch asks the table for its own keys and appends the others, so there is no state and
    a replayed batch, or a lost checkpoint, adds nothing twice. With ``time`` and ``delay``, DOIs
    that return within the delay are dropped by keyed state first (:func:`dedup_stream`), which expires; the
    table is then asked for the rest only, at the price of rows that come later than the delay: those are lost.
    Of several rows of one DOI in a batch, any one stays. One stream per table.
    """
    if time is not None:
        fresh = dedup_stream(stream, time, delay, case_sensitive)
    else:
        fresh = stream.filter(has_doi(F.col("doi"))).withColumn("doi_key", doi_key(F.col("doi"), case_sensitive))
    schema = StructType([fresh.schema["doi_key"]])
    seen = KnownKeys(stream.sparkSession, "doi_key", path, schema)

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = write_step(batch.dropDuplicates(["doi_key"]), work_path(seen.spark, "first-seen"))
        seen.append(rows.join(seen.of(rows), "doi_key", "left_anti"))

    return (
        fresh.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def windowed_status(log: DataFrame, time: str = "ts", window: str = "1 hour") -> DataFrame:
    """Outcome counts per tumbling window; the same on a batch and on a stream."""
    return (
        log.groupBy(F.window(time, window).alias("w"), "status")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "status", "n")
    )


def status_stream(log: DataFrame, time: str, window: str, delay: str) -> DataFrame:
    """:func:`windowed_status` over a stream; rows later than ``delay`` are dropped."""
    return windowed_status(log.withWatermark(time, delay), time, window)


def append_table(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Append a stream to a Parquet table (exactly once, by the sink's own log)."""
    return (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def replace_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep a Parquet table equal to a complete-mode aggregate. For aggregates whose
    result stays small, such as counts per window."""
    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return (
        stream.writeStream.foreachBatch(replace)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def answer_stream(
    papers: DataFrame,
    questions: DataFrame,
    path: str,
    checkpoint: str,
    respond: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """Answer every question for each new paper, once.

    ``respond`` turns pending pairs into rows with ``paper_id``, ``q_idx`` and more.
    Nothing stored is ever overwritten: a micro-batch leaves out the pairs that any batch
    has answered, itself included, and appends the rest. So a
    replayed batch adds only what is missing, and a lost checkpoint, with other files in
    other batches, loses no answer. Rows with an ``error`` do not count as answers. Answers are
    stored in folders ``key_part=<n>`` by a hash of the paper; a run reads the keys of those of its
    papers once, see :class:`KnownKeys`, and the question list once. One stream per table.
    """
    spark = papers.sparkSession
    key = (
        StructType([papers.schema["paper_id"]])
        .add("q_idx", IntegerType())
        .add("error", "string")
    )

    seen = KnownKeys(spark, "paper_id", path, key, FINISHED)
    blocks = question_blocks(questions)

    def run(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropna(subset=["paper_id"]).dropDuplicates(["paper_id"])
        fresh = write_step(fresh, work_path(spark, "new-papers"))
        done = seen.of(fresh)
        if done.isEmpty():
            pending = all_pairs(fresh, blocks)
        else:
            left = open_numbers(fresh, blocks, done)
            if left.isEmpty():
                return
            pending = ask_numbers(fresh, blocks, left)
        seen.append(respond(pending))

    return (
        papers.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def as_utc_instant(ntz: Column) -> Column:
    """A wall-clock column read as UTC, whatever the session's zone is."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ntz).cast("timestamp")


def as_utc_wall_clock(instant: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session's zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
