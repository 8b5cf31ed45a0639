"""Readers and writers. All schemas are explicit."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from snowlit.functions.text import strip
from snowlit.schemas import (
    ANSWER_DOCUMENTS,
    REFERENCE,
    REFERENCE_ROW,
    NO_TEXT,
    RESPONSES,
    TOPICS,
    WORKS,
)
from snowlit.sources.commits import committed, path_exists, publish, read_commits, write_aside

# File-name patterns.
PDF_FILES = "*.[pP][dD][fF]"
QUESTION_FILES = "*.[mM][dD]"
ANSWER_FILE = r"([^/]+)/q(\d+)\.md$"

# Tasks that write, or read, a file for each answer.
FILE_TASKS = 64

# Bytes of answers that leave such a task at once.
FILE_PIECE = 8 << 20

# Why a reference file is rejected.
BAD_REFERENCES = "not a JSON array of references"

# A stored attempt that needs no other: it has no error, or its paper no text.
FINISHED = f"error IS NULL OR error = '{NO_TEXT}'"


def or_empty(spark: SparkSession, schema: StructType | str, read: Callable[[], DataFrame]) -> DataFrame:
    """What ``read`` gives, or no rows if its path does not exist."""
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_pdfs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, length, content)`` of the PDF files in a folder (not below it), or
    among the given files; others are ignored, by suffix."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", PDF_FILES)
        .load([paths] if isinstance(paths, str) else list(paths))
        .select("path", "length", "content")
    )


def read_references(spark: SparkSession, path: str, fmt: str = "array") -> DataFrame:
    """References ``(paper_id, pos, title, doi)``; a missing path gives no rows.

    ``array``: files that hold one JSON array each, in list order; the paper is the
    file's name without suffix. ``parquet`` or ``json``: what :func:`write_references`
    stored.
    """
    if fmt != "array":
        return or_empty(
            spark, REFERENCE_ROW, lambda: spark.read.schema(REFERENCE_ROW).format(fmt).load(path)
        )
    return or_empty(
        spark,
        REFERENCE_ROW,
        lambda: _reference_files(spark, path)
        .select("paper_id", F.posexplode("refs").alias("pos", "ref"))
        .select("paper_id", "pos", "ref.title", "ref.doi"),
    )


def rejected_references(spark: SparkSession, path: str) -> DataFrame:
    """``(paper_id, error)`` of the array files that :func:`read_references` gets nothing
    from because they hold no such array."""
    bad = lambda: _reference_files(spark, path).filter("refs IS NULL")
    return or_empty(
        spark, "paper_id STRING, error STRING", lambda: bad().select("paper_id", F.lit(BAD_REFERENCES).alias("error"))
    )


def _reference_files(spark: SparkSession, path: str) -> DataFrame:
    """Paper and entries of each file, NULL where they can't be read."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.[^./]*)?$", 1)
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path, wholetext=True)
        .select(F.url_decode(name).alias("paper_id"), F.from_json("value", f"ARRAY<{REFERENCE}>").alias("refs"))
    )


def write_references(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the stored references. ``fmt`` is ``parquet`` or ``json`` (lines)."""
    df.write.mode("overwrite").format(fmt).save(path)


def read_questions(spark: SparkSession, path: str, numeric: bool = False) -> DataFrame:
    """Questions ``(q_idx, question)``: the Markdown files of a folder in path order,
    or one file; stripped. Anything else holds no questions.

    Path order puts ``q10.md`` before ``q2.md``; ``numeric`` orders by the number in
    the name first.
    """
    files = or_empty(
        spark,
        "file STRING, value STRING",
        lambda: spark.read.option("pathGlobFilter", QUESTION_FILES)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file"), "value"),
    )
    number = F.regexp_extract("file", r"(\d+)[^/\d]*$", 1).try_cast("int")
    order = [number, "file"] if numeric else ["file"]
    # The driver lists these files one by one anyway, so one task can number them.
    return files.select(
        F.row_number().over(Window.orderBy(*order)).alias("q_idx"),
        strip(F.col("value")).alias("question"),
    )


def read_question_lines(spark: SparkSession, path: str) -> DataFrame:
    """One question per non-empty line of one text file, numbered in line order."""
    lines = F.posexplode(F.split("value", r"\r?\n")).alias("line", "question")
    return (
        spark.read.text(path, wholetext=True)
        .select(lines)
        .withColumn("question", strip(F.col("question")))
        .filter("question <> ''")
        .select(F.row_number().over(Window.orderBy("line")).alias("q_idx"), "question")
    )


def collect_questions(spark: SparkSession, *sources: str | Sequence) -> DataFrame:
    """Questions ``(q_idx, question)`` from texts, Markdown files and folders of them, in any nesting of lists,
    numbered in their order.

    A string that names an existing folder stands for its Markdown files in path order, one that names
    a file for that file (if it is no Markdown file, for nothing); any other is a question as it is. The list is
    written by hand, so it is taken apart on the driver; files are read by tasks.
    """
    flat = list(_flat(sources))
    there = [bool(source.strip()) and path_exists(spark, source) for source in flat]
    texts = [(i, 1, source) for i, source in enumerate(flat) if not there[i]]
    parts = [spark.createDataFrame(texts, "source INT, place INT, question STRING")]
    parts += [
        read_questions(spark, source).select(F.lit(i).alias("source"), F.col("q_idx").alias("place"), "question")
        for i, source in enumerate(flat) if there[i]
    ]
    number = F.row_number().over(Window.orderBy("source", "place"))
    return reduce(DataFrame.unionAll, parts).select(number.alias("q_idx"), "question")


def _flat(sources: str | Sequence) -> Iterator[str]:
    if isinstance(sources, str):
        yield sources
    else:
        for source in sources:
            yield from _flat(source)


def write_questions(df: DataFrame, path: str) -> None:
    """Save the numbered questions, one folder per number."""
    df.select("q_idx", "question").write.mode("overwrite").partitionBy("q_idx").text(path)


def read_saved_questions(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_questions` saved."""
    return (
        spark.read.schema("value STRING, q_idx INT")
        .text(path, wholetext=True)
        .select("q_idx", F.regexp_replace("value", r"\n\z", "").alias("question"))
    )


def file_name(paper_id: str) -> str:
    """A paper's id as the name of a folder; :func:`read_answer_files` undoes it. The signs that
    part names, and names that are dots only, are written as percent codes."""
    name = paper_id.replace("%", "%25").replace("/", "%2F")
    return name.replace(".", "%2E") if name.strip(".") == "" else name


def read_answer_files(spark: SparkSession, path: str) -> DataFrame:
    """Saved answer documents ``(paper_id, q_idx, value)`` from ``<paper>/q<n>.md``
    files at any depth. A missing folder holds none."""
    # Paths come with percent codes, but with a plain plus sign.
    file = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    paper = F.url_decode(F.regexp_extract(file, ANSWER_FILE, 1))
    for sign in ("/", ".", "%"):
        paper = F.replace(paper, F.lit(f"%{ord(sign):02X}"), F.lit(sign))

    def read() -> DataFrame:
        return (
            spark.read.option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.md")
            .text(path, wholetext=True)
            .select(paper.alias("paper_id"), F.regexp_extract(file, ANSWER_FILE, 2).try_cast("int").alias("q_idx"), "value")
            .filter("q_idx IS NOT NULL")
        )

    return or_empty(spark, ANSWER_DOCUMENTS, read)


def export_answer_files(documents: DataFrame, path: str) -> int:
    """Write documents ``(paper_id, q_idx, value)`` as the ``<paper>/q<n>.md`` files that
    :func:`read_answer_files` takes, from the tasks; the number of files written.

    Files are for people. Tables of answers go to :func:`write_responses`, rendered documents to
    :func:`write_documents`, which pack many into a file. ``path`` is a folder that all executors reach
    and pyarrow can open. A file appears whole or not at all, and a task that runs again replaces its
    files. Of several documents of one key the greatest is written; those without a key are left out, and an empty one is an empty file, of which Spark reads no row.
    The number of tasks is given, for opening files takes longer than their bytes let Spark expect.
    """
    keys = [F.col("paper_id").cast("string").alias("paper_id"), F.col("q_idx").cast("int").alias("q_idx")]
    keyed = documents.dropna(subset=["paper_id", "q_idx", "value"]).select(*keys, "value")
    one = keyed.repartition(FILE_TASKS, "paper_id").groupBy("paper_id", "q_idx").agg(F.max("value").alias("value"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(path)
        made = set()
        for batch in batches:
            for paper, number, value in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                folder = f"{root}/{file_name(paper)}"
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                name = f"{folder}/q{number}.md"
                part = f"{name}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as out:
                    out.write(value.encode())
                store.move(part, name)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return one.mapInArrow(write, "n BIGINT").agg(F.sum("n")).first()[0] or 0


def read_exported_answers(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`export_answer_files` wrote, under the same terms; a missing folder holds none.

    Spark's file sources list every folder in a task of its own and keep all files in the driver. Here
    each task looks at the names of the papers' folders and lists and reads those of its share.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(path)
        for batch in batches:
            for share in batch.column(0).to_pylist():
                rows, size = [], 0
                for folder in store.get_file_info(pa_fs.FileSelector(root, allow_not_found=True)):
                    if folder.type != pa_fs.FileType.Directory or zlib.crc32(folder.base_name.encode()) % FILE_TASKS != share:
                        continue
                    paper = paper_of(folder.base_name)
                    for file in store.get_file_info(pa_fs.FileSelector(folder.path)):
                        number = re.fullmatch(r"q(-?\d+)\.md", file.base_name)
                        if number is None:
                            continue
                        with store.open_input_stream(file.path) as content:
                            value = content.read()
                        rows.append((paper, int(number[1]), value.decode("utf-8", "replace")))
                        size += len(value)
                        if size > FILE_PIECE:
                            yield documents(rows)
                            rows, size = [], 0
                yield documents(rows)

    def documents(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
        kinds = {"paper_id": pa.string(), "q_idx": pa.int32(), "value": pa.string()}
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds.values())]
        return pa.RecordBatch.from_arrays(columns, names=list(kinds))

    return spark.range(0, FILE_TASKS, 1, FILE_TASKS).mapInArrow(read, "paper_id STRING, q_idx INT, value STRING")


def paper_of(name: str) -> str:
    """The paper whose :func:`file_name` this is."""
    return name.replace("%2F", "/").replace("%2E", ".").replace("%25", "%")


def opened(path: str) -> tuple[pa_fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pa_fs.FileSystem.from_uri(path.rstrip("/"))
    return pa_fs.LocalFileSystem(), path.rstrip("/")


def write_documents(documents: DataFrame, path: str) -> None:
    """Append rendered documents ``(paper_id, q_idx, value)``, many to a file."""
    documents.select("paper_id", "q_idx", "value").write.mode("append").parquet(path)


def read_documents(spark: SparkSession, path: str, schema: StructType | str = ANSWER_DOCUMENTS) -> DataFrame:
    """What :func:`write_documents` stored; a missing folder holds none."""
    return or_empty(spark, schema, lambda: spark.read.schema(schema).parquet(path))


def write_answer_files(documents: DataFrame, path: str) -> None:
    """Add rendered documents ``(paper_id, q_idx, value)``, a folder with one file for each.
    They are for people to read; tables of answers go to :func:`write_responses`."""
    documents.select("paper_id", "q_idx", "value").write.mode("append").partitionBy("paper_id", "q_idx").text(path)


def read_written_answers(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_answer_files` wrote; a missing folder holds none."""
    read = lambda: spark.read.schema("value STRING, paper_id STRING, q_idx INT").text(path, wholetext=True)
    return or_empty(spark, ANSWER_DOCUMENTS, lambda: read().select(
        "paper_id", "q_idx", F.regexp_replace("value", r"\n\z", "").alias("value")
    ))


def _keys(columns: Sequence[str]) -> list[str]:
    """What tells answers apart: paper and question, and the page where there is one."""
    return [c for c in ("paper_id", "page_no", "q_idx") if c in columns]


def read_responses(spark: SparkSession, path: str, schema: StructType | str = RESPONSES) -> DataFrame:
    """The finished answers, those skipped for want of text included; a missing table is
    empty. Failed attempts are not answers, see :func:`read_failures`. Answers about pages
    have a ``page_no`` in their schema."""
    attempts = _attempts(spark, path, schema)
    # The partition column comes last on disk; give the columns back in order.
    return attempts.filter(FINISHED).select(*_keys(attempts.columns), "response", "skipped")


def _attempts(spark: SparkSession, path: str, schema: StructType | str, commits: Sequence[str] | None = None) -> DataFrame:
    """All that was stored, or what these appends stored, with ``error``."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if "error" not in schema.names:
        schema = StructType([*schema.fields]).add("error", "string")
    return read_commits(spark, path, schema, committed(spark, path) if commits is None else commits)


def read_failures(spark: SparkSession, path: str, schema: StructType | str = RESPONSES) -> DataFrame:
    """The keys and the ``error`` of what failed and has no answer yet."""
    attempts = _attempts(spark, path, schema)
    return (
        attempts.groupBy(*_keys(attempts.columns))
        .agg(F.bool_or(F.expr(FINISHED)).alias("finished"), F.max("error").alias("error"))
        .filter("NOT finished").drop("finished")
    )


def write_responses(df: DataFrame, path: str) -> None:
    """Append answers, one per (paper, question), or per page of it where there is a
    ``page_no``; pairs already answered stay as they are. A row with an ``error`` other than a missing text is stored as a failed attempt:
    the pair stays open and may be answered later. Of the stored table only the keys and
    errors are read. Of several rows of one key a finished one is stored rather than a failed one,
    whatever their order, then the one with the least response.

    Several jobs may append at the same time: rows are written aside and published at once. If another
    job has published meanwhile, the keys that it has answered are taken out of the rows first, so each
    key keeps one answer, that which was published first, and none is lost."""
    keys = _keys(df.columns)
    columns = [*keys, "response", "skipped", "error"]
    if "error" not in df.columns:
        df = df.withColumn("error", F.lit(None).cast("string"))
    spark, schema = df.sparkSession, df.select(*columns).schema
    best = Window.partitionBy(*keys).orderBy(F.coalesce(F.expr(FINISHED), F.lit(False)).desc(), "skipped", "response", "error")
    repeated = F.lag(F.lit(True)).over(best).isNotNull()
    rows = df.select(*columns, repeated.alias("_repeated")).filter("NOT _repeated").select(*columns)

    def answered(commits: Sequence[str]) -> DataFrame:
        return _attempts(spark, path, schema, commits).filter(FINISHED).select(*keys)

    seen = committed(spark, path)
    mine = write_aside(rows.join(answered(seen), keys, "left_anti").select(*columns), path, "q_idx")
    while not publish(spark, path, mine, len(seen)):
        before, seen = len(seen), committed(spark, path)
        others = answered(seen[before:])
        rows = _attempts(spark, path, schema, [mine])
        if not rows.select(*keys).join(others, keys, "left_semi").isEmpty():
            mine = write_aside(rows.join(others, keys, "left_anti").select(*columns), path, "q_idx")


def read_works(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The works catalogue, Parquet or JSON lines."""
    return spark.read.schema(WORKS).format(fmt).load(path)


def write_papers(papers: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store papers ``(paper_id, ...)`` as a table of the catalog, bucketed by their id, in the
    warehouse or at ``path``.

    Joins with lists of papers, such as those that are finished, then shuffle the list only and no
    text. Take at least as many buckets as there are shuffle partitions.
    """
    writer = papers.repartition(buckets, "paper_id").write.mode("overwrite").bucketBy(buckets, "paper_id")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return papers.sparkSession.table(table)


def read_topics(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(TOPICS).format(fmt).load(path)
