"""Tables that several jobs append to at the same time.

An append is a folder ``commit=<id>`` of Parquet files, written aside. It counts once a
numbered file of ``_commits`` names it. Numbers have no gaps, and such a file gets its name
by one rename that fails where the name is taken: of two jobs that end together, one is told
to look at what the other has added and to try the next number. Folders that no file names,
those of jobs that died, are never read.

The rename is Hadoop's ``FileContext.rename`` without overwriting, atomic on HDFS; in mounted
folders (``file:``) a hard link takes its place. On a bare object store, where a rename is a copy,
only one job may append. The driver reads one line for each append, whatever its rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS = "_commits"


def _place(spark: SparkSession, path: str):
    """The Hadoop path, with its file system."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(context._jsc.hadoopConfiguration())
    return store.makeQualified(place), store


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder has this name; a text that can't be a path has none."""
    try:
        place, store = _place(spark, path)
    except IllegalArgumentException:
        return False
    except Py4JJavaError as problem:
        if problem.java_exception.getClass().getSimpleName() != "UnsupportedFileSystemException":
            raise
        return False
    return store.exists(place)


def committed(spark: SparkSession, path: str) -> list[str]:
    """The ids of the appends that count, in order; none for a missing table."""
    folder = f"{path}/{COMMITS}"
    place, store = _place(spark, folder)
    if not store.exists(place):
        return []
    lines = spark.read.text(folder).select(F.col("_metadata.file_name").alias("number"), "value").collect()
    return [line.value for line in sorted(lines, key=lambda line: int(line.number))]


def read_commits(spark: SparkSession, path: str, schema: StructType, commits: Sequence[str]) -> DataFrame:
    """The rows of these appends."""
    if not commits:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/commit={c}" for c in commits]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)


def write_aside(df: DataFrame, path: str, *partition_by: str) -> str:
    """Write rows that do not count yet; the id to publish them by."""
    commit = f"c{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/commit={commit}")
    return commit


def publish(spark: SparkSession, path: str, commit: str, number: int) -> bool:
    """Make an append count, as the one of this number; False where another job was first."""
    context = spark.sparkContext
    target, store = _place(spark, f"{path}/{COMMITS}/{number:09d}")
    part, _ = _place(spark, f"{path}/{COMMITS}/.{commit}")
    if target.toUri().getScheme() == "file":
        return _publish_locally(part.toUri().getPath(), target.toUri().getPath(), commit)
    hadoop = context._jvm.org.apache.hadoop.fs
    out = store.create(part, True)
    try:
        out.write(bytearray(commit.encode()))
    finally:
        out.close()
    files = hadoop.FileContext.getFileContext(target.toUri(), context._jsc.hadoopConfiguration())
    no_options = context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(part, target, no_options)
    except Py4JJavaError as problem:
        store.delete(part, False)
        if problem.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def _publish_locally(part: str, target: str, commit: str) -> bool:
    """The same in a folder of the driver's own file system, or one mounted there. Hadoop looks for the
    name first and renames then, so two jobs could both succeed; a second name for a file is given at once."""
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with open(part, "w") as out:
        out.write(commit)
    try:
        os.link(part, target)
    except FileExistsError:
        return False
    finally:
        os.unlink(part)
    return True
