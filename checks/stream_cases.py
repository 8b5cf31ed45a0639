"""Streaming jobs, run to completion over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.cases import case
from snowlit.checkpoints import work_path
from snowlit.streaming.jobs import (
    answer_stream,
    append_table,
    as_utc_instant,
    as_utc_wall_clock,
    dedup_stream,
    first_seen_table,
    replace_table,
    status_stream,
    windowed_status,
)

BY_HOUR = """
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, status,
           count(*) AS n
    FROM download_log GROUP BY 1, 2
"""


def shown(df):
    start = F.date_format(as_utc_wall_clock(F.col("window_start")), "yyyy-MM-dd HH:mm:ss")
    return df.select(start.alias("window_start"), "status", "n")


def with_instant(df):
    return df.withColumn("ts", as_utc_instant(F.col("ts")))


def stream_of(t, table):
    """A base table as a file stream, whether it is one file or a folder of files.

    The path is a pattern that only the table's own name matches: a stream takes a plain path for a folder.
    """
    return t.spark.readStream.schema(getattr(t, table).schema).parquet(f"{t.sf_dir}/{table}.parque[t]")


def log_stream(t):
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "ERROR").when(kind == "view", "NOT_OPEN_ACCESS").otherwise("SUCCESS")
    )
    doi = F.concat(F.lit("10.5555/w"), F.col("user_id").cast("string"))
    return with_instant(stream_of(t, "events")).select(
        "event_id", "ts", doi.alias("doi"), status.alias("status")
    )


@case("status_by_hour", views="download_log", sql=BY_HOUR)
def _(t):
    return shown(windowed_status(with_instant(t.download_log)))


@case("status_by_hour_stream", views="download_log", sql=BY_HOUR)
def _(t):
    base = work_path(t.spark, "status")
    counts = status_stream(log_stream(t), "ts", "1 hour", "31 days")
    replace_table(counts, f"{base}/table", f"{base}/progress").awaitTermination()
    return shown(t.spark.read.parquet(f"{base}/table"))


@case("first_seen_stream", views="download_log", sql="SELECT DISTINCT lower(doi) AS doi_key FROM download_log")
def _(t):
    base = work_path(t.spark, "first-seen")
    fresh = dedup_stream(log_stream(t), "ts", "31 days").select("doi_key")
    append_table(fresh, f"{base}/table", f"{base}/progress").awaitTermination()
    return t.spark.read.schema("doi_key STRING").parquet(f"{base}/table")


@case("first_seen_ever", views="download_log", sql="SELECT DISTINCT lower(doi) AS doi_key FROM download_log")
def _(t):
    # The log comes in four batches, then once more with a new checkpoint.
    base = work_path(t.spark, "first-seen-ever")
    log = t.download_log
    log.repartitionByRange(4, "ts").write.parquet(f"{base}/log")
    for progress in ("progress", "new"):
        stream = t.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/log")
        first_seen_table(stream, f"{base}/table", f"{base}/{progress}").awaitTermination()
    return t.spark.read.schema("doi_key STRING").parquet(f"{base}/table").select("doi_key")


@case("answer_stream", views="papers questions", sql="""
    SELECT p.paper_id, q.q_idx, 'q' || q.q_idx || ' on ' || p.paper_id AS response
    FROM papers p, questions q
""")
def _(t):
    base = work_path(t.spark, "answers")
    papers = stream_of(t, "documents").select(F.col("doc_id").alias("paper_id"))

    def respond(pending):
        q, p = F.col("q_idx").cast("string"), F.col("paper_id").cast("string")
        return pending.select(
            "paper_id", "q_idx", F.concat(F.lit("q"), q, F.lit(" on "), p).alias("response")
        )

    answer_stream(papers, t.questions, f"{base}/table", f"{base}/progress", respond).awaitTermination()
    return (
        t.spark.read.schema("paper_id BIGINT, q_idx INT, response STRING")
        .parquet(f"{base}/table")
        .select("paper_id", "q_idx", "response")
    )


@case("answer_stream_restart", views="papers questions", sql="""
    SELECT p.paper_id, q.q_idx, 'read' AS response FROM papers p, questions q
""")
def _(t):
    # Two halves of the papers arrive one after the other; then the checkpoint is lost, and
    # only the second half is left to read. No stored answer may go.
    base = work_path(t.spark, "restarted")
    papers = t.papers.select("paper_id")
    halves = [papers.filter(F.pmod("paper_id", F.lit(2)) == i) for i in (0, 1)]

    def respond(pending):
        return pending.select("paper_id", "q_idx", F.lit("read").alias("response"))

    def run(folder, progress):
        stream = t.spark.readStream.schema("paper_id BIGINT").option("maxFilesPerTrigger", 1).parquet(folder)
        answer_stream(stream, t.questions, f"{base}/table", f"{base}/{progress}", respond).awaitTermination()

    halves[0].write.mode("append").parquet(f"{base}/all")
    run(f"{base}/all", "progress")
    halves[1].write.mode("append").parquet(f"{base}/all")
    run(f"{base}/all", "progress")
    halves[1].write.parquet(f"{base}/left")
    run(f"{base}/left", "new")
    return (
        t.spark.read.schema("paper_id BIGINT, q_idx INT, response STRING")
        .parquet(f"{base}/table").select("paper_id", "q_idx", "response")
    )
