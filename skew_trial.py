"""Run the skew-prone jobs on made-up tables in which one key holds a third of the rows.

    python skew_trial.py [millions of rows]

Not a test and not a benchmark query: it prints, per job, the time and how evenly
the rows of the largest join or grouping were spread (largest share / mean share).
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.compare import spark_session
from snowlit.operators import skew
from snowlit.operators.citations import snowball
from snowlit.operators.pages import chunk_pages, number_rows
from snowlit.operators.postings import cap_per_term, match_saved_searches
from snowlit.operators.resolve import classify_download
from snowlit.operators.skew import hot_keys, split_join


def spread(df: DataFrame) -> float:
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / (sum(sizes) / len(sizes))


def timed(name: str, make) -> None:
    start = time.perf_counter()
    note = make()
    print(f"{name}: {time.perf_counter() - start:.1f}s {note or ''}", flush=True)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    rows = int(float(sys.argv[1] if len(sys.argv) > 1 else 10) * 1_000_000)
    spark = spark_session("8", {
        "spark.sql.autoBroadcastJoinThreshold": "1m",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.enabled": "false",
    })
    skew.ROWS_PER_SPLIT = rows // 30
    hot = F.col("id") % 3 == 0
    edges = spark.range(rows).select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 500_000).alias("src"),
        F.col("id").alias("pos"),
        ((F.col("id") * 7919) % 1_000_000).alias("dst"),
    )
    nodes = spark.range(1_000_000).toDF("src")

    def plain():
        conf = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        note = f"spread {spread(edges.join(nodes, 'src')):.2f}"
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
        return note

    timed("plain join", plain)
    keys = hot_keys(edges, "src", rows // 30)
    timed("split join", lambda: f"spread {spread(split_join(edges, nodes, 'src', ['dst'], keys)):.2f}")
    seeds = spark.range(0, 100_000, 10).toDF("doi")
    timed("snowball to depth 3", lambda: f"{snowball(seeds, edges, 3).count()} works")

    doi = F.concat(F.lit("10.1/"), F.when(hot, F.lit(1)).otherwise(F.col("id")).cast("string"))
    dois = spark.range(rows // 4).select(F.col("id").alias("pos"), F.when(F.col("id") % 5 > 0, doi).alias("doi"))
    works = spark.range(rows // 8).select(
        F.concat(F.lit("10.1/"), F.col("id").cast("string")).alias("doi"),
        F.lit("A title").alias("title"),
        F.struct(F.lit("u").alias("pdf_url")).alias("primary_location"),
    )
    crawl = works.select("doi", F.lit(200).alias("http_status"), F.lit(True).alias("body_is_pdf"))
    timed("classify downloads", lambda: run(classify_download(dois, works, crawl)))

    postings = spark.range(rows // 2).select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 1000).cast("string"))).alias("term"),
        F.concat(F.lit("10.1/"), F.col("id").cast("string")).alias("doi"),
    )
    timed("cap per term", lambda: run(cap_per_term(postings, 1000)))
    searches = spark.createDataFrame(
        [(1, "hot", True), (2, "t5", True), (2, "hot", False), (3, "t7", False)],
        "search_id INT, term STRING, required BOOLEAN",
    )
    timed("saved searches", lambda: run(match_saved_searches(postings, searches, hot=hot_keys(postings, "term"))))

    pages = spark.range(rows // 10).select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 5000).alias("paper_id"),
        F.col("id").alias("page_no"),
        F.lit("ten words on every page of every one of them").alias("text"),
    )
    timed("number pages", lambda: f"spread {spread(number_rows(pages, ['paper_id'], 'page_no')):.2f}")
    timed("chunk pages", lambda: run(chunk_pages(pages, 4096)))


if __name__ == "__main__":
    main()
