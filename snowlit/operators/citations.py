"""The citation graph as an edge table ``(src, pos, dst)``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from snowlit.checkpoints import work_path, write_step
from snowlit.functions.doi import graph_key
from snowlit.operators.resolve import SUCCESS
from snowlit.operators.skew import hot_keys, join_dealt, split_join
from snowlit.schemas import with_field


def expand_citations(frontier: DataFrame, citations: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """One hop: everything the ``doi`` column of ``frontier`` cites, repeats kept.
    DOIs meet by their key and are shown as the edges spell them."""
    edges = citations.filter(F.col("dst").isNotNull()).select(
        "src", "pos", "dst", graph_key(citations, "src", case_sensitive).alias("_key")
    )
    start = frontier.select(graph_key(frontier, "doi", case_sensitive).alias("_key"))
    return split_join(edges, start, "_key", ["pos", "dst"], hot_keys(edges, "_key")).drop("_key")


def _done(log: DataFrame, case_sensitive: bool) -> DataFrame:
    """The keys with a successful download, once each."""
    good = log.filter(F.col("status") == SUCCESS)
    return good.select(graph_key(good, "doi", case_sensitive).alias("_key")).distinct()


def frontier_ok(frontier: DataFrame, log: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Keep the works whose download succeeded at least once."""
    key = graph_key(frontier, "doi", case_sensitive)
    return frontier.withColumn("_key", key).join(_done(log, case_sensitive), "_key", "left_semi").drop("_key")


@dataclass(frozen=True)
class Edges:
    """The distinct edges ``(src, dst, m)`` by key, ``m`` the number of copies, stored in buckets of
    ``src``. Where ``hot`` lists sources with very many of them, these are dealt over splits and the
    buckets are of ``(src, _split)``."""

    edges: DataFrame
    hot: DataFrame
    buckets: int

    def of(self, frontier: DataFrame) -> DataFrame:
        """The edges that leave the ``doi`` of a frontier without repeats. Edges stay in their buckets."""
        start = frontier.withColumnRenamed("doi", "src")
        if "_split" not in self.edges.columns:
            return self.edges.join(start, "src")
        return join_dealt(self.edges, start, "src", self.hot)


def _in_buckets(df: DataFrame, table: str, columns: Sequence[str], buckets: int, path: str | None, **options) -> None:
    """Append to a bucketed table of the catalog, in the warehouse or at ``path``."""
    writer = df.write.mode("append").bucketBy(buckets, *columns)
    if "partition" in options:
        writer = writer.partitionBy(options["partition"])
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def _store_edges(citations: DataFrame, table: str, buckets: int, case_sensitive: bool, path: str | None) -> Edges:
    """Distinct edges as a bucketed table and, beside it, ``<table>_hot``."""
    spark = citations.sparkSession
    keyed = citations.select(*[graph_key(citations, c, case_sensitive).alias(c) for c in ("src", "dst")]).filter(
        F.col("src").isNotNull() & F.col("dst").isNotNull()
    )
    # Keys cost more than a table of them: they are made once, then counted and dealt.
    edges = write_step(keyed.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m")), work_path(spark, "edges"))
    found = hot_keys(edges, "src")
    source = edges.schema["src"].dataType.simpleString()
    hot = found if found is not None else spark.createDataFrame([], f"_hot {source}, _splits INT")
    by = ["src"]
    if found is not None:
        split = F.pmod(F.xxhash64("dst"), F.coalesce("_splits", F.lit(1))).cast("int")
        edges = edges.join(hot, F.col("src") == F.col("_hot"), "left").select("src", split.alias("_split"), "dst", "m")
        by = ["src", "_split"]
    _in_buckets(edges.repartition(buckets, *by), table, by, buckets, path and f"{path}/edges")
    writer = hot.write.mode("append")
    (writer if path is None else writer.option("path", f"{path}/hot")).saveAsTable(f"{table}_hot")
    return Edges(spark.table(table), spark.table(f"{table}_hot"), buckets)


def _edge_table(citations: DataFrame | Edges, work: Tables, case_sensitive: bool) -> Edges:
    """Narrow, and made once for all levels."""
    if isinstance(citations, Edges):
        return citations
    return _store_edges(citations, work.name("edges"), work.buckets, case_sensitive, f"{work.base}/citations")


class Tables:
    """Bucketed tables of one run, below the shared folder. Their entries in the catalog go when
    the run ends; the files stay."""

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None):
        self.spark, self.base = spark, work_path(spark, name)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._id, self._names = self.base.rsplit("-", 1)[-1], []

    def name(self, what: str) -> str:
        name = f"{what}_{self._id}"
        self._names += [name, f"{name}_hot"]
        return name

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *_) -> None:
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_citations(citations: DataFrame, table: str, buckets: int, case_sensitive: bool = False) -> Edges:
    """Store the edges by key as a table of the catalog, bucketed by source, the sources with
    very many edges over several buckets; beside it ``<table>_hot``, the list of these.

    :func:`snowball` and :func:`snowball_walks` take the result in place of the edges and
    never shuffle an edge then. They have to treat case as this call does.
    """
    spark = citations.sparkSession
    for name in (table, f"{table}_hot"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    _store_edges(citations, table, buckets, case_sensitive, None)
    return read_citations(spark, table)


def read_citations(spark: SparkSession, table: str) -> Edges:
    """What :func:`write_citations` stored."""
    described = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    return Edges(spark.table(table), spark.table(f"{table}_hot"), int(described.data_type))


def _seed_keys(seeds: DataFrame, case_sensitive: bool) -> DataFrame:
    return seeds.select(graph_key(seeds, "doi", case_sensitive).alias("doi")).filter("doi IS NOT NULL")


def snowball(
    seeds: DataFrame,
    citations: DataFrame | Edges,
    depth: int | None = 1,
    log: DataFrame | None = None,
    case_sensitive: bool = False,
) -> DataFrame:
    """Works reached from ``seeds`` over 1..depth citations, with the first level;
    without a depth, all that can be reached.

    Works are told apart by the key of their DOI, which is also what the result shows.
    A work is expanded when first reached and never again, so cycles cost nothing.
    Edges, levels and downloads are kept in buckets of the same keys, so a level shuffles
    only what it cites (distinct before the shuffle), and no edge and no earlier level again; the
    loop ends when a level finds nothing new. With ``log``, only successfully downloaded works
    are expanded. A seed is in the result if something cites it.
    """
    spark = seeds.sparkSession
    start = _seed_keys(seeds, case_sensitive).distinct()
    if depth is not None and depth < 1:
        return start.limit(0).withColumn("level", F.lit(0))
    with Tables(spark, "snowball", citations.buckets if isinstance(citations, Edges) else None) as work:
        edges = _edge_table(citations, work, case_sensitive)
        done = None
        if log is not None:
            name = work.name("done")
            _in_buckets(_done(log, case_sensitive).withColumnRenamed("_key", "doi"), name, ["doi"], work.buckets, f"{work.base}/done")
            done = spark.table(name)
        found, path = work.name("found"), f"{work.base}/found"
        frontier, level = start, 0
        while depth is None or level < depth:
            level += 1
            cited = _next_level(edges, frontier, spark.table(found) if level > 1 else None, done)
            _in_buckets(cited.withColumn("level", F.lit(level)), found, ["doi"], work.buckets, path, partition="level")
            frontier = spark.table(found).filter(F.col("level") == level).select("doi")
            if frontier.isEmpty():
                break
    return spark.read.schema(with_field(start.schema, "level", IntegerType())).parquet(path)


def _next_level(edges: Edges, frontier: DataFrame, found: DataFrame | None, done: DataFrame | None) -> DataFrame:
    """What the frontier cites and no level has found. Edges, frontier, earlier levels and downloads
    lie in the same buckets; only what is cited is shuffled, once, to its own."""
    if done is not None:
        frontier = frontier.join(done, "doi", "left_semi")
    cited = edges.of(frontier.select("doi")).select(F.col("dst").alias("doi")).distinct()
    return cited if found is None else cited.join(found.select("doi"), "doi", "left_anti")


def snowball_walks(seeds: DataFrame, citations: DataFrame | Edges, depth: int = 1, case_sensitive: bool = False) -> DataFrame:
    """As :func:`snowball` without a visited set: per level and work, ``n`` counts
    how often it is reached. Repeats are carried as counts, never as rows, so a
    cycle or a hub does not multiply the data. A count that no long holds is NULL, and
    so are all that build on it."""
    spark = seeds.sparkSession
    frontier = _seed_keys(seeds, case_sensitive).groupBy("doi").agg(F.count(F.lit(1)).alias("n"))
    reader = spark.read.schema(with_field(frontier.schema, "level", IntegerType()))
    if depth < 1:
        return frontier.limit(0).withColumn("level", F.lit(0))
    ways = F.try_multiply("n", "m")
    with Tables(spark, "walks", citations.buckets if isinstance(citations, Edges) else None) as work:
        edges = _edge_table(citations, work, case_sensitive)
        for level in range(1, depth + 1):
            reached = (
                edges.of(frontier)
                .groupBy(F.col("dst").alias("doi"))
                .agg(F.when(F.count(ways) == F.count(F.lit(1)), F.try_sum(ways)).alias("n"))
            )
            frontier = write_step(reached, f"{work.base}/levels/level={level}")
            if frontier.isEmpty():
                break
    return reader.parquet(f"{work.base}/levels")


def citation_counts(citations: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """How many works cite each DOI. Counted per (dst, src) first: hubs spread."""
    keyed = citations.select(*[graph_key(citations, c, case_sensitive).alias(c) for c in ("src", "dst")])
    return (
        keyed.filter(F.col("dst").isNotNull())
        .groupBy(F.col("dst").alias("doi"))
        .agg(F.count_distinct("src").alias("cited_by"))
    )
