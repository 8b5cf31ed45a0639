"""Connected components of links that are too many for one machine.

Each round gives every node the best of its neighbourhood as parent, by a hash that is
new in every round, and contracts the links to the parents. A constant share of the nodes
goes in each round, so the rounds grow with the logarithm of the largest component. Every
round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of any orderable type -> (node, root), one row for each node of a link.

    Nodes of one component share a root, which is one of them. Repeated links, links to
    oneself and both directions are fine; a link with a null end is left out.
    """
    links = stored(
        links.filter("a IS NOT NULL AND b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    roots = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("root"))
    roots = stored(roots, "roots")
    links = links.filter("a <> b")
    turn = 0
    while not links.isEmpty():
        turn += 1
        both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l")).select("l.*")
        order = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("node"))
        best = both.groupBy("a").agg(F.min(order("b")).alias("best"))
        parents = stored(best.select(F.col("a").alias("node"), F.least(F.col("best"), order("a"))["node"].alias("parent")), "parents")
        pa, pb = (parents.select(F.col("node").alias(c), F.col("parent").alias(f"p{c}")) for c in ("a", "b"))
        met = links.join(pa, "a").join(pb, "b").filter("pa <> pb")
        links = stored(met.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
        moved = parents.select(F.col("node").alias("root"), "parent")
        roots = stored(
            roots.join(moved, "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "roots"
        )
    return roots
