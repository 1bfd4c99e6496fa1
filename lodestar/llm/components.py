"""Connected components of an undirected graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import few, shared_table


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return edges.select(F.inline(ends))


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every neighbour above a node is tied to the node's least neighbour (or itself)."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return few(near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")), rows)


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """A node and its neighbours below it are tied to the least of those."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))))
    return few(few(tied.where("a <> b"), rows).distinct(), rows)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b longs) that is not a root itself: root is the least node reachable.

    Self-loops and repeated edges change nothing; nulls are left out; no edges
    give no rows.  Each round is written to the shared folder, in tasks by the
    number of edges, and only that number and whether it is the last reach the
    driver.
    """
    edges = shared_table(edges.where("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), "components")
    rows = edges.count()
    while rows:
        edges = shared_table(_small_star(_large_star(edges, rows), rows), "components")
        # finished when every node has one root and no root has another
        ends = F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("root")), F.struct(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("root")))
        nodes = few(edges.select(F.inline(ends)).groupBy("n").agg((F.sum("up") + F.max("root")).alias("ties")), rows)
        if nodes.agg(F.max("ties")).first()[0] == 1:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
