"""Connected components of a link table by alternating large and small stars, all in DataFrames.

Every table on the way is written in as many files as its number of links asks for, so that a small link table
does not pass through as many tasks as the session deals a large one over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm._common import shuffle_partitions, spooled

ROUNDS = 40
#: Links in one file.
LINKS = 200_000


def _star(edges: DataFrame, large: bool, files: int) -> DataFrame:
    """Large star: each node's greater neighbours hang on the least of its neighbours and itself; small star: the others do."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    own = both if large else both.where("b < a")
    # spooled: both sides of the join are then exchanged, and AQE can split a node with very many links
    least = spooled(own.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).coalesce(files), "least")
    moved = own.join(least, "a")
    if large:
        return moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct().coalesce(files)
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct().coalesce(files)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; the component is its least node. ``edges`` has a and b."""
    edges = spooled(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, files = None, min(shuffle_partitions(edges.sparkSession), max(4, -(-edges.count() // LINKS)))
    for _ in range(ROUNDS):
        edges = spooled(_star(spooled(_star(edges, True, files), "edges"), False, files), "edges")
        # the stars are done when no node changes its centre any more
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``known`` (node, component) after more links (a, b) between its nodes or others: only components are linked anew."""
    links = spooled(links.select("a", "b").distinct(), "links")
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    fresh = ends.join(known.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    every = spooled(known.select("node", "component").unionByName(fresh), "every")
    up = lambda c: every.select(F.col("node").alias(c), F.col("component").alias(f"{c}_up"))
    merged = components(links.join(up("a"), "a").join(up("b"), "b").where("a_up != b_up").select(F.col("a_up").alias("a"), F.col("b_up").alias("b")))
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("top"))
    return every.join(merged, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
