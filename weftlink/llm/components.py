"""Connected components of a graph whose edges are rows, with alternating large and small stars.

Each round every node hooks its neighbours to the least node that it sees; O(log n) rounds in practice.
Nothing but a count comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm import common


def _least(both: DataFrame) -> DataFrame:
    """a, m: the least of a and its neighbours b."""
    return both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for the nodes of the edges (a, b)."""
    now = common.stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # large star: every larger neighbour of a node hooks to the least of the node and its neighbours
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # neither side goes to the driver, however few its rows look
        large = both.hint("merge").join(_least(both).hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours hook to the least of these
        small = large.hint("merge").join(large.groupBy("a").agg(F.min("b").alias("m")).hint("merge"), "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).distinct()
        new = common.stored(small, "edges")
        # sums of hashes tell whether the set of edges is the same as before
        state = new.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38,0)))")).first()
        common.dropped(now)
        now = new
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
