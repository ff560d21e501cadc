"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm.common import discard, store


def _hooked(edges: DataFrame) -> DataFrame:
    """(node, other) -> every node's least neighbour as ``least``, itself included."""
    least = edges.groupBy("node").agg(F.min("other").alias("least"))
    return edges.join(least.select("node", F.least("node", "least").alias("least")), "node")


def large_star(edges: DataFrame) -> DataFrame:
    """Hangs the larger neighbours of every node on its least neighbour."""
    both = edges.union(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    return _hooked(both).where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))


def small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the least of them; each edge has node > other."""
    hung = _hooked(edges)
    return hung.select(F.col("other").alias("node"), F.col("least").alias("other")).where("node > other") \
        .union(edges.groupBy("node").agg(F.min("other").alias("other")))


def state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges; an aggregate of two numbers."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the least id reachable, for every id that has a link to another.

    Each round is an aggregate and a join; rounds grow with the logarithm of the longest path. The
    edges of a round are stored before the next and deleted after it. Null ids and links of an id
    with itself say nothing and are left out.
    """
    edges = store(links.select(F.greatest(left, right).alias("node"), F.least(left, right).alias("other"))
                  .where(F.col(left).isNotNull() & F.col(right).isNotNull()).where("node <> other").distinct())
    known = state(edges)
    while True:
        after = store(small_star(large_star(edges).distinct()).distinct())
        now = state(after)
        discard(edges)
        edges = after
        if now == known:
            return edges.select("node", F.col("other").alias("component"))
        known = now
