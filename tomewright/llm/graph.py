"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import work_table


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest neighbour, or to itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, move to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.explode(F.array("a", "b")).alias("b"), F.col("m").alias("a"))
    return moved.where("a <> b").select("a", "b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): for every id of an edge (a, b) the smallest id it can reach.

    The edges stay distributed; each round is written to the shared folder. Rounds grow with the logarithm of the
    longest path. Edges may repeat, may point either way, and may join an id with itself. No edges: no rows.
    """
    now = work_table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("b").alias("id"), F.col("a").alias("component"))
        seen = mark
        now = work_table(_small_star(_large_star(now)), "edges")
