"""Connected components of an edge table, by alternating star contractions.

Each round rewires every node to the smallest node it knows: *large star*
hangs the larger neighbours of a node on the smallest one, *small star* the
smaller ones.  The number of rounds grows with the logarithm of the component
size; edges never multiply.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b != m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(low.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                 .first())


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns ``a``, ``b``, of
    one comparable type): ``root`` is the smallest node reachable.  Loops and
    repeated edges are allowed; an edge with a NULL end is ignored."""
    now = staged(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    mark = _mark(now)
    turn = 0
    while mark[0]:
        turn += 1
        half = staged(_large_star(now), f"{name}-{turn}l")
        now = staged(_small_star(half), f"{name}-{turn}s")
        last, mark = mark, _mark(now)
        if last == mark:
            break
    # at the end every edge leads from a node to its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
