"""Connected components by alternating stars: every step is a minimum per node and a join, nothing is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch

ROUNDS = 40


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Least and greatest b of each a; summed before the shuffle, and stored so that the join back can split a large hub."""
    return scratch.store(edges.groupBy(F.col("a").alias("m_a")).agg(F.min("b").alias("m"), F.max("b").alias("most")), name)


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    joined = _both(edges).join(least, F.col("a") == F.col("m_a"))
    return joined.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(down: DataFrame, least: DataFrame) -> DataFrame:
    moved = down.join(least, F.col("a") == F.col("m_a")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("m_a", "m"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges (a, b) -> (id, component): for each id that has an edge to another one, the least id it is joined to.

    Null ends and loops are left out; repeated and reversed edges do no harm. Only a look whether any id is unsettled
    reaches the driver. The number of rounds grows with the logarithm of the longest path.

    No step after the first makes edges distinct: a star makes no more rows than it reads, least and greatest don't mind
    repeats, and the result is one row of least per id. All ids are settled where each has either larger neighbours
    only or a single, smaller one: then that one has larger neighbours only, and is the least of its component.
    """
    at = scratch.store(edges.where("a <> b").select("a", "b").distinct(), "edges-0")
    for turn in range(1, ROUNDS + 1):
        least = _least(_both(at), scratch, f"least-{turn}")
        if least.where("m < m_a AND most > m").isEmpty():
            scratch.drop(f"edges-{turn - 1}")
            return least.select(F.col("m_a").alias("id"), F.least("m_a", "m").alias("component"))
        down = scratch.store(_large_star(at, least), f"large-{turn}")
        at = scratch.store(_small_star(down, _least(down, scratch, "least-small")), f"edges-{turn}")
        scratch.drop(f"edges-{turn - 1}", f"large-{turn}", f"least-{turn}", "least-small")
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
