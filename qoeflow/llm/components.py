"""Connected components of a links table, by alternating star steps (no driver state but a row count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qoeflow.llm import common


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour (or to itself)."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node, move to its smallest neighbour. Needs a > b in each row."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, class): for each node of ``links`` (a long, b long) the smallest node it is connected to.

    Each round is a large and a small star step; the table of links is written after each, and its size
    and checksum tell when nothing moves any more. Rounds grow with the logarithm of the size of the
    largest component. A star's centre, the hot key here, meets its neighbours only in joins that
    Spark can split, and in minima that are computed before the shuffle.
    """
    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = common.stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = state(now)
    while True:
        now = common.stored(_small_star(_large_star(now)), "links")
        after = state(now)
        if after == before:
            break
        before = after
    least = now.select(F.col("a").alias("node"), F.col("b").alias("class"))
    return least.union(now.select(F.col("b").alias("node"), F.col("b").alias("class")).distinct())
