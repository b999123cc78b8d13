"""Connected components of a links table by alternating large and small stars.

Links stay distributed; each round is written to the shared folder. A node with any share of
all links meets partial minima, and the join of links with minima is a plain one that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.common import written


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    far = both.where("v > u").join(least, F.col("u") == F.col("k"))
    return far.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    near = e.join(least, F.col("u") == F.col("k"))
    moved = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that each linked node reaches."""
    e = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    was = _state(e)
    while was[0]:
        e = written(_small(_large(e)), "links")
        now = _state(e)
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
