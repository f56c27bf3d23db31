"""Connected components of an edge list by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut


def _join_min(pairs: DataFrame) -> DataFrame:
    """``(u, v, m)`` with ``m`` the smallest ``v`` of ``u``.

    The minimum is re-keyed with a no-op XOR: the join then has an exchange of its own on either side, and AQE can
    split a hub's partition, which it can't when the aggregate's exchange is reused.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").bitwiseXOR(F.lit(0)).alias("k"), "m")
    return pairs.join(least, F.col("u") == F.col("k")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    j = _join_min(both)
    return j.filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    j = _join_min(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))))
    return j.select(ends.alias("e")).select("e.u", "e.v").filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Label the nodes of ``edges(u long, v long)`` with the smallest node they reach: ``(node, root)``.

    Every node but the roots themselves gets a row; self-loops, repeated and reversed edges are allowed, rows with a
    null end are ignored, an empty list gives an empty result.  Each round is checkpointed; the edges stay distributed and only a count and a checksum of
    them reach the driver.  The number of rounds grows with the logarithm of the number of nodes.
    """
    e = cut(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        e = cut(_small_star(_large_star(e)))
