"""Surrogate keys and positions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.hot import running_sum
from millrace.operators.shared import stored


def dense_id(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """``df`` with a dense 0-based id in global order.

    Rows are range-partitioned and sorted, stored once, and numbered by their place in the partition plus the rows of
    all partitions before; the driver gets one count per partition.  No task sees more than its range.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    kept = stored(ranged.withColumn("_place", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_place", 33)
    base, at = {}, 0
    for r in sorted(kept.groupBy(part.alias("p")).count().collect()):
        base[r["p"]] = at
        at += r["count"]
    if not base:
        return kept.withColumn(name, F.lit(0).cast("long")).drop("_place")
    # Made in the JVM, so that no Python worker starts.
    pairs = F.from_json(F.lit(json.dumps([{"_p": p, "_base": n} for p, n in base.items()])), "array<struct<_p: bigint, _base: bigint>>")
    offsets = spark.range(1).select(F.inline(pairs))
    return kept.withColumn("_p", part).join(F.broadcast(offsets), "_p").withColumn(name, F.col("_base") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))).drop("_place", "_p", "_base")


def distinct_ids(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Distinct values of ``cols`` with a dense id in their order: the dimension table of a surrogate key."""
    return dense_id(df.select(*cols).distinct(), list(cols), name)


def position(df: DataFrame, parent: list[str], order: list[Column | str], name: str) -> DataFrame:
    """0-based position within the parent; a parent with very many rows is numbered by ranges."""
    return running_sum(df, parent, order, F.lit(1), name).withColumn(name, F.col(name).cast("int"))


def incremental_ids(known: DataFrame, new: DataFrame, cols: list[str], name: str) -> DataFrame:
    """``known`` and, for values of ``new`` that it lacks, further ids that go on from its largest."""
    start = known.agg(F.coalesce(F.max(name) + 1, F.lit(0)).cast("long")).first()[0]
    fresh = distinct_ids(new.select(*cols).join(known, cols, "left_anti"), cols, name)
    return known.select(*cols, name).unionByName(fresh.select(*cols, (F.col(name) + start).alias(name)))
