"""Frames of stitched segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import running_offset


def stitch(df: DataFrame, key: list[str], order: list[str], n: str, name: str = "frame") -> DataFrame:
    """A row per frame: segments of a key follow each other, and frame numbers go on from one to the next."""
    at = running_offset(df, key, order, n, "_at")
    frames = F.when(F.col(n) > 0, F.sequence(F.col("_at"), F.col("_at") + F.col(n) - 1))
    return at.withColumn(name, F.explode(frames)).drop("_at")
