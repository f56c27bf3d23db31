"""Reproducible splits, samples and top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.hot import first_of_group


def shuffled(key: Column, seed: str = "") -> Column:
    """A reproducible random order of the key."""
    return F.md5(F.concat(F.lit(seed), key.cast("string")).cast("binary"))


def stratified_split(df: DataFrame, strata: list[str], key: str, ratio: float = 0.1, seed: str = "") -> DataFrame:
    """``df`` with ``split``: of each stratum ``int(n * ratio)`` rows, but at least one, are ``val``, the rest ``train``.

    Up to nine rows give one validation row, as the ratio of a tenth would give none.
    """
    take = F.when(F.col("n") > 9, F.floor(F.col("n") * F.lit(float(ratio)))).otherwise(F.lit(1))
    text = shuffled(F.col(key), seed)
    high = F.conv(F.substring(text, 1, 15), 16, 10).cast("long")  # the order of the whole text, but for ties
    marked = first_of_group(df.withColumn("_text", F.struct(text.alias("t"), F.col(key).alias("k"))), strata, high, "_text", take, "_val")
    return marked.withColumn("split", F.when(F.col("_val"), "val").otherwise("train")).drop("_val", "_text")


def fixed_sample(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """``n`` rows at random, the same on every run."""
    return df.orderBy(shuffled(F.col(key), seed), key).limit(n)


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows; each task keeps ``n`` at most.  ``n <= 0``: all."""
    return df.orderBy(*order).limit(n) if n > 0 else df
