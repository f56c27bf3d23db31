"""Aggregations over groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import first_int
from millrace.operators.hot import running_sum


def ordered_list(order: str | Column, value: str | Column) -> Column:
    """Aggregate: the values of a group in order (order first, then value)."""
    o, v = (F.col(x) if isinstance(x, str) else x for x in (order, value))
    return F.transform(F.array_sort(F.collect_list(F.struct(o.alias("o"), v.alias("v")))), lambda x: x["v"])


def reconcile(df: DataFrame, key: list[str], age: str, gender: str) -> DataFrame:
    """One row per key: largest integer found in ``age`` (-1: none), smallest non-empty ``gender``, and how many differ."""
    g = F.when(F.trim(F.col(gender)) != "", F.trim(F.col(gender)))
    return df.groupBy(*key).agg(F.max(first_int(F.coalesce(F.col(age), F.lit("")))).alias("age"), F.min(g).alias("gender"), F.count_distinct(F.col(age)).alias("n_ages"), F.count_distinct(g).alias("n_genders"))


def expected_vs_actual(expected: DataFrame, actual: DataFrame, key: list[str], n: str) -> DataFrame:
    """Groups whose number of rows in ``actual`` isn't the sum of ``n`` in ``expected``."""
    want = expected.groupBy(*key).agg(F.sum(n).alias("n_expected"))
    have = actual.groupBy(*key).agg(F.count("*").alias("n_actual"))
    both = want.join(have, key, "full").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_expected", "n_actual")})
    return both.filter("n_expected != n_actual")


def of_group_size(df: DataFrame, key: list[str], at_least: int = 1, at_most: int | None = None) -> DataFrame:
    """Rows of groups whose size is in the range: sizes are aggregated first, then joined, so a hot key can be split."""
    n = df.groupBy(*key).agg(F.count("*").alias("_n"))
    n = n.filter(F.col("_n") >= at_least) if at_most is None else n.filter(F.col("_n").between(at_least, at_most))
    return df.join(n.select(*key), key, "left_semi")


def running_offset(df: DataFrame, key: list[str], order: list[str], n: str, name: str = "offset") -> DataFrame:
    """Sum of ``n`` over the rows before, in order, within the key; a key with very many rows is summed by ranges."""
    return running_sum(df, key, order, F.col(n), name)
