"""Validation: rules split rows into valid ones and rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.shared import stored


@dataclass(frozen=True)
class Rule:
    """``ok`` holds for good rows (null counts as no); a warning doesn't reject."""

    name: str
    ok: Column
    fatal: bool = True


def checked(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` with ``errors`` and ``warnings``: names of broken rules, comma-joined."""
    broken = lambda fatal: F.array_join(F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(~F.coalesce(r.ok, F.lit(False)), r.name) for r in rules if r.fatal is fatal])), ",")
    return df.withColumns({"errors": broken(True), "warnings": broken(False)})


def validate(df: DataFrame, rules: list[Rule], on_error: str = "reject") -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)``; ``on_error``: ``reject``, ``warn`` (all rows are valid, rejects only listed) or ``fail`` (evaluation raises)."""
    all_ = checked(df, rules)
    if on_error == "fail":
        guard = F.when(F.col("errors") != "", F.raise_error(F.concat(F.lit("broken rules: "), "errors")).cast("string")).otherwise(F.col("errors"))
        all_ = all_.withColumn("errors", guard)
    valid = all_ if on_error == "warn" else all_.filter("errors = ''")
    return valid.drop("errors", "warnings"), all_.filter("errors != ''")


def not_unique(df: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Keys with more than one distinct combination of ``values``."""
    return df.groupBy(*key).agg(F.count_distinct(*values).alias("n_values")).filter("n_values > 1")


def duplicate_ids(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def dangling(df: DataFrame, ref: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose reference has no target."""
    return df.join(ref.select(*on), on, "left_anti")


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one table has more often than the other, with ``side``; empty where the tables are equal."""
    both = a.withColumn("_n", F.lit(1)).unionByName(b.select(*a.columns).withColumn("_n", F.lit(-1)))
    more = both.groupBy(*a.columns).agg(F.sum("_n").alias("_n")).filter("_n != 0")  # one aggregation tells both sides
    side = F.when(F.col("_n") > 0, "left").otherwise("right")
    return more.select(*a.columns, F.explode(F.array_repeat(side, F.abs("_n").cast("int"))).alias("side"))


def digests(tables: dict[str, DataFrame], doc: str) -> DataFrame:
    """``(doc, table, n, a, b)``: of each document's rows in each table their number and two sums of hashes, whatever their order.

    Sums of parts add up, so they combine before the shuffle and a document with many rows costs no task more than others.
    """
    out = None
    for name, df in sorted(tables.items()):
        rest = [c for c in sorted(df.columns) if c != doc]
        total = lambda seed: F.sum(F.xxhash64(F.lit(seed), "_row").cast("decimal(38,0)"))
        one = df.select(doc, F.to_json(F.struct(*rest)).alias("_row")).groupBy(doc).agg(F.count("*").alias("n"), total(1).alias("a"), total(2).alias("b")).select(doc, F.lit(name).alias("table"), "n", "a", "b")
        out = one if out is None else out.unionByName(one)
    return out


def differing_documents(left: dict[str, DataFrame], right: dict[str, DataFrame], doc: str) -> DataFrame:
    """``(doc, table)`` where the documents of the two sides differ, one that a side lacks among them; tables go by name, rows are multisets."""
    a, b = (digests(t, doc).select(doc, "table", F.struct("n", "a", "b").alias(side)) for t, side in ((left, "l"), (right, "r")))
    return a.join(b, [doc, "table"], "full").filter(~F.col("l").eqNullSafe(F.col("r"))).select(doc, "table")


def document_differences(left: dict[str, DataFrame], right: dict[str, DataFrame], doc: str) -> DataFrame:
    """``(doc, table, side, row)``: rows, as JSON, that one side has more often than the other; only documents that differ are compared by row."""
    differ, out = stored(differing_documents(left, right, doc), "differ"), None
    for name in sorted(left):
        mine = differ.filter(F.col("table") == name).select(doc)
        text = lambda df: df.join(mine, doc, "left_semi").select(doc, F.to_json(F.struct(*[c for c in sorted(df.columns) if c != doc])).alias("row"))  # noqa: B023, E731
        one = differences(text(left[name]), text(right[name])).select(doc, F.lit(name).alias("table"), "side", "row")
        out = one if out is None else out.unionByName(one)
    return out
