"""Order within groups of any size: positions, running sums and the first rows of a group, where one group may hold most rows.

Groups of up to BOUND rows go to a window, one task each.  The rows of larger ones are cut into ranges of their order, each a
group of its own; what a range brings to the next ones is summed over ranges and added by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.shared import stored

#: Rows of a group up to which one task orders it.
BOUND = 1_000_000
#: Intervals a round by which a rank is narrowed down.
BINS = 1024
#: Rows of a side up to which it is broadcast; beyond, Spark joins by shuffle and splits what is skewed.
BROADCAST_ROWS = 1_000_000


def _beside(df: DataFrame) -> DataFrame:
    """A written table, broadcast if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def large_groups(df: DataFrame, key: list[str], bound: int | None = None) -> DataFrame:
    """``key`` and ``_n`` of the groups with more than ``bound`` rows: at most one for each ``bound`` rows of the table, so few."""
    return stored(df.groupBy(*key).agg(F.count("*").alias("_n")).filter(F.col("_n") > (bound or BOUND)), "large")


def _divided(df: DataFrame, key: list[str], bound: int | None) -> tuple[DataFrame | None, DataFrame]:
    """``(rows of large groups or None, the others)``; keys compare as groups do, null with null."""
    if df.count() <= (bound or BOUND):  # no group is larger than the table, and a table's count needs no shuffle
        return None, df
    large = large_groups(df, key, bound)
    if not large.limit(1).count():
        return None, df
    other = _beside(large.select(*[F.col(c).alias(f"_large{i}") for i, c in enumerate(key)]))
    on = [df[c].eqNullSafe(F.col(f"_large{i}")) for i, c in enumerate(key)]
    return df.join(other, on, "left_semi"), df.join(other, on, "left_anti")


def running_sum(df: DataFrame, key: list[str], order: list[Column | str], value: Column, name: str, bound: int | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before, in order, within the key, as a long; 0 for the first."""
    many, few = _divided(df, key, bound)
    before = lambda by, at: Window.partitionBy(*by).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0)).cast("long")
    out = few.withColumn(name, total(value, before(key, order)))
    if many is None:
        return out
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = many.withColumn("_v", value).repartitionByRange(n, *key, *order).sortWithinPartitions(*key, *order)
    kept = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges").withColumn("_range", F.shiftright("_at", 33))
    # One row for each large group and range: what the ranges before bring.
    brought = kept.groupBy(*key, "_range").agg(F.sum("_v").alias("_sum"))
    brought = brought.withColumn("_before", total(F.col("_sum"), before(key, ["_range"])))
    brought = stored(brought.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(key)], F.col("_range").alias("_b"), "_before"), "carried")
    on = [F.col(c).eqNullSafe(F.col(f"_b{i}")) for i, c in enumerate(key)] + [F.col("_range") == F.col("_b")]
    within = kept.withColumn(name, total(F.col("_v"), before([*key, "_range"], ["_at"])))
    within = within.join(_beside(brought), on).withColumn(name, F.col(name) + F.col("_before"))
    return out.unionByName(within.select(*out.columns))


def first_of_group(df: DataFrame, key: list[str], order: Column, then: str, take: Column, name: str, bound: int | None = None) -> DataFrame:
    """``df`` with ``name``: whether a row is among the first ``take`` of its group by ``order``, an integer that is spread like a hash, then by ``then``.

    ``take`` is an expression of ``n``, the group's number of rows.  In a large group the value of ``order`` up to which rows are taken
    is narrowed down by counts of BINS intervals a round, for all groups at once; only rows of the last interval, at most
    ``bound`` unless their values are equal, are ordered.
    """
    many, few = _divided(df, key, bound)
    by = Window.partitionBy(*key)
    n = few.withColumn("n", F.count("*").over(by)).withColumn("_o", order)
    out = n.withColumn(name, F.row_number().over(by.orderBy("_o", then)) <= take).drop("n", "_o")
    if many is None:
        return out
    most = bound or BOUND
    many = stored(many.withColumn("_o", order), "ordered")
    null_safe = lambda a, b: [a[c].eqNullSafe(b[f"_g{i}"]) for i, c in enumerate(key)]
    named = [F.col(c).alias(f"_g{i}") for i, c in enumerate(key)]
    groups = many.groupBy(*key).agg(F.count("*").alias("n"), F.min("_o").alias("_low"), F.max("_o").alias("_high")).withColumn("_left", take.cast("long"))
    # Of each group: rows up to _left are sought between _low and _high; n is how many lie there.
    cut = stored(groups.select(*named, "n", "_low", "_high", "_left"), "cuts")
    while cut.filter((F.col("n") > most) & (F.col("_low") < F.col("_high"))).limit(1).count():
        width = F.greatest(F.lit(1).cast("decimal(38,0)"), F.ceil((F.col("_high").cast("decimal(38,0)") - F.col("_low") + 1) / BINS))
        inside = many.join(_beside(cut), null_safe(many, cut)).filter(F.col("_o").between(F.col("_low"), F.col("_high")))
        bins = inside.groupBy(*[f"_g{i}" for i in range(len(key))], "_left", F.floor((F.col("_o").cast("decimal(38,0)") - F.col("_low")) / width).alias("_bin")).agg(F.count("*").alias("c"), F.min("_o").alias("_low"), F.max("_o").alias("_high"))
        up = Window.partitionBy(*[f"_g{i}" for i in range(len(key))]).orderBy("_bin")  # at most BINS rows
        bins = bins.withColumn("_sum", F.sum("c").over(up))
        holds = (F.col("_sum") >= F.col("_left")) & (F.col("_sum") - F.col("c") < F.col("_left"))
        found = bins.filter(holds).select(*[f"_g{i}" for i in range(len(key))], F.col("c").alias("n"), "_low", "_high", (F.col("_left") - F.col("_sum") + F.col("c")).alias("_left"))
        cut = stored(found, "cuts")
    met = many.join(_beside(cut.withColumnRenamed("n", "_n")), null_safe(many, cut), "left")
    edge = met.filter(F.col("_o").between(F.col("_low"), F.col("_high")))
    edge = edge.withColumn(name, F.row_number().over(by.orderBy("_o", then)) <= F.col("_left"))
    rest = met.filter(~F.coalesce(F.col("_o").between(F.col("_low"), F.col("_high")), F.lit(False))).withColumn(name, F.coalesce(F.col("_o") < F.col("_low"), F.lit(False)))
    return out.unionByName(edge.select(*out.columns)).unionByName(rest.select(*out.columns))
