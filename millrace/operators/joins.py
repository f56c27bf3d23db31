"""Joins the corpus jobs need; Catalyst and AQE choose how they run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import frame_range, ms_to_frame


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Many-to-one join with a dimension whose key is unique; ``validated`` is for those of which that isn't known."""
    return facts.join(dim, on, how)


def having(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return df.join(keys.select(*on), on, "left_semi")


def lacking(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key isn't in ``keys``."""
    return df.join(keys.select(*on), on, "left_anti")


def existence(expected: DataFrame, present: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(found, missing, unexpected)``."""
    return having(expected, present, on), lacking(expected, present, on), lacking(present, expected, on)


def validated(facts: DataFrame, dim: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Join with keys that have exactly one dimension row; facts of the other keys are rejects with the row count."""
    n = dim.groupBy(*on).agg(F.count("*").alias("n_matches"))
    good = facts.join(dim.join(n.filter("n_matches = 1").select(*on), on, "left_semi"), on)
    bad = facts.join(n, on, "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0))).filter("n_matches != 1")
    return good, bad


def all_in_set(df: DataFrame, group: list[str], member: Column) -> DataFrame:
    """Groups all of whose rows satisfy ``member`` (null counts as no): relational division in one aggregation."""
    return df.groupBy(*group).agg(F.bool_and(F.coalesce(member, F.lit(False))).alias("_all")).filter("_all").drop("_all")


def frames_of_intervals(df: DataFrame, start: str, end: str, fps: float = 30.0, name: str = "frame") -> DataFrame:
    """A row per frame of ``[start, end)`` in milliseconds; the frame then joins by equality, not by range."""
    return df.withColumn(name, F.explode(frame_range(ms_to_frame(F.col(start), fps), ms_to_frame(F.col(end), fps))))


def _node(level: Column, number: Column) -> Column:
    return F.struct(level.cast("int").alias("level"), number.cast("long").alias("number"))


def dyadic_cover(low: Column, high: Column) -> Column:
    """Nodes of a binary tree over the integers that cover ``low .. high`` exactly, each integer once: two a level at most."""
    end, zero = (high + 1).cast("long"), F.lit(0)
    levels = F.sequence(zero, F.ceil(F.log2((end - low + 1).cast("double"))).cast("int"))

    def at(k: Column) -> Column:
        left, right = -F.call_function("shiftright", -low.cast("long"), k), F.call_function("shiftright", end, k)
        inside = left < right
        return F.array(F.when(inside & (left.bitwiseAND(F.lit(1)) == 1), _node(k, left)), F.when(inside & (right.bitwiseAND(F.lit(1)) == 1), _node(k, right - 1)))

    return F.when(high >= low, F.array_compact(F.flatten(F.transform(levels, at))))


def dyadic_path(point: Column, levels: int) -> Column:
    """The nodes above a point, up to ``levels``; one at most is in a cover."""
    return F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: _node(k, F.call_function("shiftright", point.cast("long"), k)))


def overlap_join(a: DataFrame, b: DataFrame, on: list[str], a_span: tuple[str, str], b_span: tuple[str, str], bucket: int, mode: str = "any_overlap") -> DataFrame:
    """Pairs of intervals of the same key that coincide.

    ``any_overlap``: the half-open intervals share a point.  ``reference``: the first starts in the second, or ends in
    it, so a first interval that strictly contains the second doesn't count.  Intervals with a null end pair with none.

    Of two intervals that touch, one starts in the other: the second's start lies in the first after its start, or the first's
    in the second.  Each case meets by equality, once a pair: an interval is cut into the nodes of a binary tree over
    buckets that cover it, about ``2 * log2(length / bucket)``, and a start asks the nodes above it.  So lengths may differ
    by any factor, and a key with many intervals spreads.
    """
    s1, e1, s2, e2 = F.col(a_span[0]), F.col(a_span[1]), F.col(b_span[0]), F.col(b_span[1])
    hit = (s1 < e2) & (s2 < e1) if mode == "any_overlap" else ((s1 >= s2) & (s1 < e2)) | ((e1 > s2) & (e1 <= e2))
    low, high = (lambda s, e: F.floor(F.least(s, e) / bucket)), (lambda s, e: F.floor(F.greatest(s, e) / bucket))
    a, b = a.filter(s1.isNotNull() & e1.isNotNull()), b.filter(s2.isNotNull() & e2.isNotNull())
    levels = lambda df, s, e: max(0, int(df.agg(F.max(high(s, e) - low(s, e))).first()[0] or 0) + 2).bit_length()
    cover = lambda df, s, e: df.withColumn("_node", F.explode(dyadic_cover(low(s, e), high(s, e))))
    path = lambda df, s, e, n: df.withColumn("_node", F.explode(dyadic_path(low(s, e), n)))
    first, second = F.least(s1, e1), F.least(s2, e2)
    later = cover(a, s1, e1).join(path(b, s2, e2, levels(a, s1, e1)), [*on, "_node"]).filter(hit & (second > first))
    earlier = path(a, s1, e1, levels(b, s2, e2)).join(cover(b, s2, e2), [*on, "_node"]).filter(hit & (second <= first))
    return later.unionByName(earlier).drop("_node")
