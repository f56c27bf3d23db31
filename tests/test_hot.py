"""Groups that hold most rows, and intervals of all lengths, against plain windows and brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import hot as H
from millrace.operators import joins as J
from millrace.operators.split import shuffled, stratified_split


def skewed(spark, n=6000):
    """One key holds half of the rows, null is a key, values repeat."""
    rng = random.Random(4)
    rows = [("hot" if i % 2 else rng.choice(["a", "b", None, f"k{i % 97}"]), rng.randrange(900), i, rng.randrange(-3, 9)) for i in range(n)]
    return spark.createDataFrame(rows, "k string, o int, id int, v int").repartition(5)


@pytest.mark.parametrize("bound", [10, 500, 10_000])
def test_running_sum(spark, bound):
    df = skewed(spark).cache()
    w = Window.partitionBy("k").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0)))
    got = H.running_sum(df, ["k"], ["o", "id"], F.col("v"), "s", bound)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_descending_order(spark):
    df = skewed(spark, 2000)
    got = H.running_sum(df, ["k"], [F.desc("o"), F.asc("id")], F.lit(1), "p", 100)
    want = df.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("o"), "id")) - 1)
    assert sorted((str(r.k), r.id, r.p) for r in got.collect()) == sorted((str(r.k), r.id, r.p) for r in want.collect())


@pytest.mark.parametrize("bound,bins", [(10, 4), (200, 1024), (50_000, 1024)])
def test_split_of_a_hot_stratum(spark, monkeypatch, bound, bins):
    monkeypatch.setattr(H, "BOUND", bound)
    monkeypatch.setattr(H, "BINS", bins)
    df = skewed(spark).select("k", "id").cache()
    w = Window.partitionBy("k").orderBy(shuffled(F.col("id"), "s"), "id")
    n = F.count("*").over(Window.partitionBy("k"))
    want = df.withColumn("split", F.when(F.row_number().over(w) <= F.when(n > 9, F.floor(n * 0.1)).otherwise(1), "val").otherwise("train"))
    got = stratified_split(df, ["k"], "id", 0.1, "s")
    assert got.columns == ["k", "id", "split"] and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_equal_keys_in_a_hot_stratum(spark, monkeypatch):
    """Rows that repeat: as many are taken as of distinct ones."""
    monkeypatch.setattr(H, "BOUND", 20)
    df = spark.range(1000).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("id"))
    assert stratified_split(df, ["k"], "id").filter("split = 'val'").count() == 100
    assert stratified_split(df.limit(0), ["k"], "id").count() == 0


def test_a_hot_group_spreads_over_tasks(spark, monkeypatch):
    """No task of the windows gets most of the hot group: its rows are grouped by range."""
    monkeypatch.setattr(H, "BOUND", 100)
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("o"))
    ranges = []
    monkeypatch.setattr(H, "stored", lambda d, name: ranges.append((name, d)) or stored(d, name))
    got = H.running_sum(df, ["k"], ["o"], F.lit(1), "p")
    assert got.filter("p != o").count() == 0 and got.count() == 20_000
    sizes = [r["count"] for r in next(d for n, d in ranges if n == "ranges").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 8000


from millrace.operators.shared import stored  # noqa: E402


def test_dyadic_covers(spark):
    """A cover holds each integer once and no other, in few nodes; a point's path meets it once or not at all."""
    rng = random.Random(2)
    spans = [(0, 0), (-1, 0), (-7, 9), (5, 5), (1, 6), (-1_000_000_007, 999_999_999), (2**40, 2**40 + 12345)] + [(a, a + rng.randrange(200)) for a in (rng.randrange(-500, 500) for _ in range(60))]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(spans)], "i int, a long, b long")
    for r in df.select("a", "b", J.dyadic_cover(F.col("a"), F.col("b")).alias("c")).collect():
        parts = sorted((n.number << n.level, (n.number + 1 << n.level) - 1) for n in r.c)
        assert parts[0][0] == r.a and parts[-1][1] == r.b and all(x[1] + 1 == y[0] for x, y in zip(parts, parts[1:]))
        assert len(parts) <= 2 * (r.b - r.a + 2).bit_length()
    path = spark.range(1).select(J.dyadic_path(F.lit(-6), 4).alias("p")).first().p
    assert [(n.level, n.number) for n in path] == [(k, -6 >> k) for k in range(5)]


@pytest.mark.parametrize("mode", ["any_overlap", "reference"])
@pytest.mark.parametrize("bucket", [1, 1000])
def test_overlaps_of_all_lengths(spark, mode, bucket):
    rng = random.Random(7)
    span = lambda: (s := rng.choice([rng.randrange(100), rng.randrange(10**9)]), s + rng.choice([0, 1, 5, 40, 10**3, 10**6, 10**9, -3]))
    a, b = ([(i, rng.randrange(2), *span()) for i in range(150)] for _ in range(2))
    a, b = a + [(900, 0, None, 5), (901, None, 1, 5)], b + [(900, 0, 1, None), (901, None, 1, 5)]
    hit = (lambda s, e, t, f: s < f and t < e) if mode == "any_overlap" else (lambda s, e, t, f: t <= s < f or t < e <= f)
    want = sorted((i, j) for i, k, s, e in a for j, m, t, f in b if None not in (k, s, e, t, f) and k == m and hit(s, e, t, f))
    da, db = spark.createDataFrame(a, "i int, k int, s long, e long"), spark.createDataFrame(b, "j int, k int, t long, f long")
    got = J.overlap_join(da, db, ["k"], ("s", "e"), ("t", "f"), bucket, mode)
    assert sorted((r.i, r.j) for r in got.collect()) == want and len(want) > 500
