"""Hard negatives against brute force and SQL."""

import math

import duckdb
import numpy as np
import pytest

from millrace.llm import negatives as N

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int, rank int, dim string"


def exact(rows, every=100, positives=5, k=5):
    """By Python's integers, pair by pair."""
    whole = lambda v: [math.floor(256 * x) if abs(x) < 1e12 else 256 * int(x) for x in v]
    rows, out = [(i, whole(v), g) for i, v, g in rows], []
    for n, (i, v, g) in enumerate(rows):
        if i % every:
            continue
        s = [(max(N.LEAST, min(N.MOST, sum(a * b for a, b in zip(v, w)))), j, h == g) for m, (j, w, h) in enumerate(rows) if m != n and len(w) == len(v)]
        s.sort(key=lambda x: (-x[0], x[1]))
        for p, j, _ in [x for x in s if x[2]][:positives]:
            fit = [x for x in s if not x[2] and 80 * p <= 100 * x[0] <= 100 * p][:k]
            out += [(i, j, r, x[1], p, x[0]) for r, x in enumerate(fit, 1)]
    return sorted(out)


def mined(df, **how):
    return sorted(tuple(r) for r in N.hard_negatives(df, **how).collect())


@pytest.mark.parametrize("block", [16_384, 64, 5])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N, "ROWS", block)
    monkeypatch.setattr(N, "ANCHORS", max(2, block // 8))
    monkeypatch.setattr(N, "SLICE", block * 3)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=6) + 0.6).round(2).tolist(), int(rng.integers(3))) for i in range(700)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], i % 3) for i in range(700, 1100)]  # ties: many equal vectors
    rows += [(300, rows[300][1], rows[300][2]), (300, rows[300][1], 1 - min(1, rows[300][2])), (2000, [1.0, 2.0], 1), (2001, [1.0, 2.5], 1), (2002, [1.0, 1.9], 2)]  # shared ids, another length
    bad = [(3000, None, 1), (3100, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (3200, [float("nan")] * 6, 1), (3300, [float("inf")] * 6, 2), (3400, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    df = spark.createDataFrame([(i, v, g, 7, "x") for i, v, g in rows + bad], SCHEMA)
    assert mined(df) == exact(rows)
    assert mined(df, every=50, positives=3, k=2) == exact(rows, 50, 3, 2)


def test_small_tables_and_extremes(spark):
    make = lambda rows: spark.createDataFrame([(i, v, g, 0, "") for i, v, g in rows], SCHEMA)
    assert mined(make([])) == []
    assert mined(make([(0, [1.0], 1)])) == []  # no positive
    assert mined(make([(0, [1.0], 1), (1, [1.0], 1)])) == []  # no negative
    assert mined(make([(0, [], 1), (1, [], 1), (2, [], 2)])) == [(0, 1, 1, 2, 0, 0)]
    assert mined(make([(0, [-1.0], 1), (1, [1.0], 1), (2, [1.0], 2)])) == []  # a negative score has an empty window
    rows = [(0, [1e300, -1e-300, 1.0], 1), (1, [1e300, 1.0, 1.0], 1), (2, [1e250, 0.0, 2.0], 2), (100, [1e9, 1e7, 3.0], 1), (101, [1e9, 1e7, 4.0], 1), (3, [9e8, 1e7, 4.5], 2), (4, [5e-324, 0.1, 0.2], 2), (5, [1.0, 0.1, 0.2], 1)]
    assert mined(make(rows)) == exact(rows)


def test_query_equals_sql(spark):
    got = N.op12_mine(spark.read.parquet(f"{FOLDER}/embeddings.parquet")).toPandas()
    db = duckdb.connect()
    db.sql(f"create view embeddings as select * from '{FOLDER}/embeddings.parquet'")
    want = db.sql(N.ORACLE).df()
    assert len(got) and sorted(map(tuple, got[want.columns].values.tolist())) == sorted(map(tuple, want.values.tolist()))
