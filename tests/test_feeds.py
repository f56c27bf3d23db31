"""Batch feeds, key logs and combiners."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import combine
from millrace.operators.jobs import Folder
from millrace.sources import files
from millrace.streaming import keylog


def test_batches_lie_whole_and_in_order(spark, tmp_path):
    df = spark.range(1003).withColumn("x", F.col("id") * 2)
    files.write_batches(df, f"{tmp_path}/a", "id", 64, "s")
    files.write_batches(df, f"{tmp_path}/b", "id", 64, "s", epoch=1)
    index = {r.batch: r for r in spark.read.parquet(f"{tmp_path}/a.index").collect()}
    assert sorted(index) == list(range(16)) and [index[b].n_rows for b in range(16)] == [64] * 15 + [1003 - 15 * 64]
    rows = spark.read.parquet(f"{tmp_path}/a").select("*", "_metadata.file_name", "_metadata.row_index").collect()
    for r in rows:
        assert r.file_name == index[r.batch].file and r.row_index == index[r.batch].first_row + r.place
    assert sorted(r.id for r in rows) == list(range(1003))
    order = [r.id for n in range(16) for r in files.read_batch(spark, f"{tmp_path}/a", n).collect()]
    assert order == [r.id for r in sorted(rows, key=lambda r: (r.batch, r.place))]
    other = [r.id for n in range(16) for r in files.read_batch(spark, f"{tmp_path}/b", n).collect()]
    assert sorted(other) == sorted(order) and sum(a == b for a, b in zip(order, other)) < 20
    assert files.read_batch(spark, f"{tmp_path}/a", 99).count() == 0
    one = files.read_batch(spark, f"{tmp_path}/a", 5)
    assert len(one.inputFiles()) == 1


def test_feed_resumes_at_any_batch(spark, tmp_path):
    files.write_batches(spark.range(500), f"{tmp_path}/a", "id", 10)
    for n in (0, 17, 49, 50):
        assert sorted(r.batch for r in files.resume_batches(spark, f"{tmp_path}/a", n).select("batch").distinct().collect()) == list(range(n, 50))
    files.write_batches(spark.range(0), f"{tmp_path}/none", "id", 10)
    assert files.read_batch(spark, f"{tmp_path}/none", 0).count() == 0


def put(spark, folder, n, values, **how):
    keylog.append_keys(spark.createDataFrame([(v,) for v in values], "w string"), n, ["w"], "id", folder, buckets=4, **how)


def ids(spark, folder):
    got = keylog.read_keys(spark, ["w"], "id", folder)
    return {} if got is None else {r.w: r.id for r in got.collect()}


def test_key_log(spark, tmp_path):
    folder = f"{tmp_path}/log"
    assert ids(spark, folder) == {}
    put(spark, folder, 0, ["b", "a", "b", None])
    assert ids(spark, folder) == {None: 0, "a": 1, "b": 2}
    put(spark, folder, 1, ["a", "c"])
    put(spark, folder, 1, ["z"])  # committed: nothing happens
    put(spark, folder, 2, ["a", None])  # nothing new: no part
    assert ids(spark, folder) == {None: 0, "a": 1, "b": 2, "c": 3}
    log = json.loads(Folder(spark, folder).read("log.json"))
    assert log == {"batch": 2, "next": 4, "generation": 0, "parts": ["delta-0", "delta-1"]}
    assert spark.read.parquet(f"{folder}/delta-1").count() == 1  # only the new key is written
    put(spark, folder, 3, ["d"], compact=3)
    log = json.loads(Folder(spark, folder).read("log.json"))
    assert log["parts"] == ["base-1"] and log["generation"] == 1 and {"delta-0", "delta-1", "delta-3"}.isdisjoint(Folder(spark, folder).names(""))
    put(spark, folder, 4, ["e", "d", "a"])
    assert ids(spark, folder) == {None: 0, "a": 1, "b": 2, "c": 3, "d": 4, "e": 5}


@pytest.mark.parametrize("compact", [16, 2])
def test_failure_between_write_and_commit(spark, tmp_path, monkeypatch, compact):
    """A part, or a merged one, that was written but not committed neither loses nor repeats an id."""
    folder, write = f"{tmp_path}/log", Folder.write
    put(spark, folder, 0, ["a", "b"])

    def fail(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(Folder, "write", fail)
    with pytest.raises(RuntimeError):
        put(spark, folder, 1, ["c", "a", "d"], compact=compact)
    assert ids(spark, folder) == {"a": 0, "b": 1}
    monkeypatch.setattr(Folder, "write", write)
    put(spark, folder, 1, ["c", "a", "d"], compact=compact)
    put(spark, folder, 2, ["d", "e"], compact=compact)
    assert ids(spark, folder) == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4}


def test_stretches_against_brute_force(spark, monkeypatch):
    """A key with most of the rows, out of order and repeated; states are sent on when many are held."""
    monkeypatch.setattr(combine, "HELD", 5)
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 40}", rng.choice([rng.randrange(4000), rng.randrange(50), None])) for i in range(9000)] + [(None, 7), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(6)
    got = {r.k: [tuple(x) for x in r.spans] for r in combine.combined(df, ["k"], ["v"], combine.Stretches(), "spans", combine.Stretches.schema).collect()}
    want = {}
    for k, v in rows:
        want.setdefault(k, set()).update([] if v is None else [v])
    for k, vs in want.items():
        first = [v for v in sorted(vs) if v - 1 not in vs]
        assert got.pop(k) == [(a, next(b for b in range(a, 5000) if b + 1 not in vs)) for a in first]
    assert not got and combine.combined(df.limit(0), ["k"], ["v"], combine.Stretches(), "spans", combine.Stretches.schema).count() == 0


def test_only_states_are_shuffled(spark):
    """A hundred thousand rows of one key in eight tasks are eight states."""
    df = spark.range(0, 100_000, 1, 8).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    out = combine.combined(df, ["k"], ["v"], combine.Stretches(), "spans", combine.Stretches.schema)
    assert [tuple(x) for x in out.first().spans] == [(0, 99_999)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FlatMapGroupsInArrow") < plan.index("Exchange") < plan.index("MapInArrow")


def test_frame_folders(spark, tmp_path):
    """Frames go by number, not by name; other files and empty folders have none; the same as Spark's own listing gives."""
    for video, names in (("a b.x", ["10.jpg", "9.jpg", "1.jpg", "note.txt", "x1.jpg"]), ("none", []), ("c", ["0.jpg"])):
        (tmp_path / "f" / video).mkdir(parents=True)
        for n in names:
            (tmp_path / "f" / video / n).write_text("")
    (tmp_path / "f" / "stray.jpg").write_text("")
    got = sorted(tuple(r) for r in files.list_frame_folders(spark, f"{tmp_path}/f").collect())
    assert got == [("a b.x", i, f"{tmp_path}/f/a b.x/{n}.jpg") for i, n in enumerate((1, 9, 10))] + [("c", 0, f"{tmp_path}/f/c/0.jpg")]
    assert sorted(tuple(r) for r in files.list_frame_folders(spark, f"file://{tmp_path}/f").select("video", "frame").collect()) == [r[:2] for r in got]
    (tmp_path / "g").mkdir()
    assert files.list_frame_folders(spark, f"{tmp_path}/g").count() == 0
