"""Jobs: skipped, resumed, published at once; digests of whole documents."""

import os

import pytest

from millrace.operators import jobs as G
from millrace.operators import validate as V
from millrace.operators.shared import stored


@pytest.fixture
def job(spark, tmp_path):
    spark.createDataFrame([(i % 7, i) for i in range(50)], "k int, v int").write.parquet(f"{tmp_path}/in")
    called = []

    def stages(fail=None):
        def first(_):
            called.append("first")
            src = spark.read.parquet(f"{tmp_path}/in")
            return {"a": src.select("k"), "b": src}

        def second(t):
            called.append("second")
            if fail == "stage":
                raise RuntimeError("killed")
            c = t["b"].selectExpr("k", "v", "if(v = 13, cast(raise_error('killed') AS int), 0) AS x" if fail == "table" else "0 AS x")
            return {"c": t["a"], "d": c}

        return [G.Stage("one", ("a", "b"), first), G.Stage("two", ("c", "d"), second)]

    run = lambda fail=None, version="": G.run_job(spark, f"{tmp_path}/out", {"in": f"{tmp_path}/in"}, stages(fail), {"a": ["k"]}, version)
    return run, called, str(tmp_path)


def test_second_run_reads_the_manifest_only(spark, job):
    run, called, path = job
    made = run()
    assert {n: t["rows"] for n, t in made["tables"].items()} == {"a": 7, "b": 50, "c": 7, "d": 50} and called == ["first", "second"]
    assert made["tables"]["a"]["digest"] == made["tables"]["c"]["digest"] != made["tables"]["b"]["digest"]
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    before = max(jobs(None), default=0)
    assert run() == made and called == ["first", "second"] and max(jobs(None), default=0) == before
    assert [r.k for r in G.read_job(spark, f"{path}/out")["a"].collect()] == list(range(7))


@pytest.mark.parametrize("fail,left", [("stage", {"a", "b"}), ("table", {"a", "b", "c"})])
def test_a_killed_job_resumes(spark, job, fail, left):
    run, called, path = job
    with pytest.raises(Exception, match="killed"):
        run(fail)
    with pytest.raises(FileNotFoundError):
        G.read_job(spark, f"{path}/out")
    (name,) = os.listdir(f"{path}/out/runs")
    marks = {n: os.stat(f"{path}/out/runs/{name}/{n}/_SUCCESS").st_mtime_ns for n in left}
    assert {x[:-5] for x in os.listdir(f"{path}/out/runs/{name}") if x.endswith(".json")} == left
    made = run()
    assert called == ["first", "second", "second"] and made["tables"]["d"]["rows"] == 50
    assert {n: os.stat(f"{path}/out/runs/{name}/{n}/_SUCCESS").st_mtime_ns for n in left} == marks  # not written again


def test_changed_input_runs_anew_and_is_published_at_once(spark, job):
    run, called, path = job
    run()
    spark.createDataFrame([(99, 99)], "k int, v int").write.mode("append").parquet(f"{path}/in")
    with pytest.raises(RuntimeError):
        run("stage")
    assert G.read_job(spark, f"{path}/out")["a"].count() == 7  # the last whole run
    made = run()
    assert made["tables"]["a"]["rows"] == 8 and G.read_job(spark, f"{path}/out")["a"].count() == 8 and len(os.listdir(f"{path}/out/runs")) == 1
    assert run(version="2")["fingerprint"] != made["fingerprint"] and called.count("first") == 3


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "k int").write.parquet(f"{tmp_path}/in")
    made = G.run_job(spark, f"{tmp_path}/out", {"in": f"{tmp_path}/in"}, [G.Stage("s", ("a",), lambda _: {"a": spark.read.parquet(f"{tmp_path}/in")})], {})
    assert made["tables"] == {"a": {"rows": 0, "digest": "0"}} and G.read_job(spark, f"{tmp_path}/out")["a"].columns == ["k"]


def test_whole_documents(spark):
    """One difference planted in each table, and a document that a side lacks; order and copies of rows don't matter, their number does."""
    make = lambda rows: spark.createDataFrame(rows, "d int, x string, n int").repartition(3)
    rows = [(d, x, n) for d in range(6) for x, n in (("a", 1), ("a", 1), ("b", None), (None, 2))]
    left = {"p": make(rows), "q": make(rows)}
    right = {"p": make([r for r in reversed(rows) if r != (1, "b", None)] + [(1, "b", 0)]), "q": make(rows[:-4] + [(2, "a", 1), (7, "new", 1)])}
    assert sorted(map(tuple, V.differing_documents(left, right, "d").collect())) == [(1, "p"), (2, "q"), (5, "q"), (7, "q")]
    got = sorted(map(tuple, V.document_differences(left, right, "d").collect()))
    assert got == sorted([(1, "p", "left", '{"x":"b"}'), (1, "p", "right", '{"n":0,"x":"b"}'), (2, "q", "right", '{"n":1,"x":"a"}'), (7, "q", "right", '{"n":1,"x":"new"}'),
                          *[(5, "q", "left", '{"n":1,"x":"a"}')] * 2, (5, "q", "left", '{"x":"b"}'), (5, "q", "left", '{"n":2}')])
    assert V.differing_documents(left, {k: v.repartition(2) for k, v in left.items()}, "d").count() == 0


def test_intermediates_are_deleted(spark, tmp_path):
    """What a stage writes between is gone when its tables are there, and after a failure; tables written outside stay."""
    outside, seen = stored(spark.range(5)), []

    def make(_, fail=False):
        between = stored(spark.range(9), "between")
        seen.append(between.inputFiles()[0].removeprefix("file://"))
        if fail:
            raise RuntimeError("killed")
        return {"a": between.groupBy().count()}

    spark.range(1).write.parquet(f"{tmp_path}/in")
    for how in (True, False):
        stage = G.Stage("s", ("a",), lambda t, how=how: make(t, how))
        if how:
            with pytest.raises(RuntimeError):
                G.run_job(spark, f"{tmp_path}/out", {"in": f"{tmp_path}/in"}, [stage], {})
        else:
            G.run_job(spark, f"{tmp_path}/out", {"in": f"{tmp_path}/in"}, [stage], {})
    assert len(seen) == 2 and not any(os.path.exists(f) for f in seen)
    assert G.read_job(spark, f"{tmp_path}/out")["a"].first()[0] == 9 and outside.count() == 5


def test_report(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/in")
    aside = spark.createDataFrame([("a", str(i), "r", "reject", None) for i in range(3)] + [("a", "x", "w", "warn", None)], "table string, key string, rule string, severity string, row string")
    G.run_job(spark, f"{tmp_path}/out", {"in": f"{tmp_path}/in"}, [G.Stage("s", ("a", "quarantine"), lambda _: {"a": spark.range(7), "quarantine": aside})], {})
    got = {tuple(r) for r in G.job_report(spark, f"{tmp_path}/out").collect()}
    assert got == {("a", None, None, 7), ("quarantine", None, None, 4), ("a", "r", "reject", 3), ("a", "w", "warn", 1)}
    assert G.job_report(spark, f"{tmp_path}/none").count() == 0
