import base64
from urllib.parse import unquote

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import aggregates as A
from millrace.operators import corpus as B
from millrace.operators import joins as J
from millrace.operators import keys as K
from millrace.operators import split as S
from millrace.operators import validate as V
from millrace.operators.shared import scratch
from millrace.operators.windows import stitch
from millrace.sources import annotations as X
from millrace.sources import files, schemas
from millrace.streaming.keys import assign_ids


def one(df, col):
    return df.select(col.alias("x")).first()["x"]


def test_half_even_frames(spark):
    d = spark.createDataFrame([(50,), (150,), (350,), (0,), (59_999,)], "ms int")
    assert [r.f for r in d.select(C.ms_to_frame(F.col("ms")).alias("f")).collect()] == [int(round(x / 1000.0 * 30)) for x in (50, 150, 350, 0, 59_999)]


def test_frame_range_never_counts_down(spark):
    d = spark.createDataFrame([(3, 3), (3, 2), (1, 4)], "a int, b int")
    assert [r.x for r in d.select(C.frame_range(F.col("a"), F.col("b")).alias("x")).collect()] == [[], [], [1, 2, 3]]


def test_slice_includes_end_frame(spark):
    d = spark.createDataFrame([(1000, 2000), (1100, 1400)], "a int, b int")
    first, past = C.slice_frames(F.col("a"), F.col("b"), 60.0)
    assert [tuple(r) for r in d.select(first, past).collect()] == [(60, 121), (66, 85)]


def test_text_functions(spark):
    d = spark.createDataFrame([("b'a b/c~*é'",)], "t string")
    assert one(d, C.unwrap_bytes(F.col("t"))) == "a b/c~*é"
    assert one(d, C.url_quote(C.unwrap_bytes(F.col("t")))) == "a%20b/c~%2A%C3%A9"
    assert one(d, C.first_int(F.lit("aged 42 or 7"))) == 42 and one(d, C.first_int(F.lit("none"))) == -1
    assert one(d, C.first_int(F.lit("99999999999999"))) == -1
    assert one(d, C.is_ascii(F.col("t"))) is False
    assert one(d, C.csv_text(F.lit("a,b"), F.lit(1), F.lit(None))) == "ab, 1, "
    assert one(d, C.decode_base64(C.encode_base64(F.col("t")))) == "b'a b/c~*é'"
    assert one(d, C.format_interval(F.lit("jut"), F.lit(1), F.lit(2))) == "jut (1-2)"


@pytest.mark.parametrize("mode,want", [("reference", [(1, 2), (1, 3)]), ("any_overlap", [(1, 1), (1, 2), (1, 3)])])
def test_containment_differs_by_mode(spark, mode, want):
    a = spark.createDataFrame([("k", 1, 100, 900)], "k string, a int, s int, e int")
    b = spark.createDataFrame([("k", 1, 200, 300), ("k", 2, 50, 150), ("k", 3, 850, 2000), ("k", 4, 900, 950), ("j", 5, 0, 999)], "k string, b int, s2 int, e2 int")
    got = J.overlap_join(a, b, ["k"], ("s", "e"), ("s2", "e2"), 100, mode)
    assert sorted((r.a, r.b) for r in got.collect()) == want


def test_overlap_pairs_come_once_and_match_a_plain_join(spark):
    import random

    rnd = random.Random(3)
    span = lambda: (s := rnd.randint(-500, 500), s + rnd.randint(0, 300))
    x, y = [(i % 3, i, *span()) for i in range(60)], [(i % 3, i, *span()) for i in range(60)]
    a, b = spark.createDataFrame(x, "k int, a int, s int, e int"), spark.createDataFrame(y, "k int, b int, s2 int, e2 int")
    got = sorted((r.a, r.b) for r in J.overlap_join(a, b, ["k"], ("s", "e"), ("s2", "e2"), 70).collect())
    assert got == sorted((p[1], q[1]) for p in x for q in y if p[0] == q[0] and p[2] < q[3] and q[2] < p[3])


def test_dense_ids(spark):
    d = spark.createDataFrame([(f"w{i % 37:02d}",) for i in range(200)], "w string").repartition(7)
    got = sorted((r.id, r.w) for r in K.distinct_ids(d, ["w"], "id").collect())
    assert got == list(enumerate(sorted({f"w{i % 37:02d}" for i in range(200)})))
    assert K.distinct_ids(d.limit(0), ["w"], "id").count() == 0


def test_incremental_ids_keep_known(spark):
    known = spark.createDataFrame([("b", 0), ("d", 5)], "w string, id long")
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "w string")
    assert {r.w: r.id for r in K.incremental_ids(known, new, ["w"], "id").collect()} == {"b": 0, "d": 5, "a": 6, "c": 7}


def test_split_invariants(spark):
    d = spark.createDataFrame([(i % 7, i) for i in range(100)] + [(9, 1000), (8, 1001), (8, 1002)], "s int, k int")
    rows = S.stratified_split(d, ["s"], "k").collect()
    assert sorted(r.k for r in rows) == sorted(r.k for r in d.collect())
    for s in range(10):
        n, val = sum(r.s == s for r in rows), sum(r.s == s and r.split == "val" for r in rows)
        assert val == (int(n * 0.1) if n > 9 else min(n, 1))
    assoc, val, train = B.split_frames(d.withColumn("f", F.lit(1)), ["s"], "k")
    keys = lambda x: {(r.s, r.k) for r in x.collect()}
    assert keys(assoc) & keys(val) == set() and keys(train) | keys(val) == {(r.s, r.k) for r in d.collect()}
    assert {s for s, _ in keys(val)} <= {s for s, _ in keys(assoc)}


def test_stitch_and_clamp(spark):
    d = spark.createDataFrame([("v", 1, 2), ("v", 2, 0), ("v", 3, 1), ("w", 1, 1)], "v string, seg int, n int")
    assert sorted((r.v, r.seg, r.frame) for r in stitch(d, ["v"], ["seg"], "n").collect()) == [("v", 1, 0), ("v", 1, 1), ("v", 3, 2), ("w", 1, 0)]
    w = spark.createDataFrame([(5, 9, 20), (15, 25, 20), (30, 35, 20)], "s int, e int, l int")
    assert [tuple(r) for r in w.select(*C.clamp_window(F.col("s"), F.col("e"), F.col("l"))).collect()] == [(5, 9), (15, 20), (16, 20)]


def test_joins_and_division(spark):
    f = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, v string")
    d = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "k int, n string")
    good, bad = J.validated(f, d, ["k"])
    assert [r.k for r in good.collect()] == [1] and sorted((r.v, r.n_matches) for r in bad.collect()) == [("b", 2), ("c", 0), ("d", 0)]
    found, missing, extra = J.existence(f, d, ["k"])
    assert (found.count(), missing.count(), extra.count()) == (2, 2, 0)
    g = spark.createDataFrame([("p", True), ("p", None), ("q", True)], "g string, ok boolean")
    assert [r.g for r in J.all_in_set(g, ["g"], F.col("ok")).collect()] == ["q"]


def test_token_frames(spark):
    tok = spark.createDataFrame([("u", 0, 100), ("w", 0, 100)], "u string, StartTime int, EndTime int")
    vid = spark.createDataFrame([("u", "v1"), ("u", "v2")] + [("w", f"x{i}") for i in range(5)], "u string, v string")
    fr = spark.createDataFrame([("v1", 0), ("v1", 1), ("v1", 2), ("v2", 0)], "v string, FrameSequence int")
    found, missing, many = B.token_frames(tok, vid, fr, ["u"], ["v"])
    assert sorted((r.v, r.FrameSequence) for r in found.collect()) == [("v1", 0), ("v1", 1), ("v1", 2), ("v2", 0)]
    assert sorted((r.v, r.FrameSequence) for r in missing.collect()) == [("v2", 1), ("v2", 2)]
    assert [tuple(r) for r in many.collect()] == [("w", 5)]


def test_validation(spark):
    d = spark.createDataFrame([(1, "a"), (-1, "b"), (None, "")], "n int, t string")
    rules = [V.Rule("n", F.col("n") >= 0), V.Rule("t", F.col("t") != "", fatal=False)]
    valid, rejects = V.validate(d, rules)
    assert [r.n for r in valid.collect()] == [1] and sorted((r.errors, r.warnings) for r in rejects.collect()) == [("n", ""), ("n", "t")]
    assert V.validate(d, rules, "warn")[0].count() == 3
    with pytest.raises((PySparkException, Py4JJavaError)):
        V.validate(d, rules, "fail")[0].collect()
    assert V.differences(d, d).count() == 0 and V.differences(d, d.filter("n = 1")).count() == 2


def test_reconcile(spark):
    d = spark.createDataFrame([("p", "42 years", ""), ("p", "", "f"), ("p", None, "e"), ("q", "", "")], "k string, a string, g string")
    assert {r.k: (r.age, r.gender) for r in A.reconcile(d, ["k"], "a", "g").collect()} == {"p": (42, "e"), "q": (-1, None)}


def test_files(spark, tmp_path):
    d = spark.createDataFrame([(1, 'a, "b"\nc', None), (2, "", "x")], "n int, t string, u string")
    files.write_csv(d, f"{tmp_path}/c", single=True)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    assert sorted(r.n for r in files.read_csv(spark, f"{tmp_path}/c", d.schema).collect()) == [1, 2]
    (tmp_path / "bad.csv").write_text("n\nx\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_csv(spark, f"{tmp_path}/bad.csv", "n int").collect()
    (tmp_path / "old.csv").write_text("TokenID,Token\n3, HOLD\n")
    assert files.read_csv(spark, f"{tmp_path}/old.csv", schemas.schema("vocabulary"), legacy=True).collect() == [(3, "HOLD")]
    for v, n in (("v1", 10), ("v1", 9), ("v2", 1)):
        (tmp_path / "frames" / v).mkdir(parents=True, exist_ok=True)
        (tmp_path / "frames" / v / f"{n}.jpg").write_bytes(b"x")
    got = {(r.video, r.frame): r.frame_path[-6:] for r in files.list_frames(spark, f"{tmp_path}/frames").collect()}
    assert got == {("v1", 0): "/9.jpg", ("v1", 1): "10.jpg", ("v2", 0): "/1.jpg"}
    (tmp_path / "doc.xml").write_text(" <a>\r\n  <b/> \n</a>")
    assert files.read_documents(spark, f"{tmp_path}/doc.xml").collect() == [("doc.xml", "<a><b/></a>")]


def test_tables_registry(spark, tmp_path):
    assert len(schemas.TABLES) == 19 and all(set(k) <= set(schemas.schema(n).names) for n, (_, k) in schemas.TABLES.items())
    for n in schemas.TABLES:
        files.write_table(spark.createDataFrame([], schemas.schema(n)), f"{tmp_path}/{n}", schemas.key(n))
    assert all(df.schema == schemas.schema(n) for n, df in files.read_tables(spark, str(tmp_path)).items())


XML = """<SIGNSTREAM-DATABASE><PARTICIPANTS><PARTICIPANT ID="0" NAME="Ann" LABEL="A" AGE="42 years" GENDER="f" LANGUAGE="x"/>{p}</PARTICIPANTS>
<CODING-SCHEME><FIELD ID="1" NAME="head"><VALUE ID="7" NAME="jut"/>{v}</FIELD><FIELD ID="2" NAME="gloss" LABEL="main"/>{f}</CODING-SCHEME>
<MEDIA-FILES><MEDIA-FILE ID="5" LEGACY-PATH="disk:dir:a b.mov"/>{m}</MEDIA-FILES>
<UTTERANCE ID="63" S="1000" E="2000"><MEDIA-REF ID="{r}"/><SEGMENT PARTICIPANT-ID="0"><TRACK FID="1"><A S="0" E="100" VID="7">x</A><A S="100" E="100">free</A></TRACK>
<TRACK FID="2"><A S="50" E="150">SIGN</A></TRACK></SEGMENT>{u}</UTTERANCE></SIGNSTREAM-DATABASE>"""


def doc(**kw):
    return XML.format(**({"p": "", "v": "", "f": "", "m": "", "u": "", "r": "5"} | kw))


def test_shred(spark):
    parsed, rejects = X.parse(spark.createDataFrame([(1, doc()), (2, doc()[:-40])], "DocumentID int, xml string"))
    assert [r.DocumentID for r in rejects.collect()] == [2]
    t = X.shred(parsed)
    assert [(r.fid, r.pos, r.start_ms, r.end_ms, r.text) for r in t.token.orderBy("fid", "pos").collect()] == [(1, 0, 1000, 1100, "jut"), (1, 1, 1100, 1100, "free"), (2, 0, 1050, 1150, "SIGN")]
    assert [r.filename for r in t.media.collect()] == ["a b.mov"] and sorted(r.label for r in t.field.collect()) == ["head", "main"]
    assert X.problems(t).count() == 0
    assert X.with_coinciding(t.token, 2, 1).first().coinciding == "jut (1000-1100)"
    assert X.last_tier(t.token).first().translation == "SIGN"


@pytest.mark.parametrize("part,text,what", [
    ("p", '<PARTICIPANT ID="0" NAME="B" LABEL="B" AGE="" GENDER="" LANGUAGE=""/>', "duplicate participant"),
    ("v", '<VALUE ID="7" NAME="again"/>', "duplicate field value"),
    ("f", '<FIELD ID="2" NAME="again"/>', "duplicate field"),
    ("m", '<MEDIA-FILE ID="5" LEGACY-PATH="x"/>', "duplicate media"),
    ("u", '<SEGMENT PARTICIPANT-ID="0"/>', "duplicate utterance"),
    ("r", "6", "unknown media"),
])
def test_problems(spark, part, text, what):
    t = X.shred(X.parse(spark.createDataFrame([(1, doc(**{part: text}))], "DocumentID int, xml string"))[0])
    assert [r.problem for r in X.problems(t).collect()] == [what]


def test_stream_of_keys(spark, tmp_path):
    for i, words in enumerate((["b", "a"], ["c", "a"])):
        spark.createDataFrame([(w,) for w in words], "w string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        assign_ids(spark.readStream.schema("w string").parquet(f"{tmp_path}/in"), ["w"], "id", f"{tmp_path}/dim", f"{tmp_path}/cp").awaitTermination()
        got = {r.w: r.id for r in spark.read.parquet(f"{tmp_path}/dim/batch={i}").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
    assert scratch(spark, "x") != scratch(spark, "x")


def test_corpus_index_numbers_equal_names_by_their_ties(spark):
    rows = [("b", "x%d" % i, i) for i in range(300)] + [("a", "y", 7), (None, "z", 0), ("c", "w", 0)]
    docs = spark.createDataFrame(rows[::-1], "url string, html string, page int").repartition(5, "html")
    got = [(r.Filename, r.XML_B64) for r in B.corpus_index(docs, "url", "html", ("page",)).orderBy("DocumentID").collect()]
    assert got == [(u, base64.b64encode(h.encode()).decode()) for u, h, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[2]))]


def test_whole_files_share_folders(spark, tmp_path):
    rows = [(f"d {i}.txt", f"  p{i} \r\n ä{i}" if i % 9 else None) for i in range(500)]
    files.write_documents(spark.createDataFrame(rows, "filename string, text string").repartition(3, "filename"), f"{tmp_path}/t", 40)
    folders = [d for d in (tmp_path / "t").iterdir() if d.is_dir()]
    assert 13 <= len(folders) <= 15 and all(len([f for f in d.iterdir() if f.suffix == ".txt"]) <= 40 for d in folders)  # not one a file
    got = {unquote(r.filename): r.text for r in files.read_documents(spark, f"{tmp_path}/t").collect()}
    assert got == {name: "" if text is None else f"p{i}ä{i}" for i, (name, text) in enumerate(rows)}
