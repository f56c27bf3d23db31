"""Rules and quarantine: planted violations of each kind, severities, and the build job on a small corpus by hand."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import build
from millrace.operators.rules import BrokenRules, Key, Quarantine, Row

ROWS = [(1, "a", 5), (1, "b", 5), (2, "a", -1), (2, "c", None), (3, "d", 1), (3, "d", 1), (None, "e", 2), (None, "f", 3)]


def rules():
    return [Row("positive", F.col("n") >= 0), Key("one name", ("k",), ("name",)), Key("one row", ("k", "name"), (), "warn"), Key("one n", ("k",), ("n",), "warn")]


def found(aside, df):
    return sorted((r.table, r.key, r.rule, r.severity, r.row or "") for r in aside.table(df).collect())


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "k int, name string, n int")


def test_quarantine(spark, table):
    aside = Quarantine()
    valid = aside.check(table, "t", ["k", "name"], rules())
    assert sorted((r.k or 0, r.name, r.n) for r in valid.collect()) == [(0, "e", 2), (0, "f", 3), (3, "d", 1), (3, "d", 1)]
    assert valid.columns == ["k", "name", "n"]
    js = lambda k, name, n: json.dumps({c: v for c, v in (("k", k), ("name", name), ("n", n)) if v is not None}, separators=(",", ":"))
    assert found(aside, table) == sorted([
        ("t", "2/a", "positive", "reject", js(2, "a", -1)), ("t", "2/c", "positive", "reject", js(2, "c", None)),
        *[("t", f"{k}/{x}", "one name", "reject", js(k, x, n)) for k, x, n in ROWS[:4]],
        ("t", "3/d", "one row", "warn", ""), ("t", "2", "one n", "warn", ""),
    ])


def test_severities(spark, table):
    with pytest.raises(BrokenRules, match="t: one name: 4"):
        Quarantine({"one name": "fail"}).check(table, "t", ["k"], rules())
    aside = Quarantine({"one name": "warn", "positive": "warn"})
    assert aside.check(table, "t", ["k"], rules()).count() == 8 and {r.severity for r in aside.table(table).collect()} == {"warn"}
    with pytest.raises(BrokenRules):
        Quarantine({"r": "fail"}).put(table, "t", "r", ["k"])
    with pytest.raises(ValueError, match="no such severity"):
        Quarantine({"r": "loud"})
    assert Quarantine({"one name": "fail", "positive": "fail"}).check(table.filter("k = 3"), "t", ["k"], rules()).count() == 2
    none = Quarantine()
    assert none.check(table.limit(0), "t", ["k"], rules()).count() == 0 and none.table(table).count() == 0


def test_a_hot_key_combines_before_its_shuffle(spark):
    """One key with all rows: the shuffle of its aggregation gets a row from each task, not the key's rows."""
    df = spark.range(0, 200_000, 1, 8).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    aside = Quarantine()
    assert aside.check(df, "t", ["k", "v"], [Key("one", ("k",), ("v",), "warn")]).count() == 200_000
    assert [(r.key, r.row) for r in aside.table(df).collect()] == [("1", None)]
    plan = df.groupBy("k").agg(F.min(F.struct("v")) != F.max(F.struct("v")))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def document(people, utterances, media, fields='<FIELD ID="1" NAME="main gloss"><VALUE ID="7" NAME="HOLD"/></FIELD><FIELD ID="2" NAME="translation"/>'):
    """``people``: (id, name, age, gender); ``utterances``: (id, start, end, person, media ids, {field: [(start, end, text, value id)]})."""
    tok = lambda s, e, x, v: f'<A S="{s}" E="{e}"' + (f' VID="{v}"' if v else "") + f">{x}</A>"
    one = lambda u, s, e, p, ms, ts: f'<UTTERANCE ID="{u}" S="{s}" E="{e}">' + "".join(f'<MEDIA-REF ID="{m}"/>' for m in ms) + f'<SEGMENT PARTICIPANT-ID="{p}">' + "".join(f'<TRACK FID="{f}">' + "".join(tok(*x) for x in xs) + "</TRACK>" for f, xs in ts.items()) + "</SEGMENT></UTTERANCE>"
    return (
        "<SIGNSTREAM-DATABASE>\n<PARTICIPANTS>" + "".join(f'<PARTICIPANT ID="{i}" NAME="{n}" AGE="{a}" GENDER="{g}" LABEL="x" LANGUAGE="y"/>' for i, n, a, g in people) + "</PARTICIPANTS>\n<CODING-SCHEME>" + fields
        + "</CODING-SCHEME>\n<MEDIA-FILES>" + "".join(f'<MEDIA-FILE ID="{i}" LEGACY-PATH="disk:{n}"/>' for i, n in media.items()) + "</MEDIA-FILES>\n<UTTERANCES>" + "".join(one(*u) for u in utterances) + "</UTTERANCES>\n</SIGNSTREAM-DATABASE>"
    )


GOOD = document(
    [(0, "Ann", "42 years", "f"), (1, "Bob", "", "")],
    [(5, 1000, 3000, 0, [0], {1: [(0, 200, "x", 7), (200, 500, "go", None)], 2: [(0, 500, "he goes", None)]}), (9, 5000, 6000, 0, [0], {1: [(0, 100, "go", None)]}), (6, 0, 900, 1, [1], {1: [(100, 400, "now", None)]})],
    {0: "front one.mov", 1: "side.cam.avi"},
)
TWICE = GOOD.replace("</PARTICIPANTS>", '\n<PARTICIPANT ID="1" NAME="again"/></PARTICIPANTS>')
MANY = document([(0, "Cy", "7", "m")], [(1, 0, 1000, 0, [0, 1, 2, 3, 4], {1: [(0, 100, "go", None)]}), (2, 0, 1000, 0, [0, 9], {1: [(0, 300, "end", None), (0, 100, "", None)]})], {0: "m0.mov", 1: "m1.mov", 2: "m2.mov", 3: "m3.mov", 4: "m4.mov", 5: "lost.mov"})
NAMELESS = document([(0, " ", "7", "m"), (1, "Ann", "50", "x")], [(1, 0, 1000, 0, [0], {1: [(0, 100, "go", None)]}), (2, -5, 10, 1, [0], {1: [(0, 100, "go", None)]}), (3, 0, 10, 1, [1], {1: [(0, 10, "hm", None)]})], {0: "m0.mov", 1: "lost.mov"})
DOCS = [("a.xml", GOOD), ("b.xml", TWICE), ("c.xml", MANY), ("d.xml", NAMELESS), ("e.xml", GOOD[:-40]), ("f.xml", GOOD.replace("Ann", "Zoe")), ("f.xml", GOOD.replace("Ann", "Ann"))]
INDEX = [("front%20one.mov", 1, 0, "u/f0.mov;u/f1.mov", "", "", ""), ("side.cam.avi", 2, 1, "u/s.mov", "", "", "")] + [(f"m{i}.mov", 3 + i, i, f"u/m{i}.mov", "", "", "") for i in range(5)] + [("m4.mov", 9, 8, "u/other.mov", "", "", ""), ("bad.mov", 10, -1, "u/b.mov", "", "", "")]
FRAMES = [("front one", i, f"p/{i}.jpg") for i in range(200)] + [("side.cam", i, "") for i in range(9)] + [(f"m{i}", n, "") for i in range(5) for n in range(40)]


@pytest.fixture(scope="module")
def inputs(spark):
    from millrace.sources import schemas

    return spark.createDataFrame(DOCS, "Filename string, xml string"), spark.createDataFrame(INDEX, schemas.schema("video_index")), spark.createDataFrame(FRAMES, "video string, frame int, frame_path string")


@pytest.fixture(scope="module")
def corpus(inputs):
    return {name: df.cache() for name, df in build.build_corpus(*inputs, most_videos=3).items()}


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_build_corpus(corpus):
    """Documents by file name: a 0, b 1, c 2, d 3, e 4, f 5; consultants Ann 0, Bob 1, Cy 2."""
    assert rows(corpus["corpus"], "DocumentID", "Filename") == list(enumerate(["a.xml", "b.xml", "c.xml", "d.xml", "e.xml", "f.xml"]))
    assert rows(corpus["consultant"], "ASLConsultantID", "Name", "Age", "Gender") == [(0, "Ann", 50, "f"), (1, "Bob", -1, ""), (2, "Cy", 7, "m")]
    assert rows(corpus["document_consultant"], "DocumentID", "ASLConsultantID", "ParticipantName") == [(0, 0, "Ann"), (0, 1, "Bob"), (2, 2, "Cy"), (3, 0, "Ann"), (5, 0, "Ann"), (5, 1, "Bob")]
    assert (0, 0, 0, 1000, 3000, "HOLD go", "he goes") in rows(corpus["utterance"], "DocumentID", "ASLConsultantID", "UtteranceSequence", "StartTime", "EndTime", "Tokens", "Translation")
    assert rows(corpus["vocabulary"], "TokenID", "Token") == [(0, "HOLD"), (1, "end"), (2, "go"), (3, "hm"), (4, "now")]
    assert [r for r in rows(corpus["utterance_token"], "DocumentID", "ASLConsultantID", "UtteranceSequence", "TokenSequence", "StartTime", "EndTime", "TokenID") if r[0] == 0] == [
        (0, 0, 0, 0, 1000, 1200, 0), (0, 0, 0, 1, 1200, 1500, 2), (0, 0, 1, 0, 5000, 5100, 2), (0, 1, 0, 0, 100, 400, 4)]
    assert [r for r in rows(corpus["video"], "DocumentID", "ASLConsultantID", "CameraPerspective", "TargetVideoFilename") if r[0] == 0] == [(0, 0, 0, "front%20one.mov"), (0, 1, 1, "side.cam.avi")]
    assert [r for r in rows(corpus["video_segment"], "DocumentID", "ASLConsultantID", "SegmentSequence", "SegmentVideoFilename") if r[:2] == (0, 0)] == [(0, 0, 0, "f0.mov"), (0, 0, 1, "f1.mov")]
    assert corpus["video_frame"].filter("DocumentID = 0").count() == 209 and corpus["video_frame"].filter("FramePath = 'p/7.jpg' AND DocumentID = 0").count() == 1
    at = lambda d, c: [r[2:] for r in rows(corpus["utterance_token_frame"], "DocumentID", "ASLConsultantID", "UtteranceSequence", "TokenSequence", "FrameSequence") if r[:2] == (d, c)]
    assert at(0, 0) == [(0, 0, n) for n in range(30, 36)] + [(0, 1, n) for n in range(36, 45)] + [(1, 0, n) for n in range(150, 153)]
    assert at(0, 1) == [(0, 0, n) for n in range(3, 9)]  # frames 9 to 11 aren't there
    assert {r.target_video_filename for r in corpus["video_index"].collect()} == {"front%20one.mov", "side.cam.avi", "m0.mov", "m1.mov", "m2.mov", "m3.mov"}


def test_quarantine_of_the_job(corpus):
    got = sorted((r.table, r.key, r.rule, r.severity) for r in corpus["quarantine"].collect())
    assert got == sorted([
        ("corpus", "f.xml", "one document per file name", "reject"),
        ("document", "1", "document breaks no rule", "reject"), ("document", "4", "document breaks no rule", "reject"),
        ("participant", "3/0", "participant has a name", "reject"),
        ("utterance", "3/0/2", "numbers aren't negative", "reject"),
        ("utterance_token", "2/2/1/1", "token has a text", "reject"),
        ("utterance_media", "2/0/2/9", "known media", "warn"),
        ("video_index", "m4.mov", "one camera per video", "reject"), ("video_index", "m4.mov", "one camera per video", "reject"),
        ("video_index", "m4.mov", "one segment list per video", "reject"), ("video_index", "m4.mov", "one segment list per video", "reject"),
        ("video_index", "bad.mov", "video has a camera", "reject"),
        ("utterance_video", "2/2/0/m4.mov", "video is in the index", "reject"), ("utterance_video", "3/0/1/lost.mov", "video is in the index", "reject"),
        ("utterance_video", "front%20one.mov", "one document per video", "warn"), ("utterance_video", "side.cam.avi", "one document per video", "warn"),
        ("utterance_token_frame", "0/1/1/side.cam.avi/0/0", "frame is there", "reject"), ("utterance_token_frame", "5/1/1/side.cam.avi/0/0", "frame is there", "reject"),
        ("utterance_video", "2/2/0", "not in too many videos", "reject"),
    ])
    where = {r.key: json.loads(r.row) for r in corpus["quarantine"].filter("table = 'document'").collect()}
    assert (where["1"]["cause"], where["1"]["line"], where["1"]["column"]) == ("duplicate participant", 3, 0) and where["4"]["cause"] == "unclosed tag"
    lost = json.loads(corpus["quarantine"].filter("key = '0/1/1/side.cam.avi/0/0'").first().row)
    assert (lost["n_missing"], lost["first"], lost["last"]) == (3, 9, 11)


def test_strict_job_stops(inputs):
    with pytest.raises(BrokenRules, match="one document per file name"):
        build.build_corpus(*inputs, severity=build.STRICT)
    docs, index, frames = inputs
    with pytest.raises(BrokenRules, match="one camera per video: 2"):
        build.build_corpus(docs.filter("Filename = 'a.xml'"), index, frames, severity={"one camera per video": "fail"})


def test_build_splits(corpus):
    """Token 'go' of camera 0 has several occurrences and is split; the others are single and train only."""
    made = build.build_splits(corpus)
    key = ("TokenID", "CameraPerspective", "ASLConsultantID", "TargetVideoFilename", "UtteranceSequence", "TokenSequence", "FrameSequence")
    frames = sorted(set(rows(corpus["utterance_token_frame"], *key)))
    parts = {n: rows(made[n], *key) for n in ("train_assoc", "val", "train")}
    assert set(parts["train_assoc"]) <= set(parts["train"]) and not set(parts["val"]) & set(parts["train"]) and sorted(set(parts["val"]) | set(parts["train"])) == frames
    occurrences = {}
    for r in frames:
        occurrences.setdefault(r[:2], set()).add(r[2:6])
    assert {r[:2] for r in parts["val"]} == {k for k, v in occurrences.items() if len(v) > 1}
    whole = {}
    for r in frames:
        whole.setdefault((r[2], r[3], r[4], r[1]), set()).add(r[5])
    failed = {(r.table, r.key) for r in made["quarantine"].collect()}
    for n, part in parts.items():
        have = {}
        for r in part:
            have.setdefault((r[2], r[3], r[4], r[1]), set()).add(r[5])
        want = {k for k, v in whole.items() if have.get(k) == v}
        got = set(rows(made[f"complete_utterances_{n}"], "ASLConsultantID", "TargetVideoFilename", "UtteranceSequence", "CameraPerspective"))
        assert got | {tuple(int(x) if x.isdigit() else x for x in k.split("/")) for t, k in failed if t == f"complete_utterances_{n}"} == want
    assert set(made) == {"train_assoc", "val", "train", "complete_utterances_train_assoc", "complete_utterances_val", "complete_utterances_train", "quarantine"}
