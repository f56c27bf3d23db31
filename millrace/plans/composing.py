"""End-to-end tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import url_quote
from millrace.operators import build
from millrace.operators import corpus as B
from millrace.operators import keys as K
from millrace.operators.shared import scratch, stored
from millrace.plans.documents import _TOKENS, documents
from millrace.plans.registry import query
from millrace.sources import schemas
from millrace.sources.files import frames_of, list_frame_folders


@query("SELECT row_number() OVER (ORDER BY url, page_id) - 1 AS DocumentID, url AS Filename, base64(encode(html)) AS XML_B64, length(base64(encode(html))) AS LEN FROM pages")
def corpus_index(t):
    return B.corpus_index(t.pages, "url", "html", ("page_id",))


@query("""SELECT row_number() OVER (ORDER BY Name) - 1 AS ASLConsultantID, * FROM (SELECT o_orderpriority AS Name, max(coalesce(TRY_CAST(regexp_extract(CAST(o_custkey AS VARCHAR), '([0-9]+)', 1) AS INTEGER), -1)) AS Age, coalesce(min(nullif(trim(o_orderstatus), '')), '') AS Gender FROM orders GROUP BY 1)""")
def build_consultants(t):
    return B.consultants(t.orders.withColumn("age", F.col("o_custkey").cast("string")), "o_orderpriority", "age", "o_orderstatus")


@query("SELECT DISTINCT l_orderkey, l_suppkey, o_orderstatus, s_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey")
def build_mapping(t):
    docs = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return B.mapping(t.lineitem, docs, t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_orderkey", "l_suppkey")


@query("SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS UtteranceSequence, string_split(text, ' ')[1] AS first, len(string_split(text, ' ')) AS n FROM conversations")
def build_utterances(t):
    u = K.position(t.conversations, ["conv_id", "role"], ["turn"], "UtteranceSequence")
    words = F.split("text", " ")
    return u.select("conv_id", "role", "turn", "UtteranceSequence", words[0].alias("first"), F.size(words).cast("long").alias("n"))


_VOCAB = "(SELECT word, row_number() OVER (ORDER BY word COLLATE C) - 1 AS TokenID FROM (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM conversations))"


@query(f"SELECT conv_id, turn, pos - 1 AS pos, TokenID FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS pos FROM conversations) JOIN {_VOCAB} USING (word)")
def build_vocabulary_tokens(t):
    tokens = t.conversations.select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("pos", "text"))
    return B.numbered_tokens(tokens, B.vocabulary(tokens)).select("conv_id", "turn", "pos", "TokenID")


@query("""SELECT l_orderkey, generate_subscripts(string_split(urls, ';'), 1) - 1 AS SegmentSequence, unnest(string_split(urls, ';')) AS URL, list_last(string_split(unnest(string_split(urls, ';')), '/')) AS SegmentVideoFilename
  FROM (SELECT l_orderkey, string_agg('v/' || l_partkey, ';' ORDER BY l_linenumber, l_partkey) AS urls FROM lineitem GROUP BY 1)""")
def build_video_tables(t):
    from millrace.operators.aggregates import ordered_list

    one = F.concat(F.lit("v/"), F.col("l_partkey").cast("string"))
    index = t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", one.alias("u")))), lambda x: x["u"]), ";").alias("urls"))
    return B.segments(index, "l_orderkey", "urls")


_STRATA = "SELECT DISTINCT o_custkey, o_orderpriority, o_orderkey FROM orders"
_CUT = f"""(SELECT *, count(*) OVER w AS n, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey)
  <= CASE WHEN count(*) OVER w > 9 THEN floor(count(*) OVER w * CAST(0.1 AS DOUBLE)) ELSE 1 END AS val FROM ({_STRATA}) WINDOW w AS (PARTITION BY o_custkey, o_orderpriority))"""


def _parts(t):
    frames = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey").join(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), "o_orderkey")
    return frames, B.split_frames(frames, ["o_custkey", "o_orderpriority"], "o_orderkey")


_FRAMES = "SELECT o_custkey, o_orderpriority, o_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN {} ON l_orderkey = o_orderkey"
#: Strata count only orders that have lines.
_WITH_LINES = _CUT.replace("FROM orders", "FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")


@query(_FRAMES.format(_WITH_LINES) + " WHERE n > 1 AND NOT val")
def split_train_assoc(t):
    return _parts(t)[1][0]


@query(_FRAMES.format(_WITH_LINES) + " WHERE n > 1 AND val")
def split_val(t):
    return _parts(t)[1][1]


@query(_FRAMES.format(_WITH_LINES) + " WHERE n = 1 OR NOT val")
def split_train_all(t):
    return _parts(t)[1][2]


@query(f"SELECT o_custkey FROM (SELECT DISTINCT o_custkey, o_orderpriority, o_orderkey, n = 1 OR NOT val AS hit FROM {_WITH_LINES}) GROUP BY 1 HAVING bool_and(hit)")
def complete_groups(t):
    frames, (_, _, train) = _parts(t)
    return B.complete_groups(train, frames, ["o_custkey"], ["o_orderkey"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_suppkey, FrameSequence FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s.s_suppkey,
  unnest(range(CAST(round_even(l_partkey % 1000 / 1000.0::DOUBLE * 10, 0) AS INTEGER), CAST(round_even((l_partkey % 1000 + CAST(l_quantity AS BIGINT) * 20) / 1000.0::DOUBLE * 10, 0) AS INTEGER))) AS FrameSequence
  FROM lineitem JOIN (SELECT s_suppkey // 4 AS u, s_suppkey FROM supplier) s ON l_suppkey // 4 = s.u)""")
def build_token_frames(t):
    tokens = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.floor(F.col("l_suppkey") / 4).alias("u"), (F.col("l_partkey") % 1000).alias("StartTime"), (F.col("l_partkey") % 1000 + F.col("l_quantity").cast("long") * 20).alias("EndTime"))
    videos = t.supplier.select(F.floor(F.col("s_suppkey") / 4).alias("u"), "s_suppkey")
    last = tokens.agg(F.ceil(F.max("EndTime") / 100).alias("last")).first()["last"] or 0  # of any token, at ten frames a second
    frames = videos.select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("FrameSequence"))
    found, _, _ = B.token_frames(tokens, videos, frames, ["u"], ["s_suppkey"], fps=10)
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "s_suppkey", "FrameSequence")


#: The made-up documents of ``plans/documents.py`` as a corpus: tokens with consultant ids (by name: other, user) and utterance numbers.
_IDS = f"(SELECT DocumentID AS conv, dense_rank() OVER (ORDER BY DocumentID) - 1 AS DocumentID, 1 - pid AS ASLConsultantID, uid, dense_rank() OVER (PARTITION BY DocumentID, pid ORDER BY uid) - 1 AS UtteranceSequence, fid, pos, start_ms, end_ms, text FROM {_TOKENS})"
_GLOSS = f"(SELECT i.*, v.TokenID FROM {_IDS} i JOIN (SELECT text, row_number() OVER (ORDER BY text COLLATE C) - 1 AS TokenID FROM (SELECT DISTINCT text FROM {_TOKENS} WHERE fid = 1)) v USING (text) WHERE fid = 1)"
_VIDEO = "(SELECT DISTINCT DocumentID, ASLConsultantID, UtteranceSequence, uid % 3 AS CameraPerspective, CASE uid % 3 WHEN 0 THEN 'front%20view.mov' ELSE 'side.mov' END AS TargetVideoFilename FROM " + _IDS + " WHERE uid % 3 < 2)"


def _named(docs):
    return docs.select(F.format_string("%09d.xml", "DocumentID").alias("Filename"), "xml")


def _inputs(t, fps=1, until=None):
    """All conversations as documents, two videos that the index lists, ``fps`` frames a second up to the latest ``until``, the second that a turn ends at (100 a turn where not given)."""
    index = t.spark.createDataFrame([("front%20view.mov", 0, 0, "v/a.mov;v/b.mov", "", "", ""), ("side.mov", 1, 1, "v/c.mov", "", "", "")], schemas.schema("video_index"))
    end = F.col("turn") * 100 + 100 if until is None else until
    last = t.conversations.agg(F.ceil(F.max(end) * fps)).first()[0] or 0
    frames = t.spark.range(last).select(F.explode(F.array(F.lit("front%20view"), F.lit("side"))).alias("video"), F.col("id").cast("int").alias("frame"), F.lit("").alias("frame_path"))
    return _named(documents(t)), index, frames


def _corpus(t, fps=1, until=None):
    return build.build_corpus(*_inputs(t, fps, until), gloss="gloss", fps=float(fps))


@query(f"""SELECT DocumentID, ASLConsultantID, UtteranceSequence, CAST(uid * 100000 AS INTEGER) AS StartTime, CAST(uid * 100000 + 99999 AS INTEGER) AS EndTime, string_agg(text, ' ' ORDER BY pos) FILTER (WHERE fid = 1) AS Tokens,
  string_agg(text, ' ' ORDER BY pos) FILTER (WHERE fid = last) AS Translation FROM (SELECT *, max(fid) OVER (PARTITION BY DocumentID, ASLConsultantID, uid) AS last FROM {_IDS}) GROUP BY DocumentID, ASLConsultantID, UtteranceSequence, uid""")
def build_utterance_table(t):
    return _corpus(t)["utterance"]


@query(f"SELECT DocumentID, ASLConsultantID, UtteranceSequence, pos AS TokenSequence, start_ms AS StartTime, end_ms AS EndTime, TokenID, 'gloss' AS Field, text AS FieldValue FROM {_GLOSS}")
def build_utterance_tokens(t):
    return _corpus(t)["utterance_token"]


@query(f"""SELECT 'v' AS kind, DocumentID, ASLConsultantID, CameraPerspective, TargetVideoFilename, -1 AS number FROM {_VIDEO} GROUP BY ALL UNION ALL SELECT 'u', DocumentID, ASLConsultantID, CameraPerspective, TargetVideoFilename, UtteranceSequence FROM {_VIDEO}
  UNION ALL SELECT 's', DocumentID, ASLConsultantID, CameraPerspective, TargetVideoFilename, unnest(CASE CameraPerspective WHEN 0 THEN [0, 1] ELSE [0] END) FROM (SELECT DISTINCT DocumentID, ASLConsultantID, CameraPerspective, TargetVideoFilename FROM {_VIDEO})""")
def build_video_family(t):
    """Videos, their utterances and their segments."""
    d = _corpus(t)
    one = lambda kind, df, n: df.select(F.lit(kind).alias("kind"), "DocumentID", "ASLConsultantID", "CameraPerspective", "TargetVideoFilename", n.cast("long").alias("number"))
    return one("v", d["video"], F.lit(-1)).unionByName(one("u", d["utterance_video"], F.col("UtteranceSequence"))).unionByName(one("s", d["video_segment"], F.col("SegmentSequence")))


@query(f"SELECT DocumentID, ASLConsultantID, CameraPerspective, TargetVideoFilename, FrameSequence FROM (SELECT DISTINCT DocumentID, ASLConsultantID, CameraPerspective, TargetVideoFilename FROM {_VIDEO}), (SELECT unnest(range((SELECT max(turn) * 100 + 100 FROM conversations))) AS FrameSequence)")
def build_video_frames(t):
    return _corpus(t)["video_frame"].drop("FramePath")


#: Frames of a token at one a second, half-even.
_TOKEN_FRAMES = f"(SELECT DocumentID, ASLConsultantID, CameraPerspective, TargetVideoFilename, UtteranceSequence, TokenSequence, TokenID, unnest(range(CAST(round_even(start_ms / 1000.0::DOUBLE, 0) AS BIGINT), CAST(round_even(end_ms / 1000.0::DOUBLE, 0) AS BIGINT))) AS FrameSequence FROM (SELECT *, pos AS TokenSequence FROM {_GLOSS}) JOIN {_VIDEO} USING (DocumentID, ASLConsultantID, UtteranceSequence))"


@query("SELECT * FROM " + _TOKEN_FRAMES.replace("1000.0::DOUBLE", "1000.0::DOUBLE * 30"))
def build_frames_of_tokens(t):
    """At 30 frames a second, as in the survey's source: two or three for each token's 90 ms.  Frames are listed up to the last token, also where a turn takes over 100 s."""
    words = F.length("text") * 0.02 + 0.1  # seconds at most: a word with its blank is two characters or more and starts 40 ms after the one before
    return _corpus(t, 30, F.col("turn") * 100 + F.greatest(F.lit(100.0), words))["utterance_token_frame"]


_PARTS = f"""(SELECT *, n = 1 AS one, rank <= CASE WHEN n > 9 THEN floor(n * CAST(0.1 AS DOUBLE)) ELSE 1 END AS val FROM (SELECT *, count(*) OVER (PARTITION BY TokenID, CameraPerspective) AS n, row_number() OVER (PARTITION BY TokenID, CameraPerspective ORDER BY md5(k), k) AS rank
  FROM (SELECT DISTINCT ASLConsultantID, TargetVideoFilename, UtteranceSequence, CameraPerspective, TokenSequence, TokenID, concat_ws('/', ASLConsultantID, TargetVideoFilename, UtteranceSequence, TokenSequence) AS k FROM {_TOKEN_FRAMES})))"""
_COMPLETE = f"""WITH tf AS (SELECT * FROM {_TOKEN_FRAMES}), parts AS (SELECT * FROM {_PARTS}),
  hit AS (SELECT a.ASLConsultantID, a.TargetVideoFilename, a.UtteranceSequence, a.CameraPerspective FROM (SELECT DISTINCT ASLConsultantID, TargetVideoFilename, UtteranceSequence, CameraPerspective, TokenSequence FROM tf) a
    LEFT JOIN (SELECT DISTINCT ASLConsultantID, TargetVideoFilename, UtteranceSequence, CameraPerspective, TokenSequence, true AS hit FROM parts WHERE one OR NOT val) b USING (ASLConsultantID, TargetVideoFilename, UtteranceSequence, CameraPerspective, TokenSequence) GROUP BY ALL HAVING bool_and(coalesce(hit, false)))"""


@query("SELECT count(*) AS n, CAST(coalesce(sum(bad), 0) AS BIGINT) AS failed FROM (SELECT 1 AS x, CAST(r.resolved IS DISTINCT FROM u.Tokens AS INTEGER) AS bad FROM (" + _COMPLETE + f""" SELECT DocumentID, ASLConsultantID, TargetVideoFilename, UtteranceSequence, CameraPerspective, string_agg(text, ' ' ORDER BY TokenSequence) AS resolved
  FROM (SELECT DISTINCT DocumentID, ASLConsultantID, TargetVideoFilename, UtteranceSequence, CameraPerspective, TokenSequence, TokenID FROM tf) JOIN hit USING (ASLConsultantID, TargetVideoFilename, UtteranceSequence, CameraPerspective) JOIN (SELECT DISTINCT TokenID, text FROM {_GLOSS}) USING (TokenID) GROUP BY ALL) r
  JOIN (SELECT DocumentID, ASLConsultantID, UtteranceSequence, string_agg(text, ' ' ORDER BY pos) AS Tokens FROM {_GLOSS} GROUP BY ALL) u USING (DocumentID, ASLConsultantID, UtteranceSequence))""")
def build_complete_utterances(t):
    """How many utterances are complete in the training part, and how many of these fail the comparison of texts."""
    d = _corpus(t)
    frames = stored(d["utterance_token_frame"])
    train = stored(build.build_splits({**d, "utterance_token_frame": frames})["train"])
    good, bad = build.complete_utterances(train, frames, d["utterance"], d["vocabulary"])
    return good.select(F.lit(0).alias("bad")).unionByName(bad.select(F.lit(1).alias("bad"))).agg(F.count("*").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("failed"))


_KEY = "ASLConsultantID, TargetVideoFilename, UtteranceSequence, CameraPerspective"
_UTTERANCE = f"""(SELECT DocumentID, ASLConsultantID, UtteranceSequence, CAST(uid * 100000 AS INTEGER) AS StartTime, CAST(uid * 100000 + 99999 AS INTEGER) AS EndTime, string_agg(text, ' ' ORDER BY pos) FILTER (WHERE fid = 1) AS Tokens,
  string_agg(text, ' ' ORDER BY pos) FILTER (WHERE fid = last) AS Translation FROM (SELECT *, max(fid) OVER (PARTITION BY DocumentID, ASLConsultantID, uid) AS last FROM {_IDS}) GROUP BY DocumentID, ASLConsultantID, UtteranceSequence, uid)"""


@query(f"""WITH tf AS (SELECT * FROM {_TOKEN_FRAMES}), parts AS (SELECT * FROM {_PARTS}),
  part AS (SELECT 'train_assoc' AS variant, * FROM parts WHERE NOT one AND NOT val UNION ALL SELECT 'val', * FROM parts WHERE NOT one AND val UNION ALL SELECT 'train', * FROM parts WHERE one OR NOT val),
  hit AS (SELECT variant, {_KEY} FROM (SELECT DISTINCT variant, {_KEY}, TokenSequence FROM tf, (VALUES ('train_assoc'), ('val'), ('train')) v(variant))
    LEFT JOIN (SELECT DISTINCT variant, {_KEY}, TokenSequence, true AS hit FROM part) USING (variant, {_KEY}, TokenSequence) GROUP BY ALL HAVING bool_and(coalesce(hit, false))),
  found AS (SELECT variant, DocumentID, {_KEY}, string_agg(CAST(TokenID AS VARCHAR), ' ' ORDER BY TokenSequence) AS TokenIDs, string_agg(text, ' ' ORDER BY TokenSequence) AS resolved
    FROM (SELECT DISTINCT DocumentID, {_KEY}, TokenSequence, TokenID FROM tf) JOIN hit USING ({_KEY}) JOIN (SELECT DISTINCT TokenID, text FROM {_GLOSS}) USING (TokenID) GROUP BY ALL)
  SELECT variant, resolved IS DISTINCT FROM Tokens AS failed, {_KEY}, StartTime, EndTime, TokenIDs, Tokens, Translation FROM found JOIN {_UTTERANCE} u USING (DocumentID, ASLConsultantID, UtteranceSequence)""")
def build_complete_rows(t):
    """All rows of the three tables of complete utterances, and those whose texts fail the comparison."""
    d = _corpus(t)
    d["utterance_token_frame"] = stored(d["utterance_token_frame"])
    made, out = build.build_splits(d), None
    cols = schemas.schema("complete_utterances_train").names
    failed = made["quarantine"].select(F.replace("table", F.lit("complete_utterances_"), F.lit("")).alias("variant"), F.from_json("row", schemas.schema("complete_utterances_train")).alias("r"))
    out = failed.select("variant", F.lit(True).alias("failed"), *[f"r.{c}" for c in cols])
    for variant in ("train_assoc", "val", "train"):
        out = out.unionByName(made[f"complete_utterances_{variant}"].select(F.lit(variant).alias("variant"), F.lit(False).alias("failed"), *cols))
    return out


#: Documents that the planted violations below make unreadable.
_BAD = "conv % 10 = 5 OR conv % 7 = 3"
_DOC = "DocumentID || '/' || ASLConsultantID"


@query(f"""WITH ids AS (SELECT * FROM {_IDS}), good AS (SELECT * FROM ids WHERE NOT ({_BAD})), silent AS (SELECT * FROM good WHERE conv % 11 = 2 AND text = 'HOLD' AND fid = 1),
  front AS (SELECT DISTINCT DocumentID, ASLConsultantID FROM good WHERE uid % 3 = 0),
  lost AS (SELECT * FROM (SELECT g.*, unnest(range(CAST(round_even(start_ms / 1000.0::DOUBLE, 0) AS BIGINT), CAST(round_even(end_ms / 1000.0::DOUBLE, 0) AS BIGINT))) AS frame FROM good g WHERE fid = 1 AND uid % 3 = 0 AND NOT (conv % 11 = 2 AND text = 'HOLD')) WHERE frame % 10 = 4)
SELECT 'document' AS part, CAST(DocumentID AS VARCHAR) AS key, 'document breaks no rule' AS rule, 'reject' AS severity FROM (SELECT DISTINCT DocumentID FROM ids WHERE {_BAD})
UNION ALL SELECT 'utterance_token', {_DOC} || '/' || UtteranceSequence || '/' || pos, 'token has a text', 'reject' FROM silent
UNION ALL SELECT 'video_index', 'side.mov', 'one camera per video', 'reject' FROM range(2)
UNION ALL SELECT 'utterance_video', {_DOC} || '/' || UtteranceSequence || '/side.mov', 'video is in the index', 'reject' FROM (SELECT DISTINCT DocumentID, ASLConsultantID, UtteranceSequence FROM good WHERE uid % 3 = 1)
UNION ALL SELECT 'utterance_media', DocumentID || '/' || (1 - ASLConsultantID) || '/' || uid || '/2', 'known media', 'warn' FROM (SELECT DISTINCT DocumentID, ASLConsultantID, uid FROM good WHERE uid % 3 = 2)
UNION ALL SELECT 'utterance_token_frame', {_DOC} || '/0/front%20view.mov/' || UtteranceSequence || '/' || pos, 'frame is there', 'reject' FROM (SELECT DISTINCT DocumentID, ASLConsultantID, UtteranceSequence, pos FROM lost)
UNION ALL SELECT 'utterance_video', 'front%20view.mov', 'one document per video', 'warn' FROM front HAVING count(DISTINCT DocumentID) > 1
UNION ALL SELECT 'utterance_video', 'front%20view.mov', 'one consultant per video', 'warn' FROM front HAVING count(DISTINCT ASLConsultantID) > 1""")
def build_rejects(t):
    """What a job leaves out, with violations of most kinds planted: cut documents, a participant twice, values without a name, a video under two cameras, lost frames."""
    i = F.col("DocumentID")
    xml = F.when(i % 10 == 5, F.expr("substring(xml, 1, length(xml) - 30)")).when(i % 7 == 3, F.replace("xml", F.lit("</PARTICIPANTS>"), F.lit('<PARTICIPANT ID="1" NAME="again"/></PARTICIPANTS>'))).when(i % 11 == 2, F.replace("xml", F.lit('NAME="HOLD"'), F.lit('NAME=""'))).otherwise(F.col("xml"))
    index = t.spark.createDataFrame([("front%20view.mov", 0, 0, "v/a.mov;v/b.mov", "", "", ""), ("side.mov", 1, 1, "v/c.mov", "", "", ""), ("side.mov", 2, 4, "v/c.mov", "", "", "")], schemas.schema("video_index"))
    last = t.conversations.agg(F.max("turn") * 100 + 100).first()[0] or 0
    frames = t.spark.range(last).filter("id % 10 != 4").select(F.lit("front view").alias("video"), F.col("id").cast("int").alias("frame"), F.lit("").alias("frame_path"))
    found = build.build_corpus(_named(documents(t).withColumn("xml", xml)), index, frames, gloss="gloss", fps=1.0)["quarantine"]
    return found.select(F.col("table").alias("part"), "key", "rule", "severity")


@query(f"""SELECT DocumentID, ASLConsultantID, CameraPerspective, TargetVideoFilename, CAST(f AS INTEGER) AS FrameSequence, 'x/' || CASE CameraPerspective WHEN 0 THEN 'front view' ELSE 'side' END || '/' || f || '.jpg' AS FramePath
  FROM (SELECT DISTINCT DocumentID, ASLConsultantID, CameraPerspective, TargetVideoFilename FROM {_VIDEO}), (SELECT unnest(range(12)) AS f)""")
def build_frame_paths(t):
    """Frames by the stem of the file name, whatever its extension: paths as they are listed."""
    docs = _named(documents(t).withColumn("xml", F.replace("xml", F.lit("side.mov"), F.lit("side.v2.avi"))))
    index = t.spark.createDataFrame([("front%20view.mov", 0, 0, "v/a.mov", "", "", ""), ("side.v2.avi", 1, 1, "v/c.mov", "", "", "")], schemas.schema("video_index"))
    paths = t.spark.range(12).select(F.explode(F.array(F.lit("front view"), F.lit("side.v2"))).alias("v"), F.col("id").cast("string").alias("n")).select(F.format_string("x/%s/%s.jpg", "v", "n").alias("path"))
    made = build.build_corpus(docs, index, frames_of(paths), gloss="gloss", fps=1.0)["video_frame"]
    plain = lambda c: F.replace(F.replace(c, F.lit("side.v2.avi"), F.lit("side.mov")), F.lit("side.v2"), F.lit("side"))
    return made.withColumns({c: plain(F.col(c)) for c in ("TargetVideoFilename", "FramePath")})


_COUNTED = {
    "video_index": "SELECT * FROM range(2)", "corpus": f"SELECT DISTINCT DocumentID FROM {_IDS}", "consultant": "SELECT * FROM range(2)", "document_consultant": f"SELECT DISTINCT DocumentID, k FROM {_IDS}, range(2) r(k)",
    "utterance": f"SELECT DISTINCT DocumentID, ASLConsultantID, uid FROM {_IDS}", "video": f"SELECT DISTINCT DocumentID, ASLConsultantID, CameraPerspective FROM {_VIDEO}", "video_utterance": f"SELECT * FROM {_VIDEO}", "utterance_video": f"SELECT * FROM {_VIDEO}",
    "video_segment": f"SELECT DISTINCT DocumentID, ASLConsultantID, CameraPerspective, k FROM {_VIDEO}, range(2) r(k) WHERE k = 0 OR CameraPerspective = 0",
    "video_frame": f"SELECT * FROM (SELECT DISTINCT DocumentID, ASLConsultantID, CameraPerspective FROM {_VIDEO}), (SELECT unnest(range((SELECT max(turn) * 100 + 100 FROM conversations))))",
    "vocabulary": f"SELECT DISTINCT text FROM {_TOKENS} WHERE fid = 1", "utterance_token": f"SELECT * FROM {_GLOSS}", "utterance_token_frame": f"SELECT DISTINCT * FROM {_TOKEN_FRAMES}",
} | {
    name: f"SELECT DISTINCT TokenID, CameraPerspective, ASLConsultantID, TargetVideoFilename, UtteranceSequence, TokenSequence, FrameSequence FROM {_TOKEN_FRAMES} JOIN (SELECT * FROM {_PARTS} WHERE {where}) USING (ASLConsultantID, TargetVideoFilename, UtteranceSequence, CameraPerspective, TokenSequence, TokenID)"
    for name, where in (("train_assoc", "NOT one AND NOT val"), ("val", "NOT one AND val"), ("train", "one OR NOT val"))
}


@query(" UNION ALL ".join(f"SELECT '{name}' AS part, count(*) AS n_rows FROM ({sql})" for name, sql in _COUNTED.items()))
def job_tables(t):
    """The whole job into a folder, then asked for again: rows of its tables as the manifest has them."""
    path, folder = scratch(t.spark, "inputs"), scratch(t.spark, "job")
    docs, index, frames = _inputs(t)
    sources = {name: f"{path}/{name}" for name in ("docs", "index", "frames")}
    for df, to in zip((docs, index, frames), sources.values()):
        df.write.parquet(to)
    read = lambda s: tuple(t.spark.read.parquet(p) for p in s.values())
    made = build.corpus_job(t.spark, folder, sources, read, gloss="gloss", fps=1.0)
    again = build.corpus_job(t.spark, folder, sources, None, gloss="gloss", fps=1.0)  # nothing is read
    if again != made:
        raise AssertionError("the second run isn't the first")
    rows = [(name, m["rows"]) for name, m in made["tables"].items() if name in _COUNTED]
    return t.spark.createDataFrame(rows, "part string, n_rows long")


@query("""SELECT v.video || '.' || e AS TargetVideoFilename, row_number() OVER (PARTITION BY v.video, e ORDER BY s_suppkey) - 1 AS FrameSequence, v.video || '/' || s_suppkey || '.jpg' AS FramePath
  FROM (SELECT 'video ' || s_nationkey || '.x' AS video, s_suppkey FROM supplier) v, (VALUES ('avi'), ('mp4')) x(e)""")
def frame_folders(t):
    """Frames of files in folders, a folder a video, listed by tasks and joined to videos by the stem of their names, with a dot and a blank in it."""
    path = scratch(t.spark, "frames")
    video = F.concat(F.lit("video "), F.col("s_nationkey").cast("string"), F.lit(".x"))

    def touch(batches):
        from pyarrow.fs import FileSystem

        for b in batches:
            for name, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, at = FileSystem.from_uri(path)
                store.create_dir(f"{at}/{name}")
                store.open_output_stream(f"{at}/{name}/{n}.jpg").close()
            yield b

    made = t.supplier.select(video.alias("video"), "s_suppkey").mapInArrow(touch, "video string, s_suppkey long")
    videos = made.select("video").distinct().select(F.explode(F.array(F.concat("video", F.lit(".avi")), F.concat("video", F.lit(".mp4")))).alias("name"))
    videos = stored(videos.select(url_quote(F.col("name")).alias("TargetVideoFilename")))
    found = B.frames_of_videos(videos, list_frame_folders(t.spark, path))
    return found.select(F.url_decode("TargetVideoFilename").alias("TargetVideoFilename"), "FrameSequence", F.replace("FramePath", F.lit(f"{path}/"), F.lit("")).alias("FramePath"))
