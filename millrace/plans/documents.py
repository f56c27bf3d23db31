"""Annotation documents, made from conversations: a conversation is a document, a role a participant, a turn an
utterance, its words are tokens of the tier 1 (odd places) or 2."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregates import ordered_list
from millrace.operators.shared import stored
from millrace.operators.validate import dangling, differences, document_differences
from millrace.plans.registry import Tables, query
from millrace.sources import annotations as X
from millrace.sources.positions import errors

#: Words of a turn with their place.
_WORDS = "(SELECT conv_id, turn, role, unnest(string_split(w, ' ')) AS word, generate_subscripts(string_split(w, ' '), 1) - 1 AS i FROM (SELECT conv_id, turn, role, trim(regexp_replace(text, '[^A-Za-z]+', ' ', 'g')) AS w FROM conversations) WHERE w <> '')"
#: The same as tokens: every sixth word has the controlled value HOLD.
_TOKENS = f"(SELECT conv_id AS DocumentID, CASE WHEN role = 'user' THEN 0 ELSE 1 END AS pid, turn AS uid, CASE WHEN i % 2 = 0 THEN 1 ELSE 2 END AS fid, i // 2 AS pos, turn * 100000 + i * 40 AS start_ms, turn * 100000 + i * 40 + 90 AS end_ms, CASE WHEN i % 6 = 0 THEN 'HOLD' ELSE word END AS text, i FROM {_WORDS})"


def documents(t: Tables):
    """``(DocumentID, xml)``: one XML text per conversation."""
    w = F.trim(F.regexp_replace("text", "[^A-Za-z]+", " "))
    turn = t.conversations.select("conv_id", "turn", "role", w.alias("w")).filter("w != ''")
    pid = F.when(F.col("role") == "user", 0).otherwise(1)
    tok = lambda x, i: F.concat(F.lit('<A S="'), (i * 40).cast("string"), F.lit('" E="'), (i * 40 + 90).cast("string"), F.when(i % 6 == 0, F.lit('" VID="7">-')).otherwise(F.concat(F.lit('">'), x)), F.lit("</A>"))
    toks = F.transform(F.split("w", " "), tok)
    tier = lambda k: F.array_join(F.filter(toks, lambda x, i: i % 2 == k), "")
    at = lambda c: c.cast("string")
    body = F.concat(F.lit('<UTTERANCE ID="'), at(F.col("turn")), F.lit('" S="'), at(F.col("turn") * 100000), F.lit('" E="'), at(F.col("turn") * 100000 + 99999), F.lit('"><MEDIA-REF ID="'), at(F.col("turn") % 3), F.lit('"/><SEGMENT PARTICIPANT-ID="'), at(pid), F.lit('"><TRACK FID="1">'), tier(0), F.lit('</TRACK><TRACK FID="2">'), tier(1), F.lit("</TRACK></SEGMENT></UTTERANCE>"))
    head = ('<SIGNSTREAM-DATABASE><PARTICIPANTS><PARTICIPANT ID="0" NAME="user" LABEL="u" AGE="42 years" GENDER="female" LANGUAGE="x"/><PARTICIPANT ID="1" NAME="other" LABEL="o" AGE="" GENDER="" LANGUAGE="x"/></PARTICIPANTS>'
            '<CODING-SCHEME><FIELD ID="1" NAME="gloss"><VALUE ID="7" NAME="HOLD"/></FIELD><FIELD ID="2" NAME="translation" LABEL="english"><VALUE ID="7" NAME="HOLD"/></FIELD></CODING-SCHEME>'
            '<MEDIA-FILES><MEDIA-FILE ID="0" LEGACY-PATH="disk:movies:front view.mov"/><MEDIA-FILE ID="1" LEGACY-PATH="disk:movies:side.mov"/></MEDIA-FILES><UTTERANCES>')
    doc = turn.select("conv_id", "turn", body.alias("u")).groupBy("conv_id").agg(F.array_join(ordered_list("turn", "u"), "").alias("u"))
    return doc.select(F.col("conv_id").alias("DocumentID"), F.concat(F.lit(head), "u", F.lit("</UTTERANCES></SIGNSTREAM-DATABASE>")).alias("xml"))


def tables(t: Tables) -> X.Tables:
    return X.shred(X.parse(documents(t))[0])


@query(f"SELECT DocumentID, pid, uid, fid, pos, start_ms, end_ms, text FROM {_TOKENS}")
def xml_roundtrip_shred(t):
    return tables(t).token.select("DocumentID", "pid", "uid", "fid", "pos", "start_ms", "end_ms", "text")


@query("SELECT DISTINCT conv_id AS DocumentID FROM conversations WHERE conv_id % 5 = 0 AND regexp_matches(text, '[A-Za-z]')")
def xml_corrupt_record(t):
    """Every fifth document loses its end and is rejected; the others parse."""
    cut = F.when(F.col("DocumentID") % 5 == 0, F.expr("substring(xml, 1, length(xml) - 30)")).otherwise(F.col("xml"))
    _, rejects = X.parse(documents(t).withColumn("xml", cut))
    return rejects.select("DocumentID")


@query("SELECT conv_id AS DocumentID, id, name FROM (SELECT DISTINCT conv_id FROM conversations WHERE regexp_matches(text, '[A-Za-z]')), (VALUES (0, 'p:user'), (1, 'p:other'), (1, 'f:gloss'), (2, 'f:translation'), (0, 'm:front view.mov'), (1, 'm:side.mov')) v(id, name)")
def doc_list_ordered(t):
    d = tables(t)
    tag = lambda df, i, name, p: df.select("DocumentID", F.col(i).alias("id"), F.concat(F.lit(p), name).alias("name"))
    return tag(d.participant, "pid", "name", "p:").unionByName(tag(d.field, "fid", "name", "f:")).unionByName(tag(d.media, "mid", "filename", "m:")).orderBy("DocumentID", "id")


@query("SELECT conv_id AS DocumentID, name FROM (SELECT DISTINCT conv_id FROM conversations WHERE regexp_matches(text, '[A-Za-z]')), (VALUES ('gloss'), ('translation'), ('user')) v(name)")
def doc_get_by_id_or_label(t):
    d = tables(t)
    got = X.by_id_or_label(d.field, "fid", 1).unionByName(X.by_id_or_label(d.field, "fid", "english")).select("DocumentID", "name")
    return got.unionByName(X.by_id_or_label(d.participant, "pid", "u").select("DocumentID", "name"))


@query(f"SELECT DocumentID, pid, uid, string_agg(text, ' ' ORDER BY pos) AS translation FROM (SELECT *, max(fid) OVER (PARTITION BY DocumentID, pid, uid) AS last FROM {_TOKENS}) WHERE fid = last GROUP BY ALL")
def doc_last_tier(t):
    return X.last_tier(tables(t).token)


@query(f"SELECT u.DocumentID, u.pid, u.uid, pos, text FROM (SELECT DISTINCT DocumentID, pid, uid FROM {_TOKENS}) u LEFT JOIN (SELECT * FROM {_TOKENS} WHERE fid = 2) k USING (DocumentID, pid, uid)")
def doc_tokens_for_field(t):
    d = tables(t)
    return X.tokens_of_field(d.token, d.utterance, 2, keep_missing=True).select("DocumentID", "pid", "uid", "pos", "text")


@query(f"SELECT DISTINCT DocumentID, uid, CASE uid % 3 WHEN 0 THEN 'front view.mov' WHEN 1 THEN 'side.mov' END AS filename FROM {_TOKENS} WHERE uid % 3 < 2")
def doc_media_per_utterance(t):
    d = tables(t)
    return d.utterance_media.join(d.media, ["DocumentID", "mid"]).select("DocumentID", "uid", "filename").distinct()


@query(f"SELECT DISTINCT DocumentID, CAST(2 AS INTEGER) AS mid FROM {_TOKENS} WHERE uid % 3 = 2")
def validate_media_refs(t):
    d = tables(t)
    return dangling(d.utterance_media.select("DocumentID", "mid").distinct(), d.media, ["DocumentID", "mid"])


@query(f"SELECT DocumentID, pid, uid, string_agg(text || ' (' || start_ms || '-' || end_ms || ')', ', ' ORDER BY pos) AS glosses FROM {_TOKENS} WHERE fid = 1 GROUP BY ALL")
def doc_gloss_listing(t):
    own = tables(t).token.filter("fid = 1")
    one = X.format_interval(F.col("text"), F.col("start_ms"), F.col("end_ms"))
    return own.groupBy("DocumentID", "pid", "uid").agg(F.array_join(ordered_list("pos", one), ", ").alias("glosses"))


@query(f"""SELECT a.DocumentID, a.pid, a.uid, a.pos, a.text, coalesce(string_agg(b.text || ' (' || b.start_ms || '-' || b.end_ms || ')', ', ' ORDER BY b.pos), '') AS coinciding
  FROM (SELECT * FROM {_TOKENS} WHERE fid = 1) a LEFT JOIN (SELECT * FROM {_TOKENS} WHERE fid = 2) b ON a.DocumentID = b.DocumentID AND a.pid = b.pid AND a.uid = b.uid
    AND ((a.start_ms >= b.start_ms AND a.start_ms < b.end_ms) OR (a.end_ms > b.start_ms AND a.end_ms <= b.end_ms)) GROUP BY ALL""")
def doc_gloss_with_coinciding(t):
    return X.with_coinciding(tables(t).token, 1, 2).select("DocumentID", "pid", "uid", "pos", "text", "coinciding")


@query(f"SELECT DocumentID, pid, uid, fid, pos, i % 6 = 0 AS standard FROM {_TOKENS}")
def doc_standard_tokens(t):
    token = tables(t).token
    return token.select("DocumentID", "pid", "uid", "fid", "pos", X.standard(token).alias("standard"))


@query(f"SELECT DocumentID, 'unknown media' AS problem, '2' AS id FROM {_TOKENS} WHERE uid % 3 = 2 GROUP BY 1 UNION ALL SELECT DISTINCT DocumentID, 'duplicate participant', '1' FROM {_TOKENS} WHERE DocumentID % 7 = 0")
def validate_document_problems(t):
    """Integrity of documents: utterances name a medium that isn't there; every seventh document numbers a participant twice."""
    twice = F.when(F.col("DocumentID") % 7 == 0, F.replace("xml", F.lit("</PARTICIPANTS>"), F.lit('<PARTICIPANT ID="1" NAME="again"/></PARTICIPANTS>'))).otherwise(F.col("xml"))
    return X.problems(X.shred(X.parse(documents(t).withColumn("xml", twice))[0]))


@query("SELECT DISTINCT conv_id AS DocumentID FROM conversations WHERE regexp_matches(text, '[A-Za-z]')")
def xml_warn_only(t):
    """Every fifth document loses its end; with warnings only, all documents stay."""
    cut = F.when(F.col("DocumentID") % 5 == 0, F.expr("substring(xml, 1, length(xml) - 30)")).otherwise(F.col("xml"))
    return X.parse(documents(t).withColumn("xml", cut), on_error="warn")[0].select("DocumentID")


@query(f"SELECT DISTINCT DocumentID, 'left' AS side FROM {_TOKENS} WHERE DocumentID % 4 = 0 UNION ALL SELECT DISTINCT DocumentID, 'right' FROM {_TOKENS} WHERE DocumentID % 4 = 0")
def compare_documents(t):
    """Documents that differ from a copy in which every fourth calls a participant otherwise."""
    other = F.when(F.col("DocumentID") % 4 == 0, F.replace("xml", F.lit('NAME="user"'), F.lit('NAME="USER"'))).otherwise(F.col("xml"))
    made = documents(t)
    a, b = (X.shred(X.parse(df)[0]).participant for df in (made, made.withColumn("xml", other)))
    return differences(a, b).select("DocumentID", "side").distinct()


#: What is planted by the document's number, and the line (of one tag each, blank lines ahead) and column where it is seen.
_LINES = f"(SELECT DocumentID, DocumentID % 13 AS ahead, (SELECT count(*) FROM {_TOKENS} x WHERE x.DocumentID = d.DocumentID AND x.i >= 0) AS tokens, count(DISTINCT uid) AS utterances FROM {_TOKENS} d GROUP BY DocumentID)"


@query(f"""SELECT DocumentID, cause, element, CAST(line + ahead AS INTEGER) AS line, CAST(col AS INTEGER) AS col FROM {_LINES} JOIN (VALUES
    (1, 'duplicate participant', 'PARTICIPANT', 5, 0), (2, 'unexpected element', 'STRANGE', 5, 0), (3, 'wrong nesting', 'FIELD', 9, 0), (4, 'duplicate field', 'FIELD', 10, 0)) p(kind, cause, element, line, col) ON DocumentID % 6 = kind
  UNION ALL SELECT DocumentID, 'unclosed element', 'SIGNSTREAM-DATABASE', CAST(19 + ahead + 9 * utterances + tokens AS INTEGER), 13 FROM {_LINES} WHERE DocumentID % 6 = 5""")
def xml_error_positions(t):
    """Where documents of one tag a line break the rules: five kinds of violation, by the document's number."""
    i, x = F.col("DocumentID"), F.regexp_replace(F.replace("xml", F.lit('<MEDIA-REF ID="2"/>'), F.lit('<MEDIA-REF ID="1"/>')), "><", ">\n<")
    put = lambda old, new: F.replace(x, F.lit(old), F.lit(new))
    made = F.when(i % 6 == 1, put("</PARTICIPANTS>", '<PARTICIPANT ID="1" NAME="again"/>\n</PARTICIPANTS>')).when(i % 6 == 2, put("</PARTICIPANTS>", "<STRANGE/>\n</PARTICIPANTS>"))
    made = made.when(i % 6 == 3, put('<VALUE ID="7" NAME="HOLD"/>\n</FIELD>', '<VALUE ID="7" NAME="HOLD">\n</FIELD>')).when(i % 6 == 4, put('<FIELD ID="2"', '<FIELD ID="1"')).when(i % 6 == 5, F.expr("substring(x, 1, length(x) - 23)")).otherwise(F.col("x"))
    docs = documents(t).withColumn("x", x).withColumn("xml", F.concat(F.repeat(F.lit("\n"), (i % 13).cast("int")), made))
    return errors(docs).withColumnRenamed("column", "col")


@query(f"""WITH t AS (SELECT DocumentID, count(*) FILTER (WHERE i % 6 = 0) AS held, count(DISTINCT uid) FILTER (WHERE uid % 3 = 1) AS side FROM {_TOKENS} GROUP BY 1)
  SELECT DocumentID, part, unnest(['left', 'right']) AS side, n AS n_rows FROM (
    SELECT DocumentID, 'participant' AS part, 1 AS n FROM t WHERE DocumentID % 5 = 1 UNION ALL SELECT DocumentID, 'field', 1 FROM t WHERE DocumentID % 5 = 2
    UNION ALL SELECT DocumentID, 'field_value', 2 FROM t WHERE DocumentID % 5 = 3 UNION ALL SELECT DocumentID, 'token', held FROM t WHERE DocumentID % 5 = 3
    UNION ALL SELECT DocumentID, 'media', 1 FROM t WHERE DocumentID % 5 = 4 UNION ALL SELECT DocumentID, 'utterance_media', side FROM t WHERE DocumentID % 5 = 4 AND side > 0)""")
def compare_whole_documents(t):
    """Documents against copies that differ in one thing or none, by the document's number: rows that differ, by table and side."""
    i, x = F.col("DocumentID"), F.col("xml")
    put = lambda old, new: F.replace(x, F.lit(old), F.lit(new))
    other = F.when(i % 5 == 1, put('AGE="42 years"', 'AGE="43 years"')).when(i % 5 == 2, put('LABEL="english"', 'LABEL="german"')).when(i % 5 == 3, put('NAME="HOLD"', 'NAME="REST"'))
    other = other.when(i % 5 == 4, F.replace(put('MEDIA-FILE ID="1"', 'MEDIA-FILE ID="4"'), F.lit('MEDIA-REF ID="1"'), F.lit('MEDIA-REF ID="4"'))).otherwise(x)
    made = stored(documents(t), "documents")
    a, b = (vars(X.shred(X.parse(df)[0])) for df in (made, made.withColumn("xml", other)))
    return document_differences(a, b, "DocumentID").groupBy("DocumentID", F.col("table").alias("part"), "side").agg(F.count("*").alias("n_rows"))


@query(f"""WITH t AS (SELECT DISTINCT DocumentID, uid, pid, fid FROM {_TOKENS})
  SELECT DISTINCT DocumentID, 'unknown media' AS problem, '2' AS id FROM t WHERE uid % 3 = 2
  UNION ALL SELECT DISTINCT DocumentID, problem, id FROM t JOIN (VALUES (1, 'duplicate participant', '1'), (2, 'duplicate field', '2'), (3, 'duplicate field value', '2/7'), (4, 'duplicate media', '1')) p(kind, problem, id) ON DocumentID % 8 = kind
  UNION ALL SELECT DISTINCT DocumentID, 'duplicate utterance', '0/' || uid FROM t WHERE DocumentID % 8 = 5 AND pid = 0
  UNION ALL SELECT DISTINCT DocumentID, 'unknown field', '2' FROM t WHERE DocumentID % 8 = 6 AND fid = 2
  UNION ALL SELECT DISTINCT DocumentID, 'unknown participant', '0' FROM t WHERE DocumentID % 8 = 7 AND pid = 0""")
def validate_all_problems(t):
    """All eight kinds of broken integrity, by the document's number; every document with an utterance of its third kind of medium names an unknown one."""
    x = F.col("xml")
    put = [
        ("</PARTICIPANTS>", '<PARTICIPANT ID="1" NAME="again"/></PARTICIPANTS>'), ("</CODING-SCHEME>", '<FIELD ID="2" NAME="again"/></CODING-SCHEME>'), ('LABEL="english">', 'LABEL="english"><VALUE ID="7" NAME="HOLD"/>'),
        ("</MEDIA-FILES>", '<MEDIA-FILE ID="1" LEGACY-PATH="x:y"/></MEDIA-FILES>'), ('PARTICIPANT-ID="0">', 'PARTICIPANT-ID="0"></SEGMENT><SEGMENT PARTICIPANT-ID="0">'), ('FIELD ID="2"', 'FIELD ID="3"'), ('PARTICIPANT ID="0"', 'PARTICIPANT ID="5"'),
    ]
    for kind, (old, new) in enumerate(put, 1):
        x = F.when(F.col("DocumentID") % 8 == kind, F.replace("xml", F.lit(old), F.lit(new))).otherwise(x)
    return X.problems(X.shred(X.parse(documents(t).withColumn("xml", x))[0]))
