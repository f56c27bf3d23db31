"""Annotation documents: nested XML into flat tables, and questions to these tables.

Attributes are parsed by Spark's XML functions with a fixed schema.  Utterances count under the root and under
UTTERANCES.  Token times are relative to their utterance and become absolute.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import format_interval, last_part
from millrace.operators.aggregates import ordered_list
from millrace.operators.joins import overlap_join
from millrace.operators.shared import stored
from millrace.operators.validate import dangling, duplicate_ids

UTTERANCE = "array<struct<_ID: int, _S: int, _E: int, `MEDIA-REF`: array<struct<_ID: int>>, SEGMENT: array<struct<`_PARTICIPANT-ID`: int, TRACK: array<struct<_FID: int, A: array<struct<_VALUE: string, _S: int, _E: int, _VID: int>>>>>>>>"
SCHEMA = f"""
`PARTICIPANTS` struct<PARTICIPANT: array<struct<_ID: int, _NAME: string, _LABEL: string, _AGE: string, _GENDER: string, _LANGUAGE: string>>>,
`CODING-SCHEME` struct<FIELD: array<struct<_ID: int, _NAME: string, _LABEL: string, _CONSTRAINT: string, VALUE: array<struct<_ID: int, _NAME: string, _LABEL: string>>>>>,
`MEDIA-FILES` struct<`MEDIA-FILE`: array<struct<_ID: int, `_LEGACY-PATH`: string>>>,
`UTTERANCES` struct<UTTERANCE: {UTTERANCE}>, `UTTERANCE` {UTTERANCE}, _corrupt string
"""


def parse(docs: DataFrame, key: str = "DocumentID", xml: str = "xml", on_error: str = "reject") -> tuple[DataFrame, DataFrame]:
    """``(parsed, rejects)``: documents that aren't well-formed or don't fit the schema are rejects, with their text.

    With ``on_error="warn"`` what could be read of them is among the parsed, too; ``"fail"`` raises.  Parsing costs more than
    its input's size tells, so documents are dealt out to all tasks, and parsed once for all tables made of them.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    dealt = docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    bad = F.col("d").isNull() | F.col("d._corrupt").isNotNull()
    out = dealt.select(F.col(key).alias(key), F.col(xml).alias("_xml"), F.from_xml(F.col(xml), SCHEMA.replace("\n", " "), options).alias("d")).withColumn("_bad", bad)
    if on_error == "fail":
        out = out.withColumn("_bad", F.when(F.col("_bad"), F.raise_error(F.concat(F.lit("bad document "), F.col(key).cast("string"))).cast("boolean")).otherwise(F.lit(False)))
    out = stored(out.select(key, F.when(F.col("_bad"), F.col("_xml")).alias("_xml"), "d", "_bad"), "parsed")
    return out.filter("NOT _bad" if on_error != "warn" else "d IS NOT NULL").select(key, "d"), out.filter("_bad").select(key, F.col("_xml").alias("xml"))


@dataclass(frozen=True)
class Tables:
    participant: DataFrame
    field: DataFrame
    field_value: DataFrame
    media: DataFrame
    utterance: DataFrame
    utterance_media: DataFrame
    token: DataFrame


def shred(parsed: DataFrame, key: str = "DocumentID") -> Tables:
    """The flat tables of parsed documents, all keyed by document."""
    path = lambda *p: F.col(".".join(["d", *(f"`{x}`" for x in p)]))
    part = parsed.select(key, F.inline(path("PARTICIPANTS", "PARTICIPANT")))
    part = part.select(key, F.col("_ID").alias("pid"), F.col("_NAME").alias("name"), F.col("_LABEL").alias("label"), F.col("_AGE").alias("age"), F.col("_GENDER").alias("gender"), F.col("_LANGUAGE").alias("language"))
    fields = parsed.select(key, F.inline(path("CODING-SCHEME", "FIELD")))
    field = fields.select(key, F.col("_ID").alias("fid"), F.col("_NAME").alias("name"), F.coalesce("_LABEL", "_NAME").alias("label"), F.col("_CONSTRAINT").alias("constraint"))
    value = fields.select(key, F.col("_ID").alias("fid"), F.inline("VALUE")).select(key, "fid", F.col("_ID").alias("vid"), F.col("_NAME").alias("name"), F.coalesce("_LABEL", "_NAME").alias("label"))
    media = parsed.select(key, F.inline(path("MEDIA-FILES", "MEDIA-FILE"))).select(key, F.col("_ID").alias("mid"), F.col("_LEGACY-PATH").alias("path"), last_part(F.col("_LEGACY-PATH"), ":").alias("filename"))

    both = F.concat(F.coalesce(path("UTTERANCES", "UTTERANCE"), F.array().cast(UTTERANCE)), F.coalesce(path("UTTERANCE"), F.array().cast(UTTERANCE)))
    utt = parsed.select(key, F.explode(both).alias("u"))
    seg = utt.select(key, "u", F.explode("u.SEGMENT").alias("s"))
    of = [F.col(key), F.col("s.`_PARTICIPANT-ID`").alias("pid"), F.col("u._ID").alias("uid")]
    utterance = seg.select(*of, F.col("u._S").alias("start_ms"), F.col("u._E").alias("end_ms"))
    um = seg.select(*of, F.posexplode("u.`MEDIA-REF`").alias("pos", "m")).select(key, "pid", "uid", "pos", F.col("m._ID").alias("mid"))
    values = F.expr("flatten(transform(d.`CODING-SCHEME`.FIELD, f -> transform(coalesce(f.VALUE, array()), v -> struct(f._ID AS fid, v._ID AS vid, v._NAME AS name))))")
    track = parsed.select(key, values.alias("values"), F.explode(both).alias("u")).select(key, "values", "u", F.explode("u.SEGMENT").alias("s"))
    track = track.select(*of, F.col("u._S").alias("at"), "values", F.explode("s.TRACK").alias("t"))
    named = F.expr("transform(t.A, a -> struct(a._S AS s, a._E AS e, a._VID AS vid, coalesce(get(filter(values, v -> v.fid = t._FID AND v.vid = a._VID), 0).name, a._VALUE) AS text))")
    token = track.select(key, "pid", "uid", "at", F.col("t._FID").alias("fid"), F.posexplode(named).alias("pos", "a"))
    token = token.select("*", (F.col("at") + F.col("a.s")).alias("start_ms"), (F.col("at") + F.col("a.e")).alias("end_ms"), "a.vid", "a.text")
    token = token.select(key, "pid", "uid", "fid", "pos", "start_ms", "end_ms", "vid", "text")
    return Tables(part, field, value, media, utterance, um, token)


def problems(t: Tables, key: str = "DocumentID") -> DataFrame:
    """``(document, problem, id)`` of duplicate ids and unknown references in shredded documents."""
    dup = lambda df, cols, what: duplicate_ids(df, cols).select(key, F.lit(what).alias("problem"), F.concat_ws("/", *cols[1:]).alias("id"))
    out = dup(t.participant, [key, "pid"], "duplicate participant")
    for df, cols, what in ((t.field, [key, "fid"], "duplicate field"), (t.field_value, [key, "fid", "vid"], "duplicate field value"), (t.media, [key, "mid"], "duplicate media"), (t.utterance, [key, "pid", "uid"], "duplicate utterance")):
        out = out.unionByName(dup(df, cols, what))
    for df, ref, col, what in ((t.utterance_media, t.media, "mid", "unknown media"), (t.token, t.field, "fid", "unknown field"), (t.utterance, t.participant, "pid", "unknown participant")):
        lost = dangling(df.select(key, col).distinct(), ref, [key, col])
        out = out.unionByName(lost.select(key, F.lit(what).alias("problem"), F.col(col).cast("string").alias("id")))
    return out


def by_id_or_label(df: DataFrame, id_col: str, wanted: int | str) -> DataFrame:
    return df.filter(F.col(id_col) == wanted if isinstance(wanted, int) else F.col("label") == wanted)


def token_lists(token: DataFrame, key: str = "DocumentID") -> DataFrame:
    """Texts of each utterance and field in order."""
    return token.groupBy(key, "pid", "uid", "fid").agg(ordered_list("pos", "text").alias("texts"))


def last_tier(token: DataFrame, key: str = "DocumentID") -> DataFrame:
    """The text of each utterance's tier with the largest field id: its translation."""
    lists = token_lists(token, key)
    return lists.groupBy(key, "pid", "uid").agg(F.array_join(F.max_by("texts", "fid"), " ").alias("translation"))


def tokens_of_field(token: DataFrame, utterance: DataFrame, fid: int, keep_missing: bool = False, key: str = "DocumentID") -> DataFrame:
    """Tokens of one field; with ``keep_missing``, utterances without it have a row of nulls."""
    own = token.filter(F.col("fid") == fid)
    return utterance.select(key, "pid", "uid").join(own, [key, "pid", "uid"], "left" if keep_missing else "inner")


def with_coinciding(token: DataFrame, fid: int, other: int, bucket: int = 10_000, mode: str = "reference", key: str = "DocumentID") -> DataFrame:
    """Tokens of field ``fid`` with those of field ``other`` that coincide, as ``text (start-end), ...``."""
    cols = [key, "pid", "uid"]
    a = token.filter(F.col("fid") == fid).select(*cols, "pos", "start_ms", "end_ms", "text")
    b = token.filter(F.col("fid") == other).select(*cols, F.col("pos").alias("p2"), F.col("start_ms").alias("s2"), F.col("end_ms").alias("e2"), F.col("text").alias("t2"))
    hit = overlap_join(a, b, cols, ("start_ms", "end_ms"), ("s2", "e2"), bucket, mode)
    shown = hit.groupBy(*cols, "pos").agg(F.array_join(ordered_list("p2", format_interval(F.col("t2"), F.col("s2"), F.col("e2"))), ", ").alias("coinciding"))
    return a.join(shown, [*cols, "pos"], "left").withColumn("coinciding", F.coalesce("coinciding", F.lit("")))


def standard(token: DataFrame) -> Column:
    """Whether a token has a controlled value."""
    return F.col("vid").isNotNull()
