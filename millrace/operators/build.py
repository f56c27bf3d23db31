"""The whole job: annotation documents, the video index and the frame listing into the corpus tables, then into training sets.

All tables have the columns of ``sources/schemas.py``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import url_quote
from millrace.operators import corpus as B
from millrace.operators import joins as J
from millrace.operators import keys as K
from millrace.operators.aggregates import ordered_list
from millrace.operators.jobs import Stage, run_job
from millrace.operators.rules import Key, Quarantine, Row
from millrace.operators.shared import stored
from millrace.sources import annotations as X
from millrace.sources import schemas
from millrace.sources.positions import first_error

PERSON = ["DocumentID", "ASLConsultantID"]


def _typed(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.schema(name)]) for name, df in tables.items()}


#: Severities that are milder than their rules: a document may name media that it lacks, and a dialogue has two consultants.
MILD = {"known media": "warn", "one consultant per video": "warn"}
#: As strict as a job that stops at the first fatal rule.
STRICT = {name: "fail" for name in (
    "document breaks no rule", "document parses", "one document per file name", "participant has a name", "one consultant per participant", "numbers aren't negative", "token has a text", "one id per token",
    "one camera per video", "one segment list per video", "video has a camera", "video has a name", "video is in the index", "one consultant per video",
)}


def _read(texts: DataFrame, aside: Quarantine) -> X.Tables:
    """The flat tables of the documents that break no rule of their format; the others are put aside with line, column, element and cause."""
    mild = aside.severity.get("known media", "reject") == "warn"
    seen = stored(texts.select("DocumentID", "Filename", "xml", first_error(F.col("xml"), ("unknown media",) if mild else ()).alias("error")), "documents")
    aside.put(seen.filter("error IS NOT NULL").select("DocumentID", "Filename", "error.*"), "document", "document breaks no rule", ["DocumentID"])
    parsed, rejects = X.parse(seen.filter("error IS NULL").select("DocumentID", "xml"))
    aside.put(rejects.select("DocumentID"), "document", "document parses", ["DocumentID"])
    d = X.shred(parsed)
    if mild:
        aside.put(J.lacking(d.utterance_media, d.media, ["DocumentID", "mid"]), "utterance_media", "known media", ["DocumentID", "pid", "uid", "mid"])
    return d


def build_corpus(docs: DataFrame, video_index: DataFrame, frames: DataFrame, gloss: str = "main gloss", fps: float = 30.0, most_videos: int = 4, severity: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The thirteen corpus tables from ``docs(Filename, xml)``, ``video_index`` and ``frames(video, frame, frame_path)``, and ``quarantine``.

    Utterances are numbered by id within document and participant; ``Tokens`` and ``utterance_token`` hold the tokens of the
    field ``gloss``, ``Translation`` those of the last tier.  Videos are the media of utterances that the index lists, by
    quoted file name; frames are listed under the video's name without its extension, quoted or not.

    Tables hold valid rows only.  ``quarantine`` has what was left out, with table, key, rule, severity and row: documents
    that break their format (with line and column) or don't parse, file names with several documents (the first by text
    stays), participants without a name, tokens without a text, negative numbers, videos under several cameras or segment lists, media that the
    index lacks, utterances in more than ``most_videos`` videos, and tokens' frames that aren't there (counted by token
    and video).  Warnings: videos in several documents, of several participants or consultants, unknown media.  ``severity`` changes a
    rule's: ``fail`` raises ``BrokenRules``, ``reject`` leaves the rows out, ``warn`` only lists them; ``STRICT`` is a set of such changes.
    """
    aside = Quarantine(MILD | (severity or {}))
    # Written once: the sort samples its rows before it moves them, and the quarantine reads them again.
    several = docs.groupBy("Filename").agg(F.count("*").alias("n_documents"), F.min(F.struct("xml")).alias("x"))
    several = stored(several.select("Filename", "n_documents", "x.xml"), "texts")
    aside.put(several.filter("n_documents > 1").select("Filename", "n_documents"), "corpus", "one document per file name", ["Filename"])
    texts = B.numbered(several, "Filename", "xml")
    corpus, named = B.in_base64(texts), texts.select("DocumentID", "Filename")
    d = _read(texts, aside)
    people = aside.check(d.participant, "participant", ["DocumentID", "pid"], [Row("participant has a name", F.trim("name") != "")])
    consultant = stored(B.consultants(people, "name", "age", "gender"), "consultant")
    ids = people.select("DocumentID", "pid", F.col("name").alias("ParticipantName")).join(consultant.select(F.col("Name").alias("ParticipantName"), "ASLConsultantID"), "ParticipantName")
    ids = aside.check(ids, "document_consultant", ["DocumentID", "ParticipantName"], [Key("one consultant per participant", ("DocumentID", "ParticipantName"), ("ASLConsultantID",))])
    document_consultant = J.lookup(ids.select(*PERSON, "ParticipantName").distinct(), named, ["DocumentID"])

    placed = J.lookup(d.utterance, ids.select("DocumentID", "pid", "ASLConsultantID"), ["DocumentID", "pid"])
    placed = K.position(placed, PERSON, ["uid"], "UtteranceSequence")
    placed = aside.check(placed, "utterance", [*PERSON, "uid"], [Row("numbers aren't negative", (F.col("uid") >= 0) & (F.col("start_ms") >= 0) & (F.col("end_ms") >= 0))])
    at = placed.select("DocumentID", "pid", "uid", "ASLConsultantID", "UtteranceSequence")
    token = d.token.join(d.field.select("DocumentID", "fid", F.col("name").alias("Field")), ["DocumentID", "fid"]).filter(F.col("Field") == gloss)
    token = token.join(at, ["DocumentID", "pid", "uid"])
    token = aside.check(token, "utterance_token", [*PERSON, "UtteranceSequence", "pos"], [Row("token has a text", F.col("text") != ""), Row("numbers aren't negative", (F.col("start_ms") >= 0) & (F.col("end_ms") >= 0))])
    said = token.groupBy(*PERSON, "UtteranceSequence").agg(F.array_join(ordered_list("pos", "text"), " ").alias("Tokens"))
    meant = X.last_tier(d.token).join(at, ["DocumentID", "pid", "uid"]).select(*PERSON, "UtteranceSequence", F.col("translation").alias("Translation"))
    utterance = placed.select(*PERSON, "UtteranceSequence", F.col("start_ms").alias("StartTime"), F.col("end_ms").alias("EndTime"))
    utterance = utterance.join(said, [*PERSON, "UtteranceSequence"], "left").join(meant, [*PERSON, "UtteranceSequence"], "left")
    vocabulary = aside.check(B.vocabulary(token), "vocabulary", ["Token"], [Key("one id per token", ("Token",), ("TokenID",))])
    token = B.numbered_tokens(token, vocabulary)
    utterance_token = token.select(*PERSON, "UtteranceSequence", F.col("pos").alias("TokenSequence"), F.col("start_ms").alias("StartTime"), F.col("end_ms").alias("EndTime"), "TokenID", "Field", F.col("text").alias("FieldValue"))

    name = ("target_video_filename",)
    video_index = aside.check(video_index.distinct(), "video_index", name, [
        Row("video has a name", F.trim(name[0]) != ""), Row("video has a camera", F.col("perspective_cam_id") >= 0),
        Key("one camera per video", name, ("perspective_cam_id",)), Key("one segment list per video", name, ("compressed_mov_url",)),
    ])
    index = video_index.select(F.col(name[0]).alias("TargetVideoFilename"), F.col("perspective_cam_id").alias("CameraPerspective"), F.col("compressed_mov_url").alias("urls")).distinct()
    media = d.utterance_media.join(d.media.select("DocumentID", "mid", url_quote(F.col("filename")).alias("TargetVideoFilename")), ["DocumentID", "mid"])
    media = stored(media.join(at, ["DocumentID", "pid", "uid"]).select(*PERSON, "UtteranceSequence", "TargetVideoFilename").distinct(), "media")
    aside.put(J.lacking(media, index, ["TargetVideoFilename"]), "utterance_video", "video is in the index", [*PERSON, "UtteranceSequence", "TargetVideoFilename"])
    seen = aside.check(media.join(index, "TargetVideoFilename"), "utterance_video", [*PERSON, "UtteranceSequence", "TargetVideoFilename"], [
        Key("one document per video", ("TargetVideoFilename",), ("DocumentID",), "warn"), Key("one consultant per video", ("TargetVideoFilename",), ("ASLConsultantID",)),
    ])
    video = seen.select(*PERSON, "CameraPerspective", "TargetVideoFilename", "urls").distinct()
    video_frame = B.frames_of_videos(video.drop("urls"), frames)
    wanted = utterance_token.select(*PERSON, "UtteranceSequence", "TokenSequence", "StartTime", "EndTime", "TokenID")
    on = [*PERSON, "CameraPerspective", "TargetVideoFilename"]
    # Tokens' frames are looked up in the listing itself: the frames of all videos are many times as many.
    found, missing, full = B.token_frames(wanted, B.with_stem(seen.drop("urls")), B.shots(frames), [*PERSON, "UtteranceSequence"], on, most_videos, fps, ["_stem"])
    lost = missing.groupBy(*on, "UtteranceSequence", "TokenSequence").agg(F.count("*").alias("n_missing"), F.min("FrameSequence").alias("first"), F.max("FrameSequence").alias("last"))
    aside.put(lost, "utterance_token_frame", "frame is there", [*on, "UtteranceSequence", "TokenSequence"])
    aside.put(full, "utterance_video", "not in too many videos", [*PERSON, "UtteranceSequence"])
    return _typed({
        "video_index": video_index, "corpus": corpus, "consultant": consultant, "document_consultant": document_consultant, "utterance": utterance,
        "video": video, "video_utterance": seen, "utterance_video": seen, "video_segment": B.segments(video.withColumn("v", F.struct(*video.columns)), "v", "urls").select("v.*", "SegmentSequence", "SegmentVideoFilename", "URL"),
        "video_frame": video_frame, "vocabulary": vocabulary, "utterance_token": utterance_token, "utterance_token_frame": found,
    }) | {"quarantine": aside.table(docs)}


def complete_utterances(part: DataFrame, frames: DataFrame, utterance: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(complete, failed)``: utterances in a video all of whose tokens occur in ``part``, with the ids and texts of their tokens.

    Failed are those whose texts, looked up by id, aren't the utterance's.
    """
    key = ["ASLConsultantID", "TargetVideoFilename", "UtteranceSequence", "CameraPerspective"]
    whole = B.complete_groups(part, frames, key, ["TokenSequence"])
    tokens = frames.select("DocumentID", *key, "TokenSequence", "TokenID").distinct().join(whole, key)
    tokens = J.lookup(tokens, vocabulary, ["TokenID"]).groupBy("DocumentID", *key)
    listed = lambda c: F.array_join(ordered_list("TokenSequence", c), " ")
    tokens = tokens.agg(listed(F.col("TokenID").cast("string")).alias("TokenIDs"), listed("Token").alias("resolved"))
    both = tokens.join(utterance, ["DocumentID", "ASLConsultantID", "UtteranceSequence"])
    same = F.col("resolved").eqNullSafe(F.col("Tokens"))
    out = [*key, "StartTime", "EndTime", "TokenIDs", "Tokens", "Translation"]
    return both.filter(same).select(*out), both.filter(~same).select(*out, "resolved")


def build_splits(tables: dict[str, DataFrame], severity: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The six training tables: frames of tokens split by token and camera, and the utterances complete in each part; and ``quarantine``.

    Utterances whose tokens, looked up by id, don't give their text are put aside.
    """
    aside = Quarantine(severity or {})
    frames = stored(tables["utterance_token_frame"], "frames")
    key = F.concat_ws("/", "ASLConsultantID", "TargetVideoFilename", "UtteranceSequence", "TokenSequence")
    parts = dict(zip(("train_assoc", "val", "train"), B.split_frames(frames.withColumn("occurrence", key), ["TokenID", "CameraPerspective"], "occurrence")))
    parts = {name: stored(df, name) for name, df in parts.items()}
    done = {}
    for name, df in parts.items():
        done[f"complete_utterances_{name}"], failed = complete_utterances(df, frames, tables["utterance"], tables["vocabulary"])
        aside.put(failed, f"complete_utterances_{name}", "tokens give the text", ["ASLConsultantID", "TargetVideoFilename", "UtteranceSequence", "CameraPerspective"])
    return _typed(parts | done) | {"quarantine": aside.table(frames)}


#: Tables of the two stages of a job, each with what it leaves out.
CORPUS = ("video_index", "corpus", "consultant", "document_consultant", "utterance", "video", "video_utterance", "utterance_video", "video_segment", "video_frame", "vocabulary", "utterance_token", "utterance_token_frame", "quarantine")
SPLITS = ("train_assoc", "val", "train", "complete_utterances_train_assoc", "complete_utterances_val", "complete_utterances_train", "quarantine_splits")


def corpus_job(spark: SparkSession, folder: str, sources: dict[str, str], read: Callable[[dict[str, str]], tuple[DataFrame, DataFrame, DataFrame]], **how) -> dict:
    """The whole job into a folder, nineteen tables and two of what was left out; see ``run_job``.

    ``read`` gets the paths ``sources`` and returns documents, video index and frames; ``how`` goes to ``build_corpus``.
    """

    def splits(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        made = build_splits(tables, how.get("severity"))
        return {**made, "quarantine_splits": made["quarantine"]}

    stages = [Stage("corpus", CORPUS, lambda _: build_corpus(*read(sources), **how)), Stage("splits", SPLITS, splits)]
    return run_job(spark, folder, sources, stages, {name: schemas.key(name) for name in schemas.TABLES}, json.dumps(how, sort_keys=True))
