"""Composite tables: from parsed documents to training sets.  Each builder takes and returns DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import aggregates as A
from millrace.operators import joins as J
from millrace.operators import keys as K
from millrace.operators import split as S


def numbered(docs: DataFrame, filename: str, text: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """``(DocumentID, Filename, xml)``: documents numbered by file name.

    Where file names repeat, documents of one name are numbered in the order of the columns ``ties``.  Nulls come last.
    """
    named = docs.select(F.col(filename).alias("Filename"), F.col(text).alias("xml"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(ties)])
    d = K.dense_id(named, [F.asc_nulls_last(c) for c in ("Filename", *(f"_tie{i}" for i in range(len(ties))))], "DocumentID")
    return d.select("DocumentID", "Filename", "xml")


def in_base64(docs: DataFrame) -> DataFrame:
    """``(DocumentID, Filename, XML_B64, LEN)`` of numbered documents: texts in base64 with their length."""
    return docs.select("DocumentID", "Filename", C.encode_base64(F.col("xml")).alias("XML_B64")).withColumn("LEN", F.length("XML_B64"))


def corpus_index(docs: DataFrame, filename: str, text: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """``(DocumentID, Filename, XML_B64, LEN)``, see ``numbered``."""
    return in_base64(numbered(docs, filename, text, ties))


def consultants(people: DataFrame, name: str, age: str, gender: str) -> DataFrame:
    """One row per name with a dense id, its largest age and first gender."""
    one = A.reconcile(people, [name], age, gender)
    return K.dense_id(one.select(F.col(name).alias("Name"), F.col("age").alias("Age"), F.coalesce("gender", F.lit("")).alias("Gender")), ["Name"], "ASLConsultantID")


def mapping(pairs: DataFrame, docs: DataFrame, people: DataFrame, doc_key: str, person_key: str) -> DataFrame:
    """Distinct (document, person) pairs with both ids."""
    return J.lookup(J.lookup(pairs.select(doc_key, person_key).distinct(), docs, [doc_key]), people, [person_key])


def vocabulary(tokens: DataFrame, text: str = "text") -> DataFrame:
    """``(TokenID, Token)`` in the order of the token."""
    return K.distinct_ids(tokens.select(F.col(text).alias("Token")), ["Token"], "TokenID").select("TokenID", "Token")


def numbered_tokens(tokens: DataFrame, vocab: DataFrame, text: str = "text") -> DataFrame:
    """Tokens with their id."""
    return tokens.join(vocab.withColumnRenamed("Token", text), text)


def segments(index: DataFrame, video: str, urls: str) -> DataFrame:
    """A row per segment URL of each video, numbered from 0."""
    parts = index.select(video, F.posexplode(F.split(F.trim(F.col(urls)), ";")).alias("SegmentSequence", "URL"))
    return parts.withColumn("SegmentVideoFilename", C.last_part(F.col("URL"), "/"))


def _stem(name: Column) -> Column:
    """A file's name without its extension and without percent-encoding."""
    bare = F.regexp_replace(name, r"\.[^./]*$", "")
    return F.coalesce(F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B"))), bare)


def with_stem(videos: DataFrame) -> DataFrame:
    return videos.withColumn("_stem", _stem(F.col("TargetVideoFilename")))


def shots(frames: DataFrame) -> DataFrame:
    """The listing ``frames(video, frame, frame_path)`` by ``_stem``, the name that videos are found under."""
    return frames.select(F.coalesce(F.try_url_decode(F.replace("video", F.lit("+"), F.lit("%2B"))), "video").alias("_stem"), F.col("frame").alias("FrameSequence"), F.col("frame_path").alias("FramePath"))


def frames_of_videos(videos: DataFrame, frames: DataFrame) -> DataFrame:
    """``videos`` with ``FrameSequence`` and ``FramePath`` of the frames listed under their name: any extension, dots in the name, quoted or not."""
    return with_stem(videos).join(shots(frames), "_stem").drop("_stem")


def token_frames(tokens: DataFrame, videos: DataFrame, frames: DataFrame, utterance: list[str], video: list[str], most_videos: int = 4, fps: float = 30.0, by: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frames of every token in every video of its utterance: ``(found, expected but absent, utterances with too many videos)``.

    ``frames`` are those that exist, ``FrameSequence`` by any columns of ``videos``, ``by`` (``video`` where not given).
    """
    n = videos.select(*utterance, *video).distinct().groupBy(*utterance).agg(F.count("*").alias("n_videos"))
    fit = videos.join(n.filter(F.col("n_videos") <= most_videos).select(*utterance), utterance, "left_semi")
    want = J.frames_of_intervals(tokens.join(fit, utterance), "StartTime", "EndTime", fps, "FrameSequence")
    found, missing, _ = J.existence(want, frames, [*(by or video), "FrameSequence"])
    return found, missing, n.filter(F.col("n_videos") > most_videos)


def split_frames(frames: DataFrame, strata: list[str], key: str, ratio: float = 0.1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(train_assoc, val, train)``: rows of strata with several keys, split by key; ``train`` also has the strata with one."""
    keys = frames.select(*strata, key).distinct()
    many = S.stratified_split(A.of_group_size(keys, strata, at_least=2), strata, key, ratio)
    one = A.of_group_size(keys, strata, at_most=1)
    on = [*strata, key]
    assoc = J.having(frames, many.filter("split = 'train'"), on)
    return assoc, J.having(frames, many.filter("split = 'val'"), on), assoc.unionByName(J.having(frames, one, on))


def complete_groups(part: DataFrame, whole: DataFrame, group: list[str], member: list[str]) -> DataFrame:
    """Groups of ``whole`` all of whose members occur in ``part``."""
    have = part.select(*group, *member).distinct().withColumn("_hit", F.lit(True))
    return J.all_in_set(whole.select(*group, *member).distinct().join(have, [*group, *member], "left"), group, F.col("_hit"))
