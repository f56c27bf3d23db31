"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Both models are bags of hashed words and word pairs, with add-one smoothing; a text's log ratio is the sum over its n-grams
of the log ratio of the target model to the raw model.  That sum grows with the length of a text and counts n-grams as
independent, so its mean is calibrated on labels into a probability ratio, the importance weight.  Adding Gumbel noise,
keyed by id, to the log weights and keeping the k largest draws k texts without replacement in proportion to their weights.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import cut, ship
from millrace.llm.subword import Cached

TOKEN = re.compile(r"\w+|[^\w\s]+")
BUCKETS = 1 << 16
#: Labelled documents that train the target model and set the share, at most (chosen by a hash of their ids).
LABELLED = 20_000
BINS = 4096

_words: dict = {}


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the lower-case words and marks of a text and of their neighbouring pairs; and the words' buckets by other bits
    of their hashes, from BUCKETS on, which tell words apart that share the first."""
    if "cache" not in _words:
        _words["cache"] = Cached(lambda w: xxhash.xxh64_intdigest(w.encode("utf-8", "replace"), 3), 40_000)
    tokens = TOKEN.findall(text.lower()) if text else []
    h = np.fromiter(map(_words["cache"].__getitem__, tokens), np.uint64, len(tokens))
    pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    pair = (pair ^ (pair >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    grams = np.concatenate([h, pair >> np.uint64(16)]) % np.uint64(BUCKETS)
    return grams.astype(np.int64), ((h >> np.uint64(24)) % np.uint64(BUCKETS)).astype(np.int64) + BUCKETS


def half(which: int) -> Column:
    """Labelled documents are dealt to two halves: 0 trains the target model, 1 sets the threshold on texts it hasn't seen."""
    return F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == which


def labelled(labels: DataFrame) -> dict[int, tuple[bool, bool]]:
    """Up to LABELLED labelled ids of the first half: whether good, that is of quality 1 and not toxic, and whether toxic; an
    id with several labels needs all good, and one toxic."""
    labels = labels.filter(half(0))
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1), F.lit(False))
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    rows = labels.filter("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy("doc_id").agg(F.min(good).alias("good"), F.max(toxic).alias("toxic"))
    return {r["doc_id"]: (r["good"], r["toxic"]) for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED).collect()}


@dataclass(frozen=True)
class Model:
    """By bucket: the log ratio of the target to the raw model, and how much likelier a word is in toxic than in good texts."""

    ratio: np.ndarray
    toxic: np.ndarray


def fit(docs: DataFrame, marks: dict[int, tuple[bool, bool]], id_col: str = "doc_id", text: str = "text") -> Model:
    """Both models from the n-grams of all documents and of the marked ones among them."""
    ship(docs.sparkSession)
    known, kinds = docs.sparkSession.sparkContext.broadcast(marks), ("raw", "target", "clean", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, clean, toxic = (np.zeros(2 * BUCKETS, np.int64) for _ in range(4))
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                for i, t in zip(b.column(0).slice(at, 1000).to_pylist(), b.column(1).slice(at, 1000).to_pylist()):
                    n, other = ngrams(t)
                    np.add.at(raw, n, 1)
                    good, bad = known.value.get(i, (False, False))
                    if good:
                        np.add.at(target, n, 1)
                        clean[n] += 1  # documents, not occurrences
                        clean[other] += 1
                    elif bad:
                        toxic[n] += 1
                        toxic[other] += 1
        some = np.flatnonzero(raw + clean + toxic)
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(x[some]) for x in (raw, target, clean, toxic)]], names=["bucket", *kinds])

    got = docs.select(F.col(id_col), F.col(text)).mapInArrow(run, "bucket long, raw long, target long, clean long, toxic long").groupBy("bucket").agg(*[F.sum(x).alias(x) for x in kinds])
    counts = np.zeros((4, 2 * BUCKETS))
    for r in got.collect():  # at most 2 * BUCKETS rows
        counts[:, r["bucket"]] = [r[x] for x in kinds]
    (raw, target), (clean, toxic) = counts[:2, :BUCKETS], counts[2:]
    share = toxic.sum() / max(1.0, toxic.sum() + clean.sum())
    ratio = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    return Model(ratio, np.log((toxic + DOUBT) / (share * (toxic + clean) + DOUBT)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_grams, log_ratio, toxic)`` for every row: ``log_ratio`` is the sum over the n-grams, ``toxic`` that of
    the worst word alone, as one makes a text toxic."""
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, toxic = known.value.ratio, known.value.toxic
        for b in batches:
            n, w, x = [], [], []
            for at in range(0, b.num_rows, 1000):
                for t in b.column(1).slice(at, 1000).to_pylist():
                    grams, other = ngrams(t)
                    n.append(len(grams))
                    w.append(float(ratio[grams].sum()))
                    x.append(float(np.minimum(toxic[grams[: len(other)]], toxic[other]).max(initial=0.0)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(w, pa.float64()), pa.array(x, pa.float64())], names=[id_col, "n_grams", "log_ratio", "toxic"])

    src = docs.select(F.col(id_col).alias(id_col), F.col(text))
    return src.mapInArrow(run, T.StructType([src.schema[0]]).add("n_grams", "long").add("log_ratio", "double").add("toxic", "double"))


#: Short documents are drawn to the raw model by so many n-grams of it.
PRIOR = 16
#: A word that is seen in so many toxic documents is believed by half.
DOUBT = 5.0
#: A rejected good document costs as much as this many kept bad ones when the number to draw is set.
CARE = 5.0


def features() -> list[Column]:
    """Mean log ratio of a document, and its toxicity."""
    return [F.col("log_ratio") / (F.col("n_grams") + PRIOR), F.col("toxic")]


def calibrate(x: np.ndarray, good: np.ndarray, rounds: int = 100) -> list[tuple[float, float, float]]:
    """Logistic regression of ``good`` on the columns of ``x`` (Newton, with a small ridge): ``(middle, spread, coefficient)`` of
    each, first the intercept.

    A column counts in spreads (quartiles) from the middle of the good ones, 10 at most.  The odds turn the two models'
    scores into the ratio of a document's probability in the target to that in the raw text.
    """
    low, middle, high = np.percentile(x[good], [25, 50, 75], axis=0)
    spread = high - low + 1e-9
    z, w = np.c_[np.ones(len(x)), np.clip((x - middle) / spread, -10, 10)], np.zeros(x.shape[1] + 1)
    ridge = np.r_[1e-6, np.full(x.shape[1], 0.1)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag(ridge), z.T @ (good - p) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return list(zip([0.0, *middle.tolist()], [1.0, *spread.tolist()], w.tolist()))


def gumbel(id_col: str, seed: int | Column) -> Column:
    """Standard Gumbel noise keyed by the id."""
    u = (F.shiftrightunsigned(F.xxhash64(F.col(id_col), seed if isinstance(seed, Column) else F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def cutoff(keys: DataFrame, k: int) -> float | None:
    """The ``k``-th largest of column ``key`` (``-inf`` where there are fewer), exactly, by counting BINS intervals again and again.

    Each round brings at most BINS counts to the driver, whatever the table's size.
    """
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k >= n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    while low < high:
        width = (high - low) / BINS
        bin_ = F.least(F.floor((F.col("key") - low) / width), F.lit(BINS - 1)) if width > 0 else (F.col("key") > low).cast("long")
        inside = keys.filter((F.col("key") >= low) & (F.col("key") <= high))
        rows = inside.groupBy(bin_.alias("b")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        above = keys.filter(F.col("key") > high).count()
        for r in sorted(rows, key=lambda r: -r["b"]):
            above += r["n"]
            if above >= k:
                low, high = r["low"], r["high"]
                break
    return low


def weigh(scored: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``scored`` with ``log_weight``: the log of the calibrated probability that a document is of the target.

    The calibration takes at most LABELLED labels of the second half, which the models haven't seen; without both good
    and bad ones among them, the mean log ratio is the log weight.
    """
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1), F.lit(False))
    marks = labels.filter("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").filter(half(1)).groupBy("doc_id").agg(F.min(good).alias("good"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED).withColumnRenamed("doc_id", "_m")
    parts = [f.alias(f"_f{i}") for i, f in enumerate(features())]
    rows = scored.join(F.broadcast(marks), F.col(id_col) == F.col("_m")).select("_m", "good", *parts).dropDuplicates(["_m"]).collect()
    marked = np.array([r["good"] for r in rows], bool)
    if not len(rows) or marked.all() or not marked.any():
        return scored.withColumn("log_weight", features()[0])
    (_, _, odds), *rest = calibrate(np.array([r[2:] for r in rows], float), marked)
    for f, (middle, spread, w) in zip(features(), rest):
        odds = odds + w * F.greatest(F.lit(-10.0), F.least(F.lit(10.0), (f - middle) / spread))
    return scored.withColumn("log_weight", -F.log1p(F.exp(-odds)))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The drawn documents: ``(id, n_grams, log_weight, key)``.

    The target model is trained on labelled documents of quality 1 that aren't toxic (at most LABELLED of them), the raw
    model on all documents; ``weigh`` turns their ratio into importance weights.  ``k`` documents are drawn without
    replacement in proportion to their weights, by keyed Gumbel noise, so the draw repeats; rows tied with the last one
    drawn are all in, repeated rows among them.  Without ``k``, as many are drawn as are worth keeping if a rejected
    good document costs CARE kept bad ones; without labels of both kinds, all.

    Null and empty texts have no n-grams and mean log ratio zero; texts of any length count whole; a null id shares the
    noise of other null ids; other columns are ignored; no rows give none.
    """
    marks = labelled(labels)
    scored = score(docs.select(F.col(id_col).alias(id_col), F.col(text).alias("text")), fit(docs, marks, id_col, text), id_col)
    scored = cut(weigh(cut(scored), labels, id_col).withColumn("key", F.col("log_weight") + gumbel(id_col, seed)))
    if k is None:
        worth = scored.agg(F.max("log_weight"), F.sum((F.col("log_weight") >= -math.log1p(CARE)).cast("long"))).first()
        k = (worth[1] if worth[0] is not None and worth[0] <= 0 else None) or scored.count()
    return scored.filter(F.col("key") >= cutoff(scored, k)).select(id_col, "n_grams", "log_weight", "key")


def keep_worthy(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that aren't worth keeping: a filter by the importance weight, without a draw.

    A document stays where its weight, the probability that it is of the target, is ``1 / (1 + CARE)`` or more; rows that
    share an id stay if one of them does.  Without labels of both kinds the weight isn't calibrated and all stay.  Null, empty
    and very long texts are weighed as in ``resample``; no rows give none; other columns pass.
    """
    scored = score(docs.select(F.col(id_col).alias(id_col), F.col(text).alias("text")), fit(docs, labelled(labels), id_col, text), id_col)
    scored = cut(weigh(cut(scored), labels, id_col))
    most = scored.agg(F.max("log_weight")).first()[0]
    if most is None or most > 0:
        return docs
    kept = cut(scored.filter(F.col("log_weight") >= -math.log1p(CARE)).select(F.col(id_col).alias("_kept")).distinct())
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_kept"]), "left_semi")
