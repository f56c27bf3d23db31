"""Hard-negative mining by slots: the scores of an anchor's positives cut the score axis into disjoint slots.

Anchors and rows meet in blocks.  The first meeting, within a label, finds each anchor's positives.  Their scores, as upper
limits in descending order, cut the scores into slots, and the second meeting keeps the best ``k`` rows of other labels in
each slot.  The window of a positive is its slot and all below it, so the best of a window are the first of its own
slot's list followed by the lists below: every window is read off one list per anchor.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut, ship
from millrace.llm.neighbours import _matrix

#: Rows and anchors of one block at most, and numbers of its vectors: what one call holds.
ROWS, ANCHORS, NUMBERS = 16_384, 4_096, 1 << 21
#: Scores computed at a time.
SLICE = 1 << 20
#: Scores beyond 64 bits count as the nearest that fits.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _big(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as Python's integers, at any size."""
    return np.array([[int(v) * scale if abs(v) >= 1 << 45 else math.floor(v * scale) for v in r] for r in x.tolist()], object).reshape(x.shape)


def scores(a: np.ndarray, b: np.ndarray, scale: int) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``, components scaled and floored: exact integers, clipped to 64 bits."""
    with np.errstate(over="ignore", invalid="ignore"):
        x, y = np.floor(a * scale), np.floor(b * scale)
    most = math.sqrt((1 << 53) / max(1, x.shape[1])) - 1  # below, doubles hold every partial sum exactly
    wide = [np.flatnonzero(np.abs(v).max(1, initial=0) > most) for v in (x, y)]
    x[wide[0]], y[wide[1]] = 0, 0
    out = (x @ y.T).astype(np.int64)
    exact = lambda p, q: np.clip(_big(p, scale) @ _big(q, scale).T, LEAST, MOST).astype(np.int64)
    if len(wide[0]):
        out[wide[0]] = exact(a[wide[0]], b)
    if len(wide[1]):
        out[:, wide[1]] = exact(a, b[wide[1]])
    return out


def _first(k: int, *order: np.ndarray, group: int) -> np.ndarray:
    """Places of the first ``k`` of each group, in order; the first ``group`` of the sort columns are the group."""
    at = np.lexsort(order[::-1])
    new = np.zeros(len(at), bool)
    for c in order[:group]:
        new |= np.r_[True, c[at][1:] != c[at][:-1]] if len(at) else new
    place = np.arange(len(at))
    return at[place - np.maximum.accumulate(np.where(new, place, 0)) < k] if len(at) else at


def _sides(group: pa.Table):
    """The anchors of a block, then its rows: a table and a matrix for each."""
    ask = group.column("ask").combine_chunks()
    for side in (group.filter(ask), group.filter(pa.compute.invert(ask))):
        yield side, _matrix(side.column("vec").combine_chunks()) if side.num_rows else np.zeros((0, 0))


def _ints(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _found(uid: list, parts: dict[str, list]) -> pa.Table:
    join = lambda x: np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64)
    return pa.table({"uid": pa.array(join(uid), pa.int64())} | {n: pa.array(join(x), pa.int64()) for n, x in parts.items()})


def _positives(k: int, scale: int):
    """The best ``k`` rows of a block for each anchor but the anchor itself."""

    def run(group: pa.Table) -> pa.Table:
        (asks, a), (rows, b) = _sides(group)
        uid, out = [], {"id": [], "score": []}
        if asks.num_rows and rows.num_rows:
            own, other, ids = _ints(asks, "uid"), _ints(rows, "uid"), _ints(rows, "id")
            step = max(1, SLICE // len(b))
            for at in range(0, len(a), step):
                s = scores(a[at : at + step], b, scale)
                fits = own[at : at + step, None] != other[None, :]
                if len(b) > 4 * k:  # what is clearly behind needn't be sorted; the anchor itself may be among the best k + 1
                    fits &= s >= np.partition(s, len(b) - k - 1, axis=1)[:, len(b) - k - 1, None]
                i, j = np.nonzero(fits)
                keep = _first(k, i, -s[i, j].astype(float), -s[i, j], ids[j], group=1)
                uid.append(own[at + i[keep]])
                out["id"].append(ids[j[keep]])
                out["score"].append(s[i[keep], j[keep]])
        return _found(uid, out)

    return run


def _negatives(k: int, scale: int, low: int, high: int):
    """The best ``k`` rows of other labels of a block for each anchor and slot; slot ``n`` lies under the anchor's ``n``-th limit."""

    def run(group: pa.Table) -> pa.Table:
        (asks, a), (rows, b) = _sides(group)
        uid, out = [], {"slot": [], "id": [], "score": []}
        if asks.num_rows and rows.num_rows:
            own, ids = _ints(asks, "uid"), _ints(rows, "id")
            names = {v: n for n, v in enumerate(set(asks.column("label").to_pylist()) | set(rows.column("label").to_pylist()))}
            mine, theirs = (np.array([names[v] for v in t.column("label").to_pylist()]) for t in (asks, rows))
            limits = asks.column("limits").to_pylist()
            most = max(map(len, limits))
            pad = np.array([[*x, *[LEAST] * (most - len(x))] for x in limits], np.int64)
            last = np.array([min(MOST, -(-low * x[-1] // high)) for x in limits], np.int64)  # no window reaches below
            step = max(1, SLICE // len(b))
            for at in range(0, len(a), step):
                s = scores(a[at : at + step], b, scale)
                i, j = np.nonzero((s <= pad[at : at + step, :1]) & (s >= last[at : at + step, None]) & (mine[at : at + step, None] != theirs[None, :]))
                got = s[i, j]
                slot = (pad[at + i] >= got[:, None]).sum(1) - 1
                slot = np.minimum(slot, np.array([len(x) for x in limits])[at + i] - 1)
                keep = _first(k, i, slot, -got.astype(float), -got, ids[j], group=2)
                uid.append(own[at + i[keep]])
                for name, v in (("slot", slot), ("id", ids[j]), ("score", got)):
                    out[name].append(v[keep])
        return _found(uid, out)

    return run


def _meet(rows: DataFrame, anchors: DataFrame, parts: list[str], run, schema: str) -> DataFrame:
    """``run`` over every block of anchors with every block of rows of the same ``parts``; both sides are dealt by hash."""
    size = F.greatest(F.lit(64), F.least(F.lit(ROWS), NUMBERS / F.greatest(F.col("dim"), F.lit(1))))
    blocks = lambda df, n, most: df.groupBy(*parts).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / F.max(most))).cast("int").alias(n))
    count = blocks(rows, "nr", size).join(blocks(anchors, "na", F.least(size, F.lit(ANCHORS))), parts)
    part = lambda n: F.pmod(F.xxhash64("uid"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = [*parts, "br", "ba", *[c for c in ("uid", "id", "label", "vec", "limits") if c in anchors.columns and c not in parts], "ask"]
    a = anchors.join(count, parts).withColumn("ba", part("na")).withColumn("br", each("nr")).withColumn("ask", F.lit(True))
    r = rows.join(count, parts).withColumn("br", part("nr")).withColumn("ba", each("na")).withColumn("ask", F.lit(False))
    if "limits" in cols:
        r = r.withColumn("limits", F.lit(None).cast("array<bigint>"))
    return a.select(cols).unionByName(r.select(cols)).groupBy(*parts, "br", "ba").applyInArrow(run, schema)


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each group; Spark cuts every task's share to ``k`` before the shuffle, too."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return found.withColumn("_place", place).filter(F.col("_place") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, k: int = 5, low: int = 80, high: int = 100, scale: int = 256,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for anchors, the rows whose id is divisible by ``every``.

    A score is the inner product of components ``floor(scale * x)``, an exact integer (beyond 64 bits: the nearest that
    fits).  An anchor's positives are its ``positives`` best other rows of the same label; for each, up to ``k`` rows of
    other labels whose scores lie between ``low / high`` of the positive's and the positive's follow, best first.  Higher
    scores come first, ties by smaller id.

    Rows with a null id, label or vector, or with a null or non-finite component take no part; vectors of another length
    than the anchor's have no score with it.  Rows that share an id are rows of their own: an anchor leaves out only itself, and
    each of two equal anchors has its rows.  Negative scores of a positive leave its window empty.  Anchors without
    positives, or without rows in a window, give no row; no rows give none; other columns are ignored.
    """
    ship(vectors.sparkSession)
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    base = base.filter("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    base = cut(base.select(F.monotonically_increasing_id().alias("uid"), "id", "label", F.size("vec").alias("dim"), "vec"))
    anchors = base.filter(F.col("id") % every == 0)
    near = _meet(base, anchors, ["label", "dim"], _positives(positives, scale), "uid long, id long, score long")
    near = cut(_best(near, ["uid"], positives).select("uid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    limits = near.groupBy("uid").agg(F.sort_array(F.collect_set("positive_score"), asc=False).alias("limits"))  # at most ``positives`` of them
    anchors = cut(anchors.join(limits, "uid"))
    slots = _meet(base, anchors, ["dim"], _negatives(k, scale, low, high), "uid long, slot long, id long, score long")
    slots = _best(slots, ["uid", "slot"], k)
    # Slots descend, so their lists one after the other are in the order of score, then id: at most ``positives * k`` rows.
    ranked = slots.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("slot", F.col("_place").alias("place"), "id", "score"))).alias("ranked"))
    got = near.join(anchors.select("uid", F.col("id").alias("anchor_id"), "limits"), "uid").join(ranked, "uid")
    wide = lambda c: f"cast({c} AS decimal(38, 0))"
    window = f"slice(filter(ranked, x -> x.slot >= array_position(limits, positive_score) - 1 AND {low} * {wide('positive_score')} <= {high} * {wide('x.score')}), 1, {k})"
    got = got.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.expr(window)).alias("p", "x"))
    return got.select("anchor_id", "positive_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("negative_id"), "positive_score", F.col("x.score").alias("negative_score"))


def op12_mine(vectors: DataFrame) -> DataFrame:
    """The registered query: labels of ids divisible by 7 are moved on by one of ten first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label))


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS uid, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.uid, a.id AS anchor_id, b.id AS other, a.label = b.label AS same, CAST(list_inner_product(a.vec, b.vec) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.uid <> b.uid AND len(a.vec) = len(b.vec)),
p AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, other) AS place FROM s WHERE same QUALIFY place <= 5),
n AS (SELECT p.uid, p.anchor_id, p.place, p.other AS positive_id, p.score AS positive_score, s.other AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.uid, p.place ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON p.uid = s.uid AND NOT s.same AND s.score <= p.score AND 80 * p.score <= 100 * s.score QUALIFY rank <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n
"""
