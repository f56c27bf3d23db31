"""Approximate nearest neighbours by cross-polytope hashing with multiprobe, and exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import cut, ship

#: Vectors of one block: a bucket with more of index or query vectors is cut into blocks that meet pairwise.
BLOCK = 2048
#: Cells of several blocks up to which their table is broadcast (about 50 MB); beyond, it is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def axes(unit: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Affinity of each row to the ``2 d`` signed axes after three pseudo-rotations: axis ``2 i + 1`` is ``+i``."""
    d = 1 << max(1, (unit.shape[1] - 1).bit_length())
    x = np.pad(unit, ((0, 0), (0, d - unit.shape[1])))
    rng = np.random.default_rng([seed, table])
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], d))
    return np.stack([-x, x], 2).reshape(len(x), 2 * d)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, unit vectors)`` for each length of vector in a column."""
    size = np.diff(column.offsets.to_numpy())
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        yield rows, _unit(_matrix(column.take(pa.array(rows))))


def hashes_for(rows: int, length: int) -> int:
    """Cross-polytope hashes that make a bucket: so many that buckets hold a few rows on average, at any number of rows."""
    return max(1, round(math.log(max(rows, 2) / 4) / math.log(2 << max(1, (length - 1).bit_length()))))


def own_bucket(unit: np.ndarray, table: int, hashes: int, seed: int) -> np.ndarray:
    """The bucket of each row: the numbers of its nearest signed axes, read as digits."""
    code = np.zeros(len(unit), np.int64)
    for i in range(hashes):
        near = axes(unit, table * hashes + i, seed)
        code = code * near.shape[1] + near.argmax(1)
    return code


def probed(unit: np.ndarray, table: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """The ``probes`` buckets of largest summed affinity for each row (all, if fewer).

    Only the best ``probes`` beginnings can lead to the best buckets, so the others are dropped hash by hash.
    """
    score, code = np.zeros((len(unit), 1)), np.zeros((len(unit), 1), np.int64)
    for i in range(hashes):
        near = axes(unit, table * hashes + i, seed)
        score = (score[:, :, None] + near[:, None, :]).reshape(len(unit), -1)
        code = (code[:, :, None] * near.shape[1] + np.arange(near.shape[1])).reshape(len(unit), -1)
        if score.shape[1] > probes:
            best = np.argpartition(-score, probes - 1, axis=1)[:, :probes]
            score, code = np.take_along_axis(score, best, 1), np.take_along_axis(code, best, 1)
    return code


def _cells(tables: int, hashes: int, probes: int, seed: int):
    """``(cls, least, vec)`` -> a row per table and cell: the own bucket, or with ``probes`` the buckets to ask.

    A cell holds the buckets that differ in the last axis only; ``subs`` are a row's axes there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64 if probes else 2000):
                b = whole.slice(at, 64 if probes else 2000)
                b = pa.RecordBatch.from_arrays([c.take(pa.array(np.arange(b.num_rows))) for c in b.columns], names=b.schema.names)
                for rows, unit in _by_length(b.column(2)):
                    wide = 2 << max(1, (unit.shape[1] - 1).bit_length())
                    for t in range(tables):
                        code = np.sort(probed(unit, t, hashes, probes, seed), axis=1) if probes else own_bucket(unit, t, hashes, seed)[:, None]
                        cell = (code // wide * 0x10000 + unit.shape[1]).reshape(-1)  # vectors of another length are elsewhere
                        row, sub = np.repeat(rows, code.shape[1]), (code % wide).reshape(-1)
                        edge = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (row[1:] != row[:-1])])
                        subs = pa.ListArray.from_arrays(pa.array(np.r_[edge, len(cell)].astype(np.int32)), pa.array(sub.astype(np.int32)))
                        took = pa.array(row[edge])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(edge), t), pa.int32()), pa.array(cell[edge]), subs, *[c.take(took) for c in b.columns]], names=["tab", "cell", "subs", "cls", "least", "vec"])

    return run


def _best(k: int):
    """The ``k`` best classes of each query in a block of a cell, among those in the buckets that it asks."""

    def run(group: pa.Table) -> pa.Table:
        asks = group.column("ask").combine_chunks().to_numpy(zero_copy_only=False)
        cls, least = (group.column(x).combine_chunks().to_numpy(zero_copy_only=False) for x in ("cls", "least"))
        subs = group.column("subs").combine_chunks()
        ends, subs = subs.offsets.to_numpy(), subs.values.to_numpy(zero_copy_only=False)
        x = _unit(_matrix(group.column("vec").combine_chunks()))
        owner = np.repeat(np.arange(len(x)), np.diff(ends))
        subs = subs[ends[0] : ends[-1]]
        side = asks[owner]
        q, qs, c, cs = owner[side], subs[side], owner[~side], subs[~side]
        q, c = q[np.argsort(qs, kind="stable")], c[np.argsort(cs, kind="stable")]
        qs, cs = np.sort(qs), np.sort(cs)
        got = []
        for s in np.intersect1d(qs, cs):
            mine, members = q[np.searchsorted(qs, s) : np.searchsorted(qs, s, "right")], c[np.searchsorted(cs, s) : np.searchsorted(cs, s, "right")]
            for at in range(0, len(mine), 256):
                part = mine[at : at + 256]
                score = np.round(x[part] @ x[members].T, 12)  # ties go by id, not by rounding
                if len(members) > 4 * k:  # what is clearly behind needn't be sorted
                    floor = np.partition(score, len(members) - k, axis=1)[:, len(members) - k]
                    i, j = np.nonzero(score >= floor[:, None])
                else:
                    i, j = (m.reshape(-1) for m in np.indices(score.shape))
                got.append((part[i], members[j], score[i, j]))
        q, c, score = (np.concatenate(g) for g in zip(*got)) if got else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        order = np.lexsort((cls[c], least[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        first = np.r_[True, q[1:] != q[:-1]] if len(q) else np.empty(0, bool)
        keep = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0)) < k
        return pa.table({"qcls": pa.array(cls[q[keep]], pa.int64()), "cls": pa.array(cls[c[keep]], pa.int64()), "near": pa.array(score[keep], pa.float64())})

    return run


def _scaled(vec: str) -> str:
    """``vec`` as doubles times a power of two, so that its largest component is near one and no square over- or underflows; exact, but for components
    too small to matter beside the largest."""
    most = f"array_max(transform({vec}, x -> abs(cast(x AS double))))"
    return f"element_at(transform(array(pow(2D, least(1000D, -floor(log2({most}))))), s -> transform({vec}, x -> cast(x AS double) * s)), 1)"


def _cosine(a: str, b: str) -> Column:
    """Of vectors that are scaled."""
    dot = lambda x, y: f"aggregate(zip_with({x}, {y}, (p, q) -> p * q), 0D, (s, v) -> s + v)"
    return F.expr(f"{dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)}))")


def valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, vec)`` of every row but those with a null id or a null, zero, empty or non-finite vector."""
    finite = "size(vec) > 0 AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(vec, x -> x != 0)"
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec")).filter("vec_id IS NOT NULL AND vec IS NOT NULL").filter(finite)


def _meet(index: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """``(qcls, cls, near)``: the ``k`` best of each query in each block; both sides are ``(tab, cell, subs, cls, least, vec)``.

    A cell with more rows than BLOCK is cut into blocks by hash, and each block of queries meets each block of vectors.
    """
    count = lambda df, n: df.groupBy("tab", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(n))
    hot = cut(count(index, "ni").join(count(asks, "nq"), ["tab", "cell"]).filter("ni > 1 OR nq > 1"))
    if hot.count() <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    part = lambda n: F.pmod(F.xxhash64("cls"), F.coalesce(n, F.lit(1))).cast("int")
    each = lambda n: F.explode(F.expr(f"sequence(0, coalesce({n}, 1) - 1)"))
    keys = ["tab", "cell", "bi", "bq", "subs", "cls", "least", "vec"]
    a = index.join(hot, ["tab", "cell"], "left").withColumn("bi", part("ni")).withColumn("bq", each("nq")).select(*keys, F.lit(False).alias("ask"))
    b = asks.join(hot, ["tab", "cell"], "left").withColumn("bi", each("ni")).withColumn("bq", part("nq")).select(*keys, F.lit(True).alias("ask"))
    return a.unionByName(b).groupBy("tab", "cell", "bi", "bq").applyInArrow(_best(k), "qcls long, cls long, near double").groupBy("qcls", "cls").agg(F.max("near").alias("near"))


def true_neighbours(cls: DataFrame, asked: list[tuple[int, list[float]]], k: int) -> list[tuple[int, list[float]]]:
    """``(number of the asked vector, neighbour)``: the ``k`` nearest other classes of each, by brute force over all rows."""
    known: dict[int, list] = {}
    for i, (own, vec) in enumerate(asked):
        known.setdefault(len(vec), []).append((i, own, vec))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = pa.RecordBatch.from_arrays([c.take(pa.array(np.arange(b.num_rows))) for c in b.columns], names=b.schema.names)
            for rows, unit in _by_length(b.column(1)):
                mine = known.get(unit.shape[1])
                if mine:
                    ids = b.column(0).to_numpy()[rows]
                    score = _unit(np.array([v for _, _, v in mine], float)) @ unit.T
                    score[np.array([own for _, own, _ in mine])[:, None] == ids[None, :]] = -2
                    best = np.argsort(-score, axis=1)[:, :k]
                    number = np.repeat([i for i, _, _ in mine], best.shape[1])
                    near = np.take_along_axis(score, best, 1).reshape(-1)
                    yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(near), b.column(1).take(pa.array(rows[best.reshape(-1)]))], names=["i", "near", "vec"])

    found = cls.mapInArrow(run, T.StructType().add("i", "integer").add("near", "double").add(cls.schema["vec"])).filter("near > -2")
    first = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("near")))
    return [(r["i"], r["vec"]) for r in found.withColumn("r", first).filter(F.col("r") <= k).select("i", "vec").collect()]


def probes_for(asked: list, truth: list, tables: int, hashes: int, seed: int, recall: float) -> int:
    """The fewest probes a table by which ``recall`` of the true neighbours share a bucket with their query."""
    probes, groups = 4, {}
    for i, vec in truth:
        groups.setdefault(len(vec), []).append((asked[i][1], vec))
    groups = {n: [_unit(np.array(side, float)) for side in zip(*pairs)] for n, pairs in groups.items()}
    while groups:
        hit = total = 0
        for q, v in groups.values():
            found = np.zeros(len(q), bool)
            for t in range(tables):
                own = own_bucket(v, t, hashes, seed)
                for at in range(0, len(q), 64):
                    left = np.flatnonzero(~found[at : at + 64]) + at
                    if len(left):
                        found[left] = (probed(q[left], t, hashes, probes, seed) == own[left, None]).any(1)
            hit, total = hit + found.sum(), total + len(q)
        if hit >= recall * total or all(probes >= (2 << max(1, (n - 1).bit_length())) ** hashes for n in groups):
            break
        probes = -(-probes * 5 // 4)
    return probes


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", tables: int = 8, recall: float = 0.97, sample: int = 64, seed: int = 11) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found by cosine for each row whose id is divisible by ``every``.

    Equal vectors are one class that keeps its ``k + 1`` smallest ids, which is all that can be asked for, so copies
    cost nothing.  In every table a class falls into the bucket that its nearest signed axes under several
    pseudo-rotations name, their number growing with the logarithm of the table; a query asks the buckets of largest
    summed affinity, so many that ``recall`` of the true neighbours of up to ``sample`` queries, found by brute force,
    are met.  Cells of buckets keep each query's best by exact cosine.  A query that met fewer than ``k`` others is
    compared with all.

    Every row is a query and a candidate of its own: rows that share an id stay apart, a query only leaves itself out.
    Vectors of other lengths than the query's have no cosine with it and aren't candidates; rows with null ids or
    null, zero, empty or non-finite vectors take no part.  Fewer candidates than ``k`` give all of them; ties go to the
    smaller id.
    """
    ship(vectors.sparkSession)
    base = cut(valid(vectors, id_col, vec_col))
    mine = Window.partitionBy("vec").orderBy("vec_id")
    cls = base.withColumn("r", F.row_number().over(mine)).filter(F.col("r") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    cls = cut(cls.select(F.monotonically_increasing_id().alias("cls"), F.col("ids")[0].alias("least"), "ids", "vec"))
    asked = base.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("vec").alias("v"))
    asked = cut(asked.join(cls.select("cls", "vec"), F.col("v") == F.col("vec")).select(F.monotonically_increasing_id().alias("uid"), "query_id", F.col("cls").alias("qcls")))
    qvec = cut(asked.select("qcls").distinct().join(cls.select(F.col("cls").alias("c"), "least", "vec"), F.col("qcls") == F.col("c")).select(F.col("qcls").alias("cls"), "least", "vec"))

    some = [(r["cls"], r["vec"]) for r in qvec.orderBy(F.xxhash64("vec"), "cls").limit(sample).collect()]
    rows, length = cls.agg(F.count("*"), F.max(F.size("vec"))).first()
    hashes = hashes_for(rows, length or 1)
    probes = probes_for(some, true_neighbours(cls.select("cls", "vec"), some, k), tables, hashes, seed, recall)

    kind = f"tab int, cell long, subs array<int>, cls long, least long, vec {cls.schema['vec'].dataType.simpleString()}"
    near = _meet(cls.select("cls", "least", "vec").mapInArrow(_cells(tables, hashes, 0, seed), kind), qvec.mapInArrow(_cells(tables, hashes, probes, seed), kind), k + 1)
    ids = cls.select("cls", "least", F.size("ids").alias("n"))
    near = cut(near.join(ids, "cls"))
    # A query always meets its own class, so one of the rows met is itself.
    short = near.groupBy("qcls").agg((F.sum("n") - 1).alias("met")).filter(F.col("met") < k).select(F.col("qcls").alias("cls"))
    short = cut(qvec.join(short, "cls", "left_semi"))
    if short.limit(1).count():
        whole = [F.lit(-1).alias("tab"), F.size("vec").cast("long").alias("cell"), F.array(F.lit(0)).alias("subs"), "cls", "least", "vec"]
        all_ = cls.join(short.select(F.size("vec").alias("s")).distinct(), F.size("vec") == F.col("s"), "left_semi")
        rest = _meet(all_.select(*whole), short.select(*whole), k + 1).join(ids, "cls")
        near = near.join(short.select(F.col("cls").alias("qcls")), "qcls", "left_anti").unionByName(rest)
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("qcls").orderBy(F.desc("near"), "least", "cls"))).filter(F.col("r") <= k + 1)

    a = cls.select(F.col("cls").alias("a"), F.expr(_scaled("vec")).alias("va"))
    b = cls.select(F.col("cls").alias("b"), F.expr(_scaled("vec")).alias("vb"), "ids")
    near = cut(near.select("qcls", "cls").join(a, F.col("qcls") == F.col("a")).join(b, F.col("cls") == F.col("b")).select(F.col("qcls").alias("q"), (F.col("a") == F.col("b")).alias("own"), "ids", _cosine("va", "vb").alias("score")))
    got = asked.join(near, F.col("qcls") == F.col("q"))
    got = got.withColumn("ids", F.expr("if(own, filter(ids, (x, i) -> i + 1 != array_position(ids, query_id)), ids)"))
    got = got.select("uid", "query_id", "score", F.explode("ids").alias("vec_id"))
    got = got.withColumn("rank", F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
    return got.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
