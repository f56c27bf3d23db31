"""SimHash near-duplicates: fingerprints over word shingles, pigeonhole block joins, Hamming check, components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import cut, ship, sliced
from millrace.llm.components import components

#: Rows of one block of a bucket: buckets of up to 16 blocks of LEAST rows keep to that many; larger ones have blocks of up to MOST rows.
LEAST, MOST = 256, 8192


def _mix(h: np.ndarray) -> np.ndarray:
    """Next lane of a shingle's hash (the finaliser of SplitMix64)."""
    h = h + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str | None, shingle: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; a shorter text is one shingle, one without words has none."""
    words = text.encode("utf-8", "replace").lower().split() if text else []  # bytes: ASCII letters and white space only
    if not words:
        return np.empty(0, np.uint64)
    joined, size = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)


def fingerprint(text: str | None, shingle: int = 4, lanes: int = 1) -> list[int]:
    """``lanes`` 64-bit fingerprints; a bit is set if it is set in over half of the hashes.  Lane 0 uses XXH64 itself."""
    return fingerprint_of(shingle_hashes(text, shingle), lanes)


def fingerprint_of(h: np.ndarray, lanes: int = 1) -> list[int]:
    out = []
    for lane in range(lanes):
        h = _mix(h) if lane else h
        ones = np.zeros(64, np.int64)
        for i in range(0, len(h), 65536):
            ones += np.unpackbits(h[i : i + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(ones * 2 > max(1, len(h))).tobytes(), "big", signed=True))
    return out


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, lanes: int = 1, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``lanes array<long>`` for every row; whole texts, null text counts as empty."""

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            got = [fingerprint(t, shingle, lanes) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.list_(pa.int64()))], names=[*b.schema.names[:-1], "lanes"])

    src = docs.select(*keep, F.col(text).alias("_text"))
    return src.mapInArrow(run, src.drop("_text").schema.add("lanes", T.ArrayType(T.LongType())))


def plan_blocks(n: int, radius: int, spare: int = 0) -> list[int]:
    """Masks of the block tables for ``n`` fingerprints.

    64 bits are cut into ``radius + choose`` blocks: two fingerprints that differ in at most ``radius`` bits agree on
    at least ``choose`` blocks, so they share the key of one table.  ``choose`` grows with ``n`` until a key has as
    many values as there are fingerprints, which keeps chance buckets small at every size.  ``spare`` bits fewer make
    buckets that much larger and tables fewer.
    """
    choose = next((c for c in range(1, 13) if 64 * c / (radius + c) >= math.log2(max(2, n)) + 1 - spare), 12)
    blocks = radius + choose
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(c) for c in combinations(parts, choose)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _forest(lanes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that span the components of one block (at most rows - 1), by breadth-first search."""
    left, out = np.arange(1, len(lanes)), []
    queue = [0]
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            left = left[1:]
        at = queue.pop()
        near = np.bitwise_count(lanes[left] ^ lanes[at]).sum(1, dtype=np.int64) <= radius
        out += [(at, int(x)) for x in left[near]]
        queue += left[near].tolist()
        left = left[~near]
    return out


def _link(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            if not b.num_rows:
                continue
            group = b.column(0).to_numpy(zero_copy_only=False)
            node = b.column(1).to_numpy(zero_copy_only=False)
            lanes = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).view(np.uint64)
            if rest is not None:
                group, node, lanes = (np.concatenate(x) for x in zip(rest, (group, node, lanes)))
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            rest = tuple(x[starts[-1] :] for x in (group, node, lanes))
            yield _edges(node[: starts[-1]], lanes[: starts[-1]], starts, radius)
        if rest is not None:
            yield _edges(rest[1], rest[2], np.array([0, len(rest[1])]), radius)

    return run


def _edges(node: np.ndarray, lanes: np.ndarray, starts: np.ndarray, radius: int) -> pa.RecordBatch:
    size = np.diff(starts)
    two = starts[:-1][size == 2]  # most blocks are pairs: all at once
    two = two[np.bitwise_count(lanes[two] ^ lanes[two + 1]).sum(1, dtype=np.int64) <= radius] if len(two) else two
    u, v = [node[two]], [node[two + 1]]
    for a, n in zip(starts[:-1][size > 2].tolist(), size[size > 2].tolist()):
        found = np.array(_forest(lanes[a : a + n], radius), np.int64).reshape(-1, 2) + a
        u.append(node[found[:, 0]])
        v.append(node[found[:, 1]])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(u), pa.int64()), pa.array(np.concatenate(v), pa.int64())], names=["u", "v"])


def _blocks(rows: DataFrame, counts: DataFrame, *key: str) -> DataFrame:
    """``rows`` of the buckets in ``counts(bucket, n)``, once for each pair of blocks they are in: column ``grp``."""
    counts = counts.select(F.col("bucket").bitwiseXOR(F.lit(0)).alias("b"), "n")
    size = F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.col("n") / 16))
    some = rows.join(counts, F.col("bucket") == F.col("b")).withColumn("g", F.ceil(F.col("n") / size).cast("int"))
    some = some.withColumn("c", F.pmod(F.xxhash64("node", F.lit(7)), F.col("g")).cast("int"))
    some = some.withColumn("x", F.explode(F.expr("sequence(0, g - 1)")))
    return some.withColumn("grp", F.xxhash64(*key, F.least("c", "x"), F.greatest("c", "x")))


def link(nodes: DataFrame, radius: int, tables: list[int]) -> DataFrame:
    """Edges ``(u, v)`` that span the components of ``nodes(node long, lanes array<long>)`` under Hamming distance.

    Rows meet in the buckets of the block tables.  A bucket of one row is dropped; a large one is cut into blocks by
    hash and every pair of blocks becomes a task group of its own, so no group is unbounded and no pair is lost.
    Each group emits a spanning forest, not its pairs.
    """
    rows = nodes.select("node", "lanes", F.posexplode(F.array(*[F.col("lanes")[0].bitwiseAND(F.lit(m)) for m in tables])).alias("tab", "key"))
    rows = rows.select("node", "lanes", F.xxhash64("tab", "key").alias("bucket"), "tab", "key")
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    some = _blocks(rows, counts, "tab", "key").select("grp", "node", "lanes")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return some.repartition(parts, "grp").sortWithinPartitions("grp").mapInArrow(_link(radius), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, lanes: int = 1, index_radius: int | None = None, spare: int = 0, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its fingerprint and the smallest id it reaches through links: ``(id, lanes, component_id)``.

    ``lanes`` fingerprints of 64 bits each are compared together (``radius`` bits in all); the block tables cut lane 0
    for ``index_radius`` (``radius`` where not given), within which none is missed.  Equal fingerprints are one node,
    so exact copies never pair up.  Null texts count as empty, texts without words have fingerprint zero and link to
    each other; null ids never name a component unless all of it is null; repeated rows stay and share a component.
    """
    fp = cut(fingerprints(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_t")), "_t", shingle, lanes, ("_id",)))
    fp = fp.withColumn("node", F.col("lanes")[0] if lanes == 1 else F.xxhash64("lanes"))
    nodes = cut(fp.groupBy("node").agg(F.min("_id").alias("least"), F.first("lanes").alias("lanes")))
    tables = plan_blocks(nodes.count(), radius if index_radius is None else index_radius, spare)
    roots = components(link(nodes, radius, tables))
    named = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id")).select(F.col("root").bitwiseXOR(F.lit(0)).alias("r"), "component_id")
    named = cut(named.join(least, F.col("root") == F.col("r")).select(F.col("node").alias("n"), "component_id"))
    return fp.join(named, F.col("node") == F.col("n"), "left").select(F.col("_id").alias(id_col), "lanes", "node", "component_id")


#: Tables of the similarity join and min-hashes that make a key: a pair of similarity 0.8 shares none of them with probability (1 - 0.8^4)^24 = 3e-6.
TABLES, ROWS = 24, 4
#: Tables that are tried first; the rest only compare what these haven't joined yet.  Where there is a rest, the driver searches for components once more.
FIRST = TABLES
#: Bits within which fingerprints make a pair a candidate for the exact check.
RADIUS = 4
#: Candidates up to which their texts are found by a broadcast (about 50 MB); beyond, texts are shuffled.
BROADCAST_ROWS = 1_000_000
_FLIP, _ODD = (np.random.default_rng(11 + i).integers(1 << 63, size=(TABLES * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1) for i in range(2))


def elements(text: str | None, shingle: int) -> np.ndarray:
    """The shingle multiset of a text as sorted distinct longs: the i-th occurrence of a shingle is an element of its own."""
    return distinct(shingle_hashes(text, shingle))


def distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    if len(h):
        new = np.r_[True, h[1:] != h[:-1]]
        nth = np.arange(len(h)) - np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        h = np.unique(np.where(nth > 0, _mix(h + nth.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), h))
    return h


def table_keys(h: np.ndarray) -> list[int]:
    """A key for each table, made of ROWS min-hashes; no elements have no keys."""
    if not len(h):
        return []
    least = np.full(TABLES * ROWS, np.iinfo(np.uint64).max)
    for i in range(0, len(h), 2048):
        least = np.minimum(least, ((h[None, i : i + 2048] ^ _FLIP) * _ODD).min(1))
    least, key = least.reshape(TABLES, ROWS), np.arange(TABLES, dtype=np.uint64)
    for r in range(ROWS):
        key = _mix(key ^ least[:, r])
    return key.view(np.int64).tolist()


def _alike(values: np.ndarray, starts: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Edges that span the components of one block under exact Jaccard similarity; the sets lie end to end in ``values``."""
    size = np.diff(starts)
    _, values = np.unique(values, return_inverse=True)
    mark = np.zeros(values.max() + 1, np.int64)
    left, out, queue = np.arange(1, len(size)), [], [0]
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            left = left[1:]
        at = queue.pop()
        mine = values[starts[at] : starts[at + 1]]
        mark[mine] = 1
        both = np.add.reduceat(mark[values], starts[:-1])[left]
        mark[mine] = 0
        near = both >= similarity * (size[at] + size[left] - both) - 1e-9
        out += [(at, int(x)) for x in left[near]]
        queue += left[near].tolist()
        left = left[~near]
    return out


def _join_alike(similarity: float):
    def edges(node: list, sets: list) -> tuple[list, list]:
        kept = dict(zip(node, sets))  # a node counts once
        node, sets = list(kept), list(kept.values())
        found = _alike(np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets]), similarity) if len(node) > 1 else []
        return [node[a] for a, _ in found], [node[b] for _, b in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, node, sets = None, [], []
        for b in batches:
            u, v = [], []
            ends, values = b.column(2).offsets.to_numpy(), b.column(2).values.to_numpy(zero_copy_only=False)
            for i, (g, n) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if g != last:
                    x, y = edges(node, sets)
                    u, v, last, node, sets = u + x, v + y, g, [], []
                node.append(n)
                sets.append(values[ends[i] : ends[i + 1]].copy())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
        x, y = edges(node, sets)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["u", "v"])

    return run


def similar(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``(_id, _hash, node, root)`` for every row of ``docs(doc_id, text)``: rows of one root are joined by links of this
    exact weighted Jaccard similarity of word shingles.

    Candidates are, first, the links of the rows' fingerprints within RADIUS bits (``link``); then, for similar pairs whose
    fingerprints lie further apart, rows that share the key of one of TABLES min-hash tables, whatever the number of rows.
    Each is verified on the shingles themselves.  Rows of equal shingles are one node; texts without words are one node, too.
    """
    ship(docs.sparkSession)
    text = F.coalesce(docs["text"], F.lit(""))
    src = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            node, bits, key = [], [], []
            for t in b.column(2).to_pylist():
                every = shingle_hashes(t, shingle)
                h = distinct(every)
                bits.append(fingerprint_of(every))
                node.append(xxhash.xxh64_intdigest(h.tobytes()))
                key.append(table_keys(h))
            node = np.array(node, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node), pa.array(bits, pa.list_(pa.int64())), pa.array(key, pa.list_(pa.int64()))], names=["_id", "_hash", "node", "lanes", "keys"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            got = [elements(t, shingle).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int64()))], names=["node", "elements"])

    fp = cut(src.mapInArrow(keys, src.drop("_text").schema.add("node", "long").add("lanes", T.ArrayType(T.LongType())).add("keys", T.ArrayType(T.LongType()))))
    nodes = cut(fp.groupBy("node").agg(F.min("_hash").alias("_hash"), F.first("lanes").alias("lanes"), F.first("keys").alias("keys")))
    parts, edges, roots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), None, None
    for tables in (None, *[r for r in ((0, FIRST), (FIRST, TABLES)) if r[0] < r[1]]):  # fingerprints, then tables
        if tables is None:
            near = link(nodes.filter("size(keys) > 0"), RADIUS, plan_blocks(nodes.count(), RADIUS)).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
            ends = near.select(F.xxhash64("u", "v").alias("grp"), F.explode(F.array("u", "v")).alias("node"))
            some = cut(ends.join(nodes.select("node", "_hash"), "node").select("grp", "node", "_hash"))
        else:
            known = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", F.col("node")))
            rows = known.select("node", "_hash", "root", F.explode(F.slice("keys", tables[0] + 1, tables[1] - tables[0])).alias("bucket"))
            counts = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("r"), F.max("root").alias("s"))
            some = cut(_blocks(rows, counts.filter("r != s"), "bucket").select("grp", "node", "_hash"))
        need = cut(some.select("_hash", F.col("node").alias("_node")).distinct())
        if need.count() <= BROADCAST_ROWS:
            need = F.broadcast(need)
        texts = src.join(need, "_hash").select(F.col("_node").alias("node"), "_text")
        got = texts.mapInArrow(sets, "node bigint, elements array<bigint>").groupBy("node").agg(F.first("elements").alias("elements"))
        some = some.select("grp", "node").join(got, "node").select("grp", "node", "elements")
        new = cut(some.repartition(parts, "grp").sortWithinPartitions("grp").mapInArrow(_join_alike(similarity), "u bigint, v bigint"))
        edges = new if edges is None else edges.unionByName(new)
        roots = components(edges)
    return fp.join(roots, "node", "left").select("_id", "_hash", "node", F.coalesce("root", F.col("node")).alias("root"))


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` without near copies: of each group the row with the smallest ``doc_id`` stays.

    Rows are told apart by id and text: rows equal in both are one document, rows that only share an id (or have none)
    aren't.  Null ids come last; ties go to the smaller hash of the text.
    """
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash")
    stay = similar(docs, shingle, similarity).groupBy("root").agg(F.min(order).alias("m"))
    # One key for both steps: the rows that the join puts together needn't move again to find equal ones.
    stay = stay.select(F.xxhash64("m._id", "m._hash").alias("_near_key"))
    left = docs.withColumn("_near_key", F.xxhash64("doc_id", F.xxhash64(F.coalesce(docs["text"], F.lit("")))))
    return left.join(stay, "_near_key", "left_semi").dropDuplicates(["_near_key", "doc_id", "text"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_near_duplicates(docs: DataFrame) -> DataFrame:
    """Contract columns: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``."""
    got = near_duplicates(docs)
    return got.select("doc_id", F.lower(F.lpad(F.hex(F.col("lanes")[0]), 16, "0")).alias("fingerprint"), "component_id")
