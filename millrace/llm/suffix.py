"""Exact removal of repeated byte strings by suffix sorting.

Every window of 100 bytes belongs to the 24-byte anchor with the smallest hash in it, so equal windows share an anchor
hash, and maximal runs of windows with one anchor ("segments") are the unit of work.  Segments whose anchor hash
occurs once hold no repeat.  Equal segments are pre-aggregated: all but the earliest are repeats as a whole.  The rest
meets by anchor hash in tasks that build a suffix array of their segments in two stages: suffixes smaller than
their successors are sorted directly, the others are induced by scanning the buckets; adjacent common prefixes of 100
bytes and more then give the classes of equal windows, of which all but the earliest are repeats.  An anchor of very
many segments is sorted in parts; the windows that are the earliest of their part stay together in runs, which are parted by
the anchor's place in a window, step by step, and meet by the bytes that all windows of a range of places share, until few
enough do so to be sorted together.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import ship, written

WIDTH, GRAM = 100, 24
SPAN = WIDTH - GRAM + 1
#: Bytes of text that one round of anchor search and one round of local pre-aggregation take.
BLOCK, CHUNK = 1 << 20, 1 << 25
#: Windows of one piece of a long text; positions in a round of anchor search take 28 bits.
PIECE = 1 << 24
#: Bytes of one suffix array; a group of segments is never cut, and has about HOT segments of up to 200 bytes.
ARRAY = 1 << 21
#: Segments of one anchor hash that are sorted together; an anchor of more (a very common passage's edges) has so many parts
#: that each has about as many.
HOT = 1000
#: Widths of the ranges of anchor places by which runs of windows of common anchors are parted; at 1 a row is one window.
STEPS = (32, 8, 2, 1)
#: Common anchors that are broadcast (8 bytes each); more of them are joined by a shuffle.
LISTED = 1 << 20
#: Parts of a very common key.
SALTS = 1024
NULL_ID = -(1 << 63)
#: The bits of a gram's hash that give way to its place.
LOW = (1 << 28) - 1


def words_at(text: np.ndarray, order: str = "<") -> np.ndarray:
    """The 8 bytes at every position as one integer (a view)."""
    return np.ndarray((len(text) - 7,), f"{order}u8", text, 0, (1,))


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last suffix is not."""
    diff = np.sign(np.diff(text.astype(np.int16)))
    at = np.where(diff != 0, np.arange(len(diff)), len(diff))
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return np.r_[np.r_[diff, -1][nearest] > 0, False]


def sort_directly(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` in the order of their suffixes' first ``depth`` bytes, eight at a time, ties only."""
    big = words_at(text, ">")
    key = big[at].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    for off in range(8, depth, 8):
        tied = ~(new & np.r_[new[1:], True])
        i = np.flatnonzero(tied)
        if not len(i):
            break
        group = np.cumsum(new)[i]
        key = big[at[i] + off].astype(np.uint64)
        order = np.lexsort((key, group))
        at[i] = at[i][order]
        key = key[order]
        new[i] |= np.r_[True, key[1:] != key[:-1]]
    return at


def two_stage(text: np.ndarray, wanted: np.ndarray, depth: int = WIDTH) -> np.ndarray:
    """Suffix array of the ``wanted`` positions, exact up to ``depth`` bytes.

    ``text`` ends with more than ``depth`` zero bytes and a 0xFF, none of them wanted.
    """
    small = suffix_types(text)
    need = wanted.copy()
    stop = np.minimum.accumulate(np.where(small, np.arange(len(text)), len(text))[::-1])[::-1]  # next suffix that is sorted directly
    first = np.flatnonzero(wanted & ~small)
    step = np.zeros(len(text) + 1, np.int32)
    np.add.at(step, first, 1)
    np.add.at(step, stop[first] + 1, -1)
    need |= np.cumsum(step)[:-1] > 0

    direct = sort_directly(text, np.flatnonzero(need & small), depth + 8)
    cuts = np.searchsorted(text[direct], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(c: int, block: np.ndarray) -> np.ndarray:
        before = block - 1
        before = before[(block > 0)]
        before = before[need[before] & ~small[before]]
        char = text[before]
        same = before[char == c]
        other, char = before[char > c], char[char > c]
        if len(other):
            order = np.argsort(char, kind="stable")
            other, char = other[order], char[order]
            edge = np.flatnonzero(np.r_[True, char[1:] != char[:-1]])
            for x, part in zip(char[edge].tolist(), np.split(other, edge[1:])):
                pending[x].append(part)
        return same

    for c in range(256):
        block = np.concatenate(pending[c]) if pending[c] else np.empty(0, np.int64)
        while len(block):
            out.append(block)
            block = induce(c, block)
        block = direct[cuts[c] : cuts[c + 1]]
        if len(block):
            out.append(block)
            induce(c, block)
    order = np.concatenate(out) if out else np.empty(0, np.int64)
    return order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int = WIDTH) -> np.ndarray:
    """Common prefix of each suffix with the one before it, up to ``most`` bytes; 0 for the first."""
    big = words_at(text, ">")
    a, b = order[:-1], order[1:]
    out, live = np.zeros(len(order), np.int64), np.arange(1, len(order))
    for off in range(0, most, 8):
        x = (big[a[live - 1] + off] ^ big[b[live - 1] + off]).astype(np.uint64)
        high = x.copy()
        for s in (1, 2, 4, 8, 16, 32):
            high |= high >> np.uint64(s)
        out[live] += (64 - np.bitwise_count(high).astype(np.int64)) // 8
        live = live[x == 0]
    return np.minimum(out, most)


def padded(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([*parts, bytes(WIDTH + 16), b"\xff", bytes(16)]), np.uint8)


def repeats(parts: list[bytes], doc: np.ndarray, pos: np.ndarray) -> list[tuple[int, int, int]]:
    """``(segment, first window, windows)`` of the windows that also start earlier, in segments ``parts``.

    ``doc`` ranks each segment's document, ``pos`` is its start there; equal places (repeated rows) aren't earlier.
    """
    text = padded(parts)
    size = np.array([len(p) for p in parts], np.int64)
    n = size - WIDTH + 1
    starts = np.cumsum(size) - size
    segment = np.repeat(np.arange(len(parts)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = starts[segment] + offset
    wanted = np.zeros(len(text), bool)
    wanted[at] = True
    window = np.zeros(len(text), np.int64)
    window[at] = np.arange(len(at))
    order = two_stage(text, wanted)
    head = np.flatnonzero(common_prefixes(text, order) < WIDTH)
    place = (doc[segment].astype(np.int64) << 32) + pos[segment] + offset
    mine = place[window[order]]
    least = np.repeat(np.minimum.reduceat(mine, head), np.diff(np.r_[head, len(order)]))
    flag = np.zeros(len(at), bool)
    flag[window[order]] = mine > least
    edge = np.flatnonzero(np.r_[True, (flag[1:] != flag[:-1]) | (segment[1:] != segment[:-1])]) if len(at) else np.empty(0, np.int64)
    length = np.diff(np.r_[edge, len(at)])
    keep = flag[edge]
    return list(zip(segment[edge][keep].tolist(), offset[edge][keep].tolist(), length[keep].tolist()))


def gram_hashes(buf: np.ndarray, total: int) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each place of the first ``total`` bytes; ``buf`` has eight more at least."""
    w = words_at(buf)
    h = w[: total - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += w[8 : total - GRAM + 9] * np.uint64(0xC2B2AE3D27D4EB4F)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h += w[16 : total - GRAM + 17] * np.uint64(0x165667B19E3779F9)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(30)
    return h


def anchor_places(parts: list[bytes]) -> list[int]:
    """Where the anchor of each part's first window begins in it."""
    buf = np.frombuffer(b"".join([*parts, bytes(GRAM + 8)]), np.uint8)
    size = np.array([len(p) for p in parts], np.int64)
    h = gram_hashes(buf, int(size.sum())) & ~np.uint64(LOW)
    return h[(np.cumsum(size) - size)[:, None] + np.arange(SPAN)].argmin(1).tolist()


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Segments of ``texts``: ``(text, start, windows, anchor hash)``; ties of the smallest hash go to the left."""
    size = np.array([len(t) for t in texts], np.int64)
    buf = np.frombuffer(b"".join([*texts, bytes(GRAM + 8)]), np.uint8)
    total = int(size.sum())
    if total < WIDTH:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    h = gram_hashes(buf, total)
    low = np.uint64(LOW)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    have = 1
    while have * 2 <= SPAN:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < SPAN:
        least = np.minimum(least[: len(least) - (SPAN - have)], least[SPAN - have :])
    end = np.cumsum(size)
    inside = np.zeros(total + 1, np.int8)
    whole = size >= WIDTH
    np.add.at(inside, (end - size)[whole], 1)
    np.add.at(inside, (end - WIDTH + 1)[whole], -1)
    valid = np.cumsum(inside)[: len(least)] > 0
    new = valid & np.r_[True, (least[1:] != least[:-1]) | ~valid[:-1]]
    stop = np.r_[new[1:] | ~valid[1:], True] & valid
    a, b = np.flatnonzero(new), np.flatnonzero(stop) + 1
    text = np.searchsorted(end, a, side="right")
    return text, a - (end - size)[text], b - a, h[(least[a] & low).astype(np.int64)].view(np.int64)


SEGMENT = T.StructType().add("mh", "long").add("sfp", "long").add("id", "long").add("tie", "long").add("pos", "integer").add("n", "integer").add("dup", "boolean")
RUN = T.StructType().add("id", "long").add("tie", "long").add("pos", "integer").add("n", "integer")


def _batch(schema: T.StructType, cols: list) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(cols, schema)], names=schema.names)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of ``(id, tie, text)`` rows.  Within a chunk, equal segments but the earliest are marked repeats; runs of
    these in a document become one row."""
    held, size = [], 0
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = list(zip(*(b.column(c).slice(i, 500).to_pylist() for c in range(3))))
            held += [x for x in part if len(x[2]) >= WIDTH]
            size += sum(len(x[2]) for x in part)
            if size >= CHUNK:
                yield _chunk(held)
                held, size = [], 0
    if held:
        yield _chunk(held)


def _chunk(docs: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    # A long text is looked at in pieces; each window starts in one of them.
    pieces = [(i, s, body[s : s + PIECE + WIDTH - 1] if len(body) >= PIECE else body) for i, (_, _, body) in enumerate(docs) for s in range(0, len(body) - WIDTH + 1, PIECE)]
    found, at = [], 0
    while at < len(pieces):
        to, size = at, 0
        while to < len(pieces) and (size < BLOCK or to == at):
            size += len(pieces[to][2])
            to += 1
        text, start, n, mh = anchors([p[2] for p in pieces[at:to]])
        whose, offset = (np.array([p[x] for p in pieces[at:to]], np.int64) for x in (0, 1))
        found.append((whose[text], start + offset[text], n, mh))
        at = to
    text, start, n, mh = (np.concatenate(x) for x in zip(*found))
    digest = xxhash.xxh3_64_intdigest
    bodies = [d[2] for d in docs]
    sfp = np.array([digest(bodies[t][a : a + k + WIDTH - 1]) for t, a, k in zip(text.tolist(), start.tolist(), n.tolist())], np.uint64).view(np.int64)
    ids, tie = np.array([d[0] for d in docs], np.int64), np.array([d[1] for d in docs], np.int64)
    rank = np.unique(np.stack([ids, tie], 1), axis=0, return_inverse=True)[1].reshape(-1)[text]
    order = np.lexsort((start, rank, sfp, mh))
    head = np.r_[True, (mh[order][1:] != mh[order][:-1]) | (sfp[order][1:] != sfp[order][:-1])]
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    dup = np.zeros(len(order), bool)
    dup[order] = (rank[order] != rank[first]) | (start[order] != start[first])
    # Segments are in text order, so a repeat that follows on a repeat extends it.
    fresh = np.r_[True, ~(dup[1:] & dup[:-1] & (text[1:] == text[:-1]) & (start[1:] == start[:-1] + n[:-1]))]
    at = np.flatnonzero(fresh)
    n = np.add.reduceat(n, at)
    spread = np.where(dup[at], ids[text[at]] * 0x9E3779B97F4A7C1 + start[at] * 0xC2B2AE3D27D4EB, mh[at])  # repeats are settled: any key will do
    return _batch(SEGMENT, [spread, np.where(dup[at], 0, sfp[at]), ids[text[at]], tie[text[at]], start[at], n, dup[at]])


SORTED = T.StructType(RUN.fields[:]).add("bytes", "binary")
RANGE = T.StructType().add("key", "long").add("sfp", "long").add("id", "long").add("tie", "long").add("pos", "integer").add("n", "integer").add("bytes", "binary")
WINDOW = T.StructType().add("key", "long").add("part", "long").add("hot", "boolean").add("id", "long").add("tie", "long").add("pos", "integer").add("bytes", "binary")


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, tie, text, segments)`` -> a row per segment with its bytes."""
    for b in batches:
        for i in range(0, b.num_rows, 200):
            rows = []
            for key, tie, body, segments in zip(*(b.column(c).slice(i, 200).to_pylist() for c in range(4))):
                rows += [(s["mh"], s["part"], s["hot"], key, tie, s["pos"], body[s["pos"] : s["pos"] + s["n"] + WIDTH - 1]) for s in segments]
            if rows:
                yield _batch(WINDOW, list(zip(*rows)))


def _parted(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Runs of windows ``(id, tie, pos, n, bytes)`` -> a row per run and range of ``width`` places of the anchor in a window.

    Equal windows have their anchor at one place, so they are in one range; ``key`` is a hash of the bytes that all windows
    of the range share, ``sfp`` one of all bytes of the row's windows.
    """
    digest = xxhash.xxh3_64_intdigest
    for b in batches:
        for i in range(0, b.num_rows, 200):
            rows = []
            cols = [c.slice(i, 200).to_pylist() for c in b.columns]
            for key, tie, pos, n, body, place in zip(*cols, anchor_places(cols[4])):
                at = 0
                while at < n:
                    least = (place - at) // width * width
                    most = min(least + width, SPAN) - 1
                    to = min(n, place - least + 1)
                    own = body[at : to + WIDTH - 1]
                    shared = body[place - least : place - most + WIDTH]
                    rows.append((digest(shared) - (1 << 63), digest(own, 1) - (1 << 63), key, tie, pos + at, to - at, own))
                    at = to
            if rows:
                yield _batch(RANGE, list(zip(*rows)))


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among segments sorted by group; whole groups per suffix array.

    Of segments that are but a part of their anchor's, what isn't a repeat within the part follows with its bytes.
    """
    held, size = [], 0

    def solve(rows: list) -> pa.RecordBatch:
        many = Counter(r[:2] for r in rows)
        rows = [r for r in rows if r[2] or many[r[:2]] > 1]
        if not rows:
            return _batch(SORTED, [[]] * 5)
        docs = sorted({(r[3], r[4]) for r in rows})
        rank = {d: i for i, d in enumerate(docs)}
        found = repeats([r[6] for r in rows], np.array([rank[r[3], r[4]] for r in rows]), np.array([r[5] for r in rows], np.int64))
        out = [(*rows[s][3:5], rows[s][5] + a, n, None) for s, a, n in found]
        gone: dict[int, list[tuple[int, int]]] = {}
        for s, a, n in found:
            gone.setdefault(s, []).append((a, a + n))
        for s, (_, _, hot, key, tie, pos, body) in enumerate(rows):
            if hot:
                at = 0
                for a, z in [*gone.get(s, ()), (len(body) - WIDTH + 1, 0)]:
                    if a > at:
                        out.append((key, tie, pos + at, a - at, body[at : a + WIDTH - 1]))
                    at = z
        return _batch(SORTED, list(zip(*out)) if out else [[]] * 5)

    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if size >= ARRAY and r[:2] != held[-1][:2]:
                yield solve(held)
                held, size = [], 0
            held.append(r)
            size += len(r[6])
    if held:
        yield solve(held)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    for b in batches:
        out = []
        for i in range(0, b.num_rows, 200):
            for body, runs in zip(b.column(1).slice(i, 200).to_pylist(), b.column(2).slice(i, 200).to_pylist()):
                spans: list[list[int]] = []
                for a, z in sorted((r["pos"], r["pos"] + r["n"] + WIDTH - 1) for r in runs or []):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], z)
                    else:
                        spans.append([a, z])
                kept, at = hashlib.sha256(), 0
                for a, z in spans:
                    kept.update(body[at:a])
                    at = z
                kept.update(body[at:])
                out.append((len(body), sum(z - a for a, z in spans), len(spans), kept.hexdigest(), [{"start": a, "end": z} for a, z in spans]))
        cols = list(zip(*out)) if out else [[]] * 5
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([b.column(0), *_batch(schema, cols[:3]).columns, pa.array(cols[3], pa.string()), pa.array(cols[4], span)], names=["id", *schema.names, "kept_sha256", "removed"])


def _earliest(rows: DataFrame, *key: str) -> DataFrame:
    """``dup`` is true where an earlier place has the same ``key``: ranked first in salted parts of a key, then among the
    first of each part, so that no task holds all rows of a very common key."""
    place = ["id", "tie", "pos"]
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(*place), F.lit(SALTS)))
    rows = rows.withColumn("later", F.rank().over(Window.partitionBy(*key, "salt").orderBy(*place)) > 1)
    rows = rows.withColumn("among", F.when(F.col("later"), F.col("salt")).otherwise(-1))
    return rows.withColumn("dup", F.col("later") | (F.rank().over(Window.partitionBy(*key, "among").orderBy(*place)) > 1)).drop("salt", "later", "among")


def _refined(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs of windows of common anchors -> runs that are repeats as a whole, and groups to be sorted.

    A row is parted into at most four at each step.  Rows that are equal as a whole are settled; where at most ``HOT`` unlike ones
    share a key, they are a group; only the others go on.  In the last step the rows of a key are equal.
    """
    equal, groups = [], []
    for width in STEPS:
        parted = written(_earliest(rows.mapInArrow(partial(_parted, width=width), RANGE), "key", "sfp"), "parted")
        equal.append(parted.filter("dup").select("id", "tie", "pos", "n"))
        rows = parted.filter("NOT dup")
        common = written(rows.groupBy("key").count().filter(F.col("count") > HOT).select("key"), "common")
        n = common.count() if width > 1 else 0
        common = F.broadcast(common) if n <= LISTED else common
        group = rows.join(common, "key", "left_anti") if n else rows
        groups.append(group.select("key", F.lit(0).cast("long").alias("part"), F.lit(False).alias("hot"), "id", "tie", "pos", "bytes"))
        if not n:
            break
        rows = rows.join(common, "key", "left_semi").select("id", "tie", "pos", "n", "bytes")
    return reduce(DataFrame.unionByName, equal), reduce(DataFrame.unionByName, groups)


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row: ``id, n_bytes, n_removed, n_spans, kept_sha256, removed array<struct<start, end>>``.

    Each byte covered by a 100-byte string that also starts earlier goes: in a document with a smaller id, or earlier
    in the same one.  Documents that share an id come in the order of a hash of their texts, null ids first; rows equal in
    id and text are one document and give equal results.  Null text counts as empty; texts under 100 bytes lose nothing,
    longer ones of any length count whole; other columns are ignored; no rows give none.
    """
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shared = src.groupBy("id").count().filter("count > 1").limit(1).count() > 0
    src = src.select("id", (F.xxhash64("text") if shared else F.lit(0)).cast("long").alias("tie"), F.col("text").cast("binary").alias("text"))
    one = src.dropDuplicates(["id", "tie"]) if shared else src

    found = one.mapInArrow(_segments, SEGMENT)
    common = written(found.filter("NOT dup").groupBy("mh").count().filter(F.col("count") > HOT).select("mh", F.ceil(F.col("count") / HOT).alias("parts")), "common")
    n_common = common.count()
    common = F.broadcast(common) if n_common <= LISTED else common
    # Rows of a common anchor pass the windows under keys of their own.
    seg = found.join(common, "mh", "left").withColumn("hot", F.expr("parts IS NOT NULL AND NOT dup")).withColumn("key", F.expr("CASE WHEN hot THEN xxhash64(id, tie, pos) ELSE mh END"))
    by_string, by_anchor = Window.partitionBy("key", "sfp").orderBy("id", "tie", "pos"), Window.partitionBy("key")
    seg = seg.withColumn("dup", F.col("dup") | (F.rank().over(by_string) > 1))
    seg = seg.withColumn("many", F.min("sfp").over(by_anchor) != F.max("sfp").over(by_anchor)).filter("dup OR many OR hot")
    part = F.expr("CASE WHEN hot THEN pmod(xxhash64(id, tie, pos), parts) ELSE 0 END AS part")
    seg = written(seg.select("id", "tie", "pos", "n", "dup", "mh", "hot", part, F.expr("CASE WHEN hot THEN sfp END AS sfp")), "segments")
    settled = written(_earliest(seg.filter("hot").drop("dup"), "mh", "sfp"), "settled")
    seg = seg.filter("NOT hot").unionByName(settled)

    open_ = seg.filter("NOT dup").groupBy("id", "tie").agg(F.collect_list(F.struct("mh", "pos", "n", "hot", "part")).alias("segments"))
    open_ = one.join(open_.select(F.col("id").alias("i"), F.col("tie").alias("t"), "segments"), (F.col("id") == F.col("i")) & (F.col("tie") == F.col("t"))).select("id", "tie", "text", "segments")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = lambda rows: rows.repartition(parts, "key", "part").sortWithinPartitions("key", "part").mapInArrow(_sort_groups, SORTED)
    first = written(grouped(open_.mapInArrow(_cut_out, WINDOW)), "sorted")
    runs = seg.filter("dup").select("id", "tie", "pos", "n").unionByName(first.filter("bytes IS NULL").select("id", "tie", "pos", "n"))
    if n_common:
        equal, groups = _refined(first.filter("bytes IS NOT NULL"))
        runs = runs.unionByName(equal).unionByName(grouped(groups).select("id", "tie", "pos", "n"))
    runs = runs.groupBy("id", "tie").agg(F.collect_list(F.struct("pos", "n")).alias("runs")).select(F.col("id").alias("i"), F.col("tie").alias("t"), "runs")
    full = src.join(runs, (F.col("id") == F.col("i")) & (F.col("tie") == F.col("t")), "left").select("id", "text", "runs")
    out = full.mapInArrow(_finish, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start: bigint, end: bigint>>")
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")


def op2_repeated_bytes(docs: DataFrame) -> DataFrame:
    """Contract columns."""
    return repeated_bytes(docs).drop("removed")
