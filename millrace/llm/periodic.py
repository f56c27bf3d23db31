"""Periodic runs of words by grammar compression.

The word ids of many texts are compressed together by Re-Pair: pairs of symbols become new symbols, the most frequent first
(in rounds: every pair that is more frequent than both pairs it overlaps), never across texts; what is left of a text is
paired neighbour by neighbour, so that each text is one symbol.  A run crosses the boundary between the two halves of the
smallest symbol that holds it whole.  So runs are computed once for each symbol, at its boundary, and translated to all
places where the symbol is derived; intervals that a symbol's ends have cut merge with the whole ones.

Equality of word sequences is tested by two 31-bit polynomial hashes of ids, extensions by binary search over them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.common import ship

#: Words that are compressed together, about; a longer text is taken alone.
BATCH = 200_000
#: Re-Pair ends when a round replaces less than this share of the symbols.
GAIN = 0.01
#: Candidates looked at together.
SLICE = 1 << 20
PRIMES, BASES = np.array([2147483647, 2147483629]), np.array([1103515245, 69069069])
SPREAD = np.uint64(0x9E3779B97F4A7C15)

_kept: dict = {}


def _powers(n: int) -> np.ndarray:
    """Powers of both bases up to ``n``."""
    got = _kept.get("powers")
    if got is None or got.shape[1] <= n:
        got = np.ones((2, 1), np.int64)
        while got.shape[1] <= n:
            step = got[:, -1] * BASES % PRIMES
            got = np.concatenate([got, got * step[:, None] % PRIMES[:, None]], 1)
        _kept["powers"] = got
    return got


class Sequence:
    """Word ids of a batch with what equality tests need."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.power = _powers(self.n + 1)
        mixed = ((ids.astype(np.uint64) + np.uint64(1)) * SPREAD >> np.uint64(34)).astype(np.int64)
        self.sums = [np.r_[0, np.cumsum(value * w[: self.n] % p)] for p, w, value in zip(PRIMES, self.power, (ids + 1, mixed))]
        order = np.argsort(ids, kind="stable")
        self.rank = np.empty(self.n, np.int64)
        self.rank[order] = np.arange(self.n)
        self.order, self.key = order, ids[order].astype(np.int64) * self.n + order  # places of each word, ascending
        last = np.full(self.n, -1, np.int64)
        same = np.flatnonzero(ids[order][1:] == ids[order][:-1])
        last[order[same + 1]] = order[same]
        self.back = np.arange(self.n) - np.where(last < 0, -self.n, last)  # distance to the word's last place, at least n: none
        self.ahead = np.full(self.n, 2 * self.n + 1, np.int64)
        self.ahead[order[same]] = order[same + 1] - order[same]

    def equal(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words from ``i`` equal those from ``j``, ``i <= j``."""
        out = np.ones(len(i), bool)
        for p, w, s in zip(PRIMES, self.power, self.sums):
            out &= (s[i + n] - s[i]) % p * w[j - i] % p == (s[j + n] - s[j]) % p
        return out

    def extent(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
        """How many words from ``i`` and ``j`` on (or before them) are equal, ``most`` at most."""
        low, high = np.zeros(len(i), np.int64), most.copy()
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                return low
            mid = (low[todo] + high[todo] + 1) // 2
            a, b = (i[todo], j[todo]) if ahead else (i[todo] - mid, j[todo] - mid)
            same = self.equal(a, b, mid)
            low[todo[same]] = mid[same]
            high[todo[~same]] = mid[~same] - 1


class Grammar:
    """Rules by symbol number from ``words`` on: left and right symbol, place of an occurrence and lengths of both halves."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray):
        """``ends``: where each text ends; every text becomes one symbol, ``roots``, from ``starts`` on."""
        self.words = int(ids.max(initial=-1)) + 1
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.made = 0
        sym, at, n = ids.astype(np.int64), np.arange(len(ids)), len(ids)
        last = np.zeros(n, bool)
        last[ends - 1] = True
        while len(sym) > 1:
            pick = self._frequent(sym, last)
            if len(pick) < max(1, GAIN * len(sym)):
                break
            sym, at, last = self._replace(sym, at, last, pick, n)
        while not last.all():
            begin = np.r_[0, np.flatnonzero(last)[:-1] + 1]
            place = np.arange(len(sym)) - np.repeat(begin, np.diff(np.r_[begin, len(sym)]))
            sym, at, last = self._replace(sym, at, last, np.flatnonzero((place % 2 == 0) & ~last), n)
        self.roots, self.starts = sym, at
        cols = [np.concatenate(c) for c in zip(*self.parts)] if self.parts else [np.empty(0, np.int64)] * 5
        self.left, self.right, self.at, self.a, self.b = cols

    @staticmethod
    def _frequent(sym: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Places of the pairs to replace: seen twice or more, more often than the pairs they overlap; every other of a row of equal ones."""
        h = sym[:-1].astype(np.uint64) * SPREAD + sym[1:].astype(np.uint64)
        h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
        bits = max(12, int(len(h)).bit_length() + 1)
        cell = (h >> np.uint64(64 - bits)).astype(np.int64)
        cell[last[:-1]] = 1 << bits
        seen = np.bincount(cell, minlength=(1 << bits) + 1)
        seen[-1] = 0
        weight = (seen[cell] << 32) | (h >> np.uint64(32)).astype(np.int64)  # ties between pairs go by hash
        weight[last[:-1]] = -1
        edge = np.r_[True, weight[1:] != weight[:-1]]
        place = np.arange(len(weight))
        off = place - np.maximum.accumulate(np.where(edge, place, 0))
        up = np.r_[True, weight[1:] > weight[:-1]] | (off > 0)
        down = np.r_[weight[:-1] >= weight[1:], True]
        return np.flatnonzero((weight >= 2 << 32) & (off % 2 == 0) & up & down)

    def _replace(self, sym, at, last, pick, n):
        """The sequence with the picked pairs replaced; equal pairs get one symbol."""
        left, right = sym[pick], sym[pick + 1]
        wide = self.words + self.made + 1
        _, first, which = np.unique(left * wide + right, return_index=True, return_inverse=True)
        end = np.r_[at[1:], n]
        one = pick[first]
        self.parts.append((left[first], right[first], at[one], at[one + 1] - at[one], end[one + 1] - at[one + 1]))
        stay = np.ones(len(sym), bool)
        stay[pick + 1] = False
        sym, last = sym.copy(), last.copy()
        sym[pick] = self.words + self.made + which
        last[pick] = last[pick + 1]
        self.made += len(first)
        return sym[stay], at[stay], last[stay]


def _candidates(s: Sequence, g: Grammar, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rule, period, from)``: ``from`` on, ``period`` words are equal to the next ``period``, next to the rule's boundary.

    A run of ``times`` periods has half of them on one side of the boundary: the left half ends, or the right one begins,
    with ``times / 2`` equal stretches; two are looked for.  The period is the distance to an earlier (later) place of
    the word at the boundary.
    """
    half = max(1, times // 2)
    rules = np.flatnonzero((g.a + g.b >= least) & (g.a + g.b >= times))
    c, out = g.at[rules] + g.a[rules], []
    for side, near, step in ((g.a, s.back, -1), (g.b, s.ahead, 1)):
        edge = c - 1 if step < 0 else c
        most = np.minimum(side[rules] // half, (g.a + g.b)[rules] // times)
        some = np.flatnonzero(near[edge] <= most)
        r, e, m = rules[some], edge[some], most[some]
        base = s.ids[e].astype(np.int64) * s.n
        if step < 0:
            low = np.searchsorted(s.key, base + e - m)
            count = s.rank[e] - low
        else:
            low = s.rank[e] + 1
            count = np.searchsorted(s.key, base + e + m, side="right") - low
        total = count.cumsum()
        edges = np.unique(np.r_[0, np.searchsorted(total, np.arange(SLICE, total[-1] if len(total) else 0, SLICE)) + 1, len(r)])
        for lo, hi in zip(edges[:-1], edges[1:]):
            n = count[lo:hi]
            of = np.repeat(np.arange(lo, hi), n)
            other = s.order[np.arange(n.sum()) - np.repeat(total[lo:hi] - n - (total[lo - 1] if lo else 0), n) + low[of]]
            q = np.abs(other - e[of])
            at = e[of] + 1 - 2 * q if step < 0 else e[of]
            fits = 2 * q <= side[r[of]]
            of, q, at = of[fits], q[fits], at[fits]
            same = s.equal(at, at + q, q)
            out.append((r[of[same]], q[same], at[same]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def _own_runs(s: Sequence, g: Grammar, least: int, times: int) -> tuple[np.ndarray, ...]:
    """``(rule, start from the rule's, length, period)`` of runs across boundaries, sorted by rule."""
    rule, q, at = _candidates(s, g, least, times)
    begin, end = g.at[rule], g.at[rule] + g.a[rule] + g.b[rule]
    start = at - s.extent(at, at + q, at - begin, ahead=False)
    stop = at + q + s.extent(at, at + q, end - q - at, ahead=True)
    c = g.at[rule] + g.a[rule]
    fits = (start < c) & (stop > c) & (stop - start >= np.maximum(least, times * q))
    rule, q, start, n = rule[fits], q[fits], (start - begin)[fits], (stop - start)[fits]
    order = np.lexsort((q, n, start, rule))
    rule, q, start, n = rule[order], q[order], start[order], n[order]
    new = np.r_[True, (rule[1:] != rule[:-1]) | (start[1:] != start[:-1]) | (n[1:] != n[:-1])] if len(rule) else np.empty(0, bool)
    return rule[new], start[new], n[new], q[new]  # of the periods of an interval the smallest


def _translate(g: Grammar, rule: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(rule, place)`` of every derivation of a rule that has runs of its own (``rule``, sorted)."""
    holds = np.zeros(g.words + g.made, bool)
    holds[g.words + rule] = True
    own = holds.copy()
    first = 0
    for left, right, *_ in g.parts:  # the rules of a round only use earlier ones
        here = slice(g.words + first, g.words + first + len(left))
        holds[here] |= holds[left] | holds[right]
        first += len(left)
    sym, at, got = g.roots, g.starts, []
    while True:
        keep = holds[sym]
        sym, at = sym[keep], at[keep]
        if not len(sym):
            break
        got.append((sym[own[sym]] - g.words, at[own[sym]]))
        r = sym - g.words
        sym, at = np.r_[g.left[r], g.right[r]], np.r_[at, at + g.a[r]]
    return tuple(np.concatenate(x) for x in zip(*got)) if got else (np.empty(0, np.int64),) * 2


def _merged(start: np.ndarray, n: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one period that share a period or more are one; of equal intervals the smallest period stays; by start, then period."""
    order = np.lexsort((start, q))
    start, end, q = start[order], (start + n)[order], q[order]
    wide = np.int64(end.max(initial=0) + 1)
    _, group = np.unique(q, return_inverse=True)
    far = np.maximum.accumulate(end + group * wide) - group * wide if len(q) else end
    new = np.r_[True, (q[1:] != q[:-1]) | (start[1:] > far[:-1] - q[1:])] if len(q) else np.empty(0, bool)
    at = np.flatnonzero(new)
    start, end, q = start[at], np.maximum.reduceat(end, at) if len(at) else end, q[at]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(q) else np.empty(0, bool)
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], (end - start)[order], q[order]


def find_runs(ids: np.ndarray, ends: np.ndarray, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of all runs in texts that lie one after the other and end at ``ends``, by start, then period."""
    s, g = Sequence(ids), Grammar(ids, ends)
    rule, start, n, q = _own_runs(s, g, least, times)
    derived, at = _translate(g, np.unique(rule))
    low, high = np.searchsorted(rule, derived), np.searchsorted(rule, derived, side="right")
    many = high - low
    which = np.arange(many.sum()) - np.repeat(many.cumsum() - many, many) + np.repeat(low, many)
    return _merged(np.repeat(at, many) + start[which], n[which], q[which])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, pa.Scalar, list[bytes]]]]:
    """``(id, words)`` of rows, about BATCH words at a time."""
    rows, held = [], 0
    for b in batches:
        for i, t in zip(b.column(0), b.column(1)):
            words = (t.as_py() or b"").split()  # at blanks and \x09 to \x0d
            rows.append((i, words))
            held += len(words)
            if held >= BATCH or len(rows) >= 20_000:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _run(least: int, times: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _batches(batches):
            size = np.array([len(w) for _, w in rows], np.int64)
            known: defaultdict = defaultdict()
            known.default_factory = known.__len__
            ids = np.fromiter(map(known.__getitem__, chain.from_iterable(w for _, w in rows)), np.int64, int(size.sum()))
            ends = size.cumsum()
            start, n, q = find_runs(ids, ends[size > 0], least, times) if len(ids) else (np.empty(0, np.int64),) * 3
            step = np.bincount(start + q, minlength=len(ids) + 1) - np.bincount(start + n, minlength=len(ids) + 1)
            gone = step.cumsum()[:-1] > 0
            of = np.searchsorted(ends, start, side="right")
            edges = np.searchsorted(of, np.arange(len(rows) + 1))
            dropped = np.r_[0, gone.cumsum()]
            begin, kept = ends - size, []
            for k, (_, words) in enumerate(rows):
                if dropped[ends[k]] > dropped[begin[k]]:
                    words = [words[x] for x in np.flatnonzero(~gone[begin[k] : ends[k]]).tolist()]
                kept.append(b" ".join(words))
            cols = [pa.array(x, pa.int64()) for x in (start - begin[of], n, q)]
            runs = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.StructArray.from_arrays(cols, names=["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([pa.array([i.as_py() for i, _ in rows], schema.field(0).type), pa.array(size), runs.cast(schema.field(2).type), pa.array(kept, pa.binary()).cast(pa.string())], schema=schema)

    return run


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_words, runs array<struct<start, length, period>>, collapsed)`` for every row.

    Words are what stands between blanks, tabs, line feeds and the like (``[^\\x20\\x09-\\x0D]+``), numbered from 0.  A
    run is a stretch of words with smallest period ``q`` and length ``max(least, times * q)`` or more, ``times`` at least 4, that no neighbouring
    word extends; runs come by start, then period.  ``collapsed`` holds the words outside all runs and the first ``q``
    of each run, joined by one blank; a word that any run drops is dropped.

    Null and empty texts, and those of white space only, have no words, no runs and an empty ``collapsed``.  Texts of any
    length are taken whole; repeated rows give a row each; ids may be null or of any type; no rows give none; other
    columns are ignored.  Nothing is shuffled: a row needs only itself.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias(id_col), F.col(text).cast("binary").alias("text"))
    out = T.StructType([src.schema[0]]).add("n_words", "long").add("runs", T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long"))).add("collapsed", "string")
    return src.mapInArrow(_run(least, times, to_arrow_schema(out)), out)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a tenth of the texts made periodic from some word on.

    ``h`` is the CRC-32 of the decimal id.  Where it ends in 0, word ``i`` from ``a`` on becomes word ``a + (i - a) % p``, with
    ``g = h / 10``, ``a = g % n``, ``p = 1 + (n - a) / (3 + g % 8)`` in whole quotients of the ``n`` words.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def made(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1)).cast("long")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(F.size(w) > 0, F.array_join(moved, " "))

    words = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    changed = F.element_at(F.transform(F.array(words), made), 1)  # the words are bound to a variable, so found once
    return docs.withColumn(text, F.when(h % 10 == 0, F.coalesce(changed, F.col(text))).otherwise(F.col(text)))


def op11_digests(docs: DataFrame) -> DataFrame:
    """The registered query: runs of planted and other texts, the longest run, and digests of runs and of collapsed texts."""
    found = periodic_runs(with_planted_runs(docs))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    out = found.select("doc_id", "runs", best.alias("best"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    milli = F.expr("(1000 * best.length) div -best.period")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"), milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
