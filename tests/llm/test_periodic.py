"""Periodic runs against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from millrace.llm import periodic as P

FOLDER = "/root/testdata/sf0.001"


def brute(words, least=6, times=4):
    """``[(start, length, period)]`` by comparing words ``q`` apart for every ``q``."""
    known, n = {}, len(words)
    x = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    found = {}
    for q in range(1, n // times + 1):
        same = np.r_[False, x[:-q] == x[q:], False]
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a + q >= max(least, times * q):
                found.setdefault((int(a), int(b - a + q)), q)  # smallest period first
    return sorted((s, n, q) for (s, n), q in found.items())


def digests(doc_id, text):
    """The contract's row, word by word."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def random_text(rng, n):
    """Words of a small vocabulary with stretches that repeat, nested and cut short."""
    out = []
    while len(out) < n:
        kind = rng.integers(4)
        part = rng.integers(0, int(rng.choice([2, 3, 50])), int(rng.integers(1, 9))).tolist()
        if kind == 0:
            out += part
        elif kind == 1:
            out += (part * int(rng.integers(2, 9)))[: int(rng.integers(1, 60))]
        elif kind == 2:
            out += (part * int(rng.integers(4, 7)) + part[:1]) * int(rng.integers(1, 6))
        elif out:
            at = int(rng.integers(len(out)))
            out += out[at : at + int(rng.integers(1, 80))]
    return [f"w{x}" for x in out[:n]]


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_batches(seed):
    rng = np.random.default_rng(seed)
    texts = [random_text(rng, int(rng.choice([1, 2, 5, 6, 7, 30, 200, 900]))) for _ in range(60)]
    texts += [["a"] * n for n in (1, 5, 6, 7, 64, 1000)] + [["a", "b"] * n for n in (3, 4, 77)] + [texts[0], texts[0]]
    known = {}
    ids = np.array([known.setdefault(w, len(known)) for t in texts for w in t], np.int64)
    ends = np.cumsum([len(t) for t in texts])
    start, n, q = P.find_runs(ids, ends)
    of = np.searchsorted(ends, start, side="right")
    got = [[] for _ in texts]
    for k, *r in zip(of.tolist(), (start - (ends - [len(t) for t in texts])[of]).tolist(), n.tolist(), q.tolist()):
        got[k].append(tuple(r))
    assert got == [brute(t) for t in texts]


def test_long_and_fibonacci_texts():
    a, b = [0], [0, 1]
    while len(b) < 5000:
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(4096)]
    for x in (b, thue, thue * 5, [7] * 20_000, list(range(3000)) * 5, [0] * 50 + list(range(1, 400)) * 6 + [0] * 50):
        assert list(zip(*(c.tolist() for c in P.find_runs(np.array(x), np.array([len(x)]))))) == brute(x)


def test_the_grammar_compresses(spark):
    """Repeated texts cost few symbols, and every text is derived from its symbol."""
    rng = np.random.default_rng(1)
    one = rng.integers(0, 40, 500)
    ids = np.concatenate([one] * 20 + [rng.integers(0, 40, 333)])
    ends = np.array([*range(500, 10_001, 500), 10_333])
    g = P.Grammar(ids, ends)
    assert g.made < 2500

    def derive(s):
        return [s] if s < g.words else derive(g.left[s - g.words]) + derive(g.right[s - g.words])

    assert [x for r in g.roots for x in derive(r)] == ids.tolist()
    for r in range(g.made):
        part = ids[g.at[r] : g.at[r] + g.a[r] + g.b[r]].tolist()
        assert derive(g.words + r) == part and len(derive(g.left[r])) == g.a[r]


def test_query_against_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: tuple(r) for r in P.op11_digests(docs).collect()}
    want = {r.doc_id: digests(r.doc_id, r.text) for r in docs.collect()}
    assert got == want and sum(r[1] > 0 for r in got.values()) > 15


def test_odd_rows(spark):
    ten = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a"), (5, "x " * 9), (5, "x " * 9), (6, "é é   é é é é"), (ten, None), (ten, " "), (ten, "a b c d e f g h i j k"), (7, "x\ty\nz " * 5_000 + "end"), (None, "q " * 6)]
    df = spark.createDataFrame([(t, "clash", i, 3) for i, t in rows], "text string, runs string, doc_id long, n_words int")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, P.op11_digests(df).collect()), key=key) == sorted([digests(i, t) for i, t in rows[:-1]] + [(None, *digests(1, "q " * 6)[1:])], key=key)
    assert P.op11_digests(df.limit(0)).count() == 0
    out = {r.doc_id: r for r in P.periodic_runs(df).collect()}
    assert out[5].collapsed == "x" and [tuple(x) for x in out[5].runs] == [(0, 9, 1)] and out[1].n_words == 0 and out[1].runs == [] and out[7].collapsed == "x y z end"
