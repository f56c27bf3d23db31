import random
import re
from collections import Counter

import pytest
import xxhash

from millrace.llm import simhash as S


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > n)


def linked(fp, radius=4):
    ids, root = list(fp), {i: i for i in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fp[a] ^ fp[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    groups = {}
    for i in ids:
        groups.setdefault(find(i), []).append(i)
    return {i: min(g) for g in groups.values() for i in g}


def texts(n, seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 7)))
    out = []
    for i in range(n):
        if out and rnd.random() < 0.6:
            w = rnd.choice(out).split(" ")
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                w[rnd.randrange(len(w))] = word()
            out.append(" ".join(w))
        else:
            out.append(" ".join(word() for _ in range(rnd.choice([1, 2, 5, 40, 150]))))
    return out


@pytest.mark.parametrize("least", [256, 2])
def test_against_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(S, "LEAST", least)
    docs = [(i, t) for i, t in enumerate([*texts(220), "", None, " \t", "A b\x0bC d e", "é É A", "a"])]
    rows = S.op3_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    fp = {i: plain(t) for i, t in docs}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in fp.items()}
    assert {r.doc_id: r.component_id for r in rows} == linked(fp)


def test_block_tables_guarantee_the_radius():
    rnd = random.Random(3)
    for radius, n in ((4, 10), (4, 10**6), (6, 100), (2, 10**9)):
        masks = S.plan_blocks(n, radius)
        for _ in range(200):
            diff = sum(1 << b for b in rnd.sample(range(64), radius))
            assert any(diff & m == 0 for m in masks)


def test_chain_links_through(spark):
    from millrace.llm.components import components

    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_null_and_repeated_ids(spark):
    d = spark.createDataFrame([(None, "a b c d e", 1), (3, "a b c d e", 1), (3, "a b c d e", 1), (None, "zz yy", 1)], "doc_id long, text string, lanes int")
    rows = S.op3_near_duplicates(d).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (-1, 3), (3, 3), (3, 3)]
    kept = S.keep_one(d)
    assert kept.columns == d.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3]
    assert S.op3_near_duplicates(d.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    """Near copies of similarity 0.9 and more go, unrelated texts stay."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    docs, copies = [], []
    for i in range(60):
        w = [word() for _ in range(rnd.choice([40, 150, 600]))]
        docs.append((i, " ".join(w)))
        for k in range(2):
            v = list(w)
            for _ in range(len(w) // 100):  # five shingles each: similarity 0.9
                v[rnd.randrange(len(v))] = word()
            copies.append((1000 + 2 * i + k, " ".join(v)))
    left = {r.doc_id for r in S.keep_one(spark.createDataFrame(docs + copies, "doc_id long, text string")).collect()}
    assert {i for i, _ in docs} <= left
    assert len(left) - len(docs) <= 0.05 * len(copies)


def jaccard(a, b, k=5):
    a, b = (Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for w in (a, b))
    return sum((a & b).values()) / sum((a | b).values())


@pytest.mark.parametrize("first", [S.FIRST, 1])
def test_copies_at_the_similarity_go(spark, monkeypatch, first):
    """At exactly 0.8 every copy goes, just below it every one stays; the tables don't depend on the number of rows."""
    monkeypatch.setattr(S, "FIRST", first)
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    docs, gone = [], set()
    for i in range(300):
        w = [word() for _ in range(94)]  # 90 shingles
        at = 2 if i % 2 else 3
        v = [word() if at <= j <= at + 5 or j == 50 and i % 2 == 0 else x for j, x in enumerate(w)]
        v = v[:90] if i % 3 else v
        docs += [(i, " ".join(w)), (1000 + i, " ".join(v))]
        gone |= {1000 + i} if jaccard(w, v) >= 0.8 else set()
    for i in range(300, 500):
        w = [word() for _ in range(94)]  # ten shingles differ: 80 of 100
        docs += [(i, " ".join(w)), (1000 + i, " ".join([*w[:4], word(), *w[5:60], word(), *w[61:]]))]
        assert abs(jaccard(docs[-2][1].split(), docs[-1][1].split()) - 0.8) < 1e-9
        gone.add(1000 + i)
    left = {r.doc_id for r in S.keep_one(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert left == {i for i, _ in docs} - gone


def test_rows_are_decided_by_id_and_text(spark):
    """Rows that share an id, or have none, are no copies of each other; the unique text never goes for the copy's."""
    one, two, three = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "seven eight nine ten eleven twelve")
    rows = [(None, one), (3, one), (None, two), (None, three), (None, three), (7, one), (7, "red green blue white black pink")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        kept = S.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(3, one), (0, two), (0, three), (7, "red green blue white black pink")])


def test_fingerprints_find_the_near_copies_of_the_pipeline(spark, monkeypatch):
    rng = random.Random(5)
    long = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(900)) for _ in range(30)]
    docs = [(i, t) for i, t in enumerate(long)] + [(100 + i, t + " end") for i, t in enumerate(long)]
    prints = [S.fingerprint(t, 5)[0] for _, t in docs]
    close = [i for i in range(30) if (prints[i] ^ prints[30 + i]).bit_count() <= S.RADIUS]
    assert len(close) > 20
    monkeypatch.setattr(S, "TABLES", 0)
    monkeypatch.setattr(S, "FIRST", 0)  # no min-hash tables: what is found is found by fingerprints
    left = {r.doc_id for r in S.keep_one(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert left >= set(range(30)) and not left & {100 + i for i in close}
