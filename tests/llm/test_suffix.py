import hashlib
import random

import numpy as np
import pytest

from millrace.llm import suffix as S


def brute(docs):
    seen, out = set(), {}
    for i, t in sorted(docs):
        mark = bytearray(len(t))
        for a in range(len(t) - 99):
            if t[a : a + 100] in seen:
                mark[a : a + 100] = b"\1" * 100
            seen.add(t[a : a + 100])
        kept = bytes(c for c, x in zip(t, mark) if not x)
        out[i] = (len(t), sum(mark), sum(1 for i in range(len(t)) if mark[i] and not (i and mark[i - 1])), hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.op2_repeated_bytes(df).collect()}


@pytest.mark.parametrize("letters", [b"ab", b"abcdef"])
def test_two_stage_order_and_prefixes(letters):
    rnd = random.Random(2)
    for _ in range(10):
        base = bytes(rnd.choice(letters) for _ in range(rnd.randint(300, 1500)))
        parts = [base[:200], base[50:], base[:150] * 2]
        text = S.padded(parts)
        wanted = np.zeros(len(text), bool)
        wanted[rnd.sample(range(sum(map(len, parts))), 200)] = True
        order = S.two_stage(text, wanted)
        keys = [text.tobytes()[i : i + 100] for i in order]
        assert len(order) == 200 and keys == sorted(keys)
        for i, n in enumerate(S.common_prefixes(text, order).tolist()):
            assert n == (next((x for x in range(100) if keys[i][x] != keys[i - 1][x]), 100) if i else 0)


@pytest.mark.parametrize("piece", [130, 1 << 24])
@pytest.mark.parametrize("hot", [1000, 2])
def test_against_brute_force(spark, monkeypatch, hot, piece):
    monkeypatch.setattr(S, "PIECE", piece)
    monkeypatch.setattr(S, "HOT", hot)
    rnd = random.Random(5)
    p = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    make = lambda i: "".join(rnd.choice(["abc" * 50, p[:150], p[100:260], p, "x" * 300, "né" * 70, f"q{i}"]) + rnd.choice(["", "z"]) for _ in range(rnd.randint(0, 6)))
    docs = [(i, make(i)) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert result(df) == brute([(i, t.encode()) for i, t in docs])


def test_passage_in_every_document(spark, monkeypatch):
    """Far more segments of one anchor than are sorted together, with unlike surroundings, or alike in threes."""
    monkeypatch.setattr(S, "HOT", 5)
    rnd = random.Random(11)
    some = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage, around = some(180), [some(60) for _ in range(60)]
    docs = [(i, (some(50) if i % 2 else around[i // 3 % 60]) + passage + (some(70) if i % 5 else around[i // 3 % 60])) for i in range(240)]
    got = result(spark.createDataFrame(docs, "doc_id long, text string").repartition(6))
    assert got == brute([(i, t.encode()) for i, t in docs]) and sum(n > 0 for _, n, _, _ in got.values()) == 239


@pytest.mark.parametrize("hot", [3, 8])
def test_edges_of_a_common_passage(spark, monkeypatch, hot):
    """Surroundings that differ at every distance from the passage, and classes of equal windows larger than what is sorted together."""
    monkeypatch.setattr(S, "HOT", hot)
    rnd = random.Random(3)
    some = lambda n: "".join(rnd.choice("ab") for _ in range(n))
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(110))
    docs = [(i, some(90)[: rnd.randint(0, 90)] + passage[: rnd.choice([40, 70, 110])] + some(90)) for i in range(300)]
    steps = []
    monkeypatch.setattr(S, "written", lambda df, name, f=S.written: (steps.append((name, out := f(df, name))), out)[1])
    assert result(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)) == brute([(i, t.encode()) for i, t in docs])
    runs = [df.filter("bytes IS NOT NULL").count() for name, df in steps if name == "sorted"]
    rows = [df.count() for name, df in steps if name == "parted"]
    assert len(rows) > 1 and all(n <= 4 * before for before, n in zip(runs + rows, rows))


def test_parted_runs_meet_by_shared_bytes():
    """Rows are ranges of places, not windows: at most three a run at first; equal windows have equal keys at every width."""
    rnd = random.Random(4)
    some = lambda n: bytes(rnd.choice(b"abcdefgh ") for _ in range(n))
    passage = some(60)
    texts = [some(80) + passage + some(80) for _ in range(100)] + [b"x" * 300]
    text, start, n, _ = S.anchors(texts)
    runs = [(t, 0, a, k, texts[t][a : a + k + 99]) for t, a, k in zip(text.tolist(), start.tolist(), n.tolist())]
    batch = S._batch(S.SORTED, list(zip(*runs)))
    for width in S.STEPS:
        rows = [r for b in S._parted([batch], width) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert len(rows) <= sum(-(-k // width) + 1 for *_, k, _ in runs) and sum(r[5] for r in rows) == sum(n)
        keys = {}
        for key, _, _, _, _, k, body in rows:
            for x in range(k):
                assert keys.setdefault(body[x : x + 100], key) == key


def test_edges(spark):
    rnd = random.Random(1)
    long = "".join(rnd.choice("abcdef") for _ in range(60_000)) + "c" * 3000
    docs = [(5, long), (1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (6, "y" * 101), (9, long[:1000])]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n int")
    assert result(df) == brute([(i, (t or "").encode()) for i, t in docs])
    assert S.op2_repeated_bytes(df.limit(0)).count() == 0


def test_shared_and_null_ids(spark):
    rnd = random.Random(7)
    t = "".join(rnd.choice("abcdef") for _ in range(300))
    rows = S.op2_repeated_bytes(spark.createDataFrame([(1, t), (1, t), (2, t), (None, t[:150])], "doc_id long, text string")).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_removed) for r in rows)
    # The null id comes first; repeated rows are one document, of which the first 150 bytes come earlier.
    assert got == [(-1, 0), (1, 150), (1, 150), (2, 300)]
