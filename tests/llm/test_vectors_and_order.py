"""Neighbours, resampling, training order, pipeline."""

import base64
import math
import re
from collections import Counter

import numpy as np
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from millrace.llm import neighbours, order, resample

FOLDER = "/root/testdata/sf0.001"


def exact(rows, every, k):
    """Per query row: its best other rows of the same length, as ``(query id, [(id, score)])``."""
    x, out = [(i, np.array(v, float)) for i, v in rows], []
    for n, (q, v) in enumerate(x):
        if q % every == 0:
            score = [(i, float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w)))) for m, (i, w) in enumerate(x) if m != n and len(v) == len(w)]
            out.append((q, sorted(score, key=lambda s: (-round(s[1], 12), s[0]))[:k]))
    return out


def results(df):
    """``(query id, [(id, score)])`` for ids that one row has."""
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(got[r.query_id]) == r.rank
    return got


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall(spark, folder):
    v = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    want = dict(exact([(r.vec_id, r.embedding) for r in v.collect()], 50, 5))
    got = results(neighbours.nearest(v))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    assert set(got) == set(want) and hits >= 0.9 * 5 * len(want)
    assert all(math.isclose(s, dict(want[q]).get(i, s), abs_tol=1e-12) for q, g in got.items() for i, s in g)


@pytest.mark.parametrize("block", [2048, 4])
def test_copies_ties_and_bad_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 0.0, 1.0]) for i in range(0, 120)] + [(i, rng.normal(size=4).round(3).tolist()) for i in range(120, 160)]
    rows += [(50, [1.0, 2.0, 0.0, 1.0]), (100, [3.0, -1.0, 2.0, 0.5]), (161, [3.0, -1.0, 2.0, 0.5]), (162, [6.0, -2.0, 4.0, 1.0])]  # shared ids, and a direction twice
    rows += [(1000, [1.0, 2.0, 3.0]), (1001, [1.0, 2.0, 3.1]), (1002, [-1.0, -2.0, -3.0]), (1050, [1.0])]  # other lengths
    bad = [(900, None), (950, [0.0] * 4), (901, [1.0, None, 0.0, 0.0]), (902, [float("nan"), 0.0, 0.0, 1.0]), (903, [float("inf"), 0.0, 0.0, 1.0]), (None, [1.0, 0.0, 0.0, 0.0]), (904, [])]
    d = spark.createDataFrame([(i, v, 7) for i, v in rows + bad], "vec_id long, embedding array<float>, rank int")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(d, recall=1.0).collect())
    want = exact([(i, np.array(v, np.float32)) for i, v in rows], 50, 5)
    assert got == sorted((q, n, i) for q, w in want for n, (i, _) in enumerate(w, 1))
    assert neighbours.nearest(d.limit(0)).count() == 0
    assert neighbours.nearest(d.filter("vec_id = 1050")).count() == 0
    assert neighbours.nearest(d.filter("vec_id in (51, 1000, 1001, 1002, 0)")).count() == 3


def test_few_candidates_all_come(spark):
    d = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, -1.0]), (4, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [i for i, _ in results(neighbours.nearest(d))[0]] == [4, 2, 3, 1]
    assert [i for i, _ in results(neighbours.nearest(d.filter("vec_id < 2")))[0]] == [1]


def test_cutoff_is_exact(spark):
    rng = np.random.default_rng(3)
    keys = [*rng.normal(size=500).tolist(), *[0.25] * 300, *(rng.normal(size=200) * 1e-9).tolist()]
    d = spark.createDataFrame([(float(x),) for x in keys], "key double").repartition(3).cache()
    for k in (1, 7, 350, 600, 999):
        assert resample.cutoff(d, k) == sorted(keys, reverse=True)[k - 1]
    assert resample.cutoff(d, 1000) == -math.inf and resample.cutoff(d, 0) == math.inf


def test_gumbel_top_k_draws_by_weight(spark):
    d = spark.range(20000).withColumn("g", resample.gumbel("id", 3) + F.when(F.col("id") % 2 == 0, math.log(3.0)).otherwise(0.0))
    top = d.orderBy(F.desc("g")).limit(1000).filter("id % 2 = 0").count()
    assert 700 < top < 800  # three in four


def test_inclusion_follows_the_weights(spark):
    """Over many seeds, each document is drawn as often as successive draws in proportion to the exact weights give."""
    weight, k, seeds = {1: 8.0, 2: 4.0, 3: 2.0, 4: 1.0, 5: 0.5, 6: 0.1}, 3, 4000

    def chance(left, n):
        out = dict.fromkeys(weight, 0.0)
        for i in left if n else ():
            p = weight[i] / sum(weight[j] for j in left)
            for j, q in chance([x for x in left if x != i], n - 1).items():
                out[j] += p * (q + (j == i))
        return out

    want = chance(list(weight), k)
    d = spark.createDataFrame([(i, math.log(w)) for i, w in weight.items()], "doc_id long, w double").withColumn("seed", F.explode(F.sequence(F.lit(1), F.lit(seeds))))
    d = d.withColumn("key", F.col("w") + resample.gumbel("doc_id", F.col("seed")))
    drawn = d.groupBy("seed").agg(F.slice(F.sort_array(F.collect_list(F.struct("key", "doc_id")), asc=False), 1, k).alias("x")).select(F.explode("x.doc_id").alias("i")).groupBy("i").count().collect()
    assert all(abs(r["count"] / seeds - want[r["i"]]) < 0.03 for r in drawn)


def test_scores_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    marks, mask = resample.labelled(labels), (1 << 64) - 1
    counts, texts = {x: Counter() for x in ("raw", "target", "clean", "toxic")}, {r.doc_id: r.text for r in docs.collect()}

    def grams(text):
        h = [xxhash.xxh64_intdigest(w.encode(), 3) for w in re.findall(r"\w+|[^\w\s]+", text.lower())]
        pairs = [a * 0x9E3779B97F4A7C15 + b & mask for a, b in zip(h, h[1:])]
        return [x % 65536 for x in h], [(x >> 24) % 65536 + 65536 for x in h], [((x ^ x >> 31) * 0xBF58476D1CE4E5B9 & mask) >> 16 & 65535 for x in pairs]

    found = {i: grams(t or "") for i, t in texts.items()}
    for i, (one, other, two) in found.items():
        good, bad = marks.get(i, (False, False))
        counts["raw"].update(one + two)
        counts["target"].update(one + two if good else [])
        counts["clean"].update(set(one + two + other) if good else [])
        counts["toxic"].update(set(one + two + other) if bad and not good else [])
    raw, target, clean, toxic = (counts[x] for x in ("raw", "target", "clean", "toxic"))
    share = toxic.total() / (toxic.total() + clean.total())
    ratio = lambda g: math.log((target[g] + 1) / (target.total() + 65536)) - math.log((raw[g] + 1) / (raw.total() + 65536))
    bad = lambda g: math.log((toxic[g] + 5) / (share * (toxic[g] + clean[g]) + 5))
    for r in resample.score(docs, resample.fit(docs, marks)).collect():
        one, other, two = found[r.doc_id]
        assert r.n_grams == len(one + two) and math.isclose(r.log_ratio, sum(map(ratio, one + two)), abs_tol=1e-6)
        assert math.isclose(r.toxic, max([0.0, *map(min, map(bad, one), map(bad, other))]), abs_tol=1e-9)


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    kept = {r.doc_id for r in resample.resample(docs, seen).collect()}
    share = lambda cond: (lambda ids: sum(i in kept for i in ids) / len(ids))([r.doc_id for r in held.filter(cond).collect()])
    assert share("quality = 1 AND toxic = 0") > 0.98 and share("quality = 0") < 0.15
    foul = docs.join(held.filter("toxic = 1"), "doc_id").filter(r"lower(text) rlike '\\b(idiot|trash|scum|moron|stupid|pathetic|loser|clown|worthless|disgusting)\\b'")
    assert foul.count() > 50 and sum(r.doc_id in kept for r in foul.collect()) < 0.3 * foul.count()


def test_resampling_edges(spark):
    docs = spark.createDataFrame([(1, "good words here", 0), (2, None, 0), (3, "", 0), (None, "good", 0), (1, "good words here", 0), (4, "%%% ***", 0)], "doc_id long, text string, key int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, None), (4, 0, 0), (None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    assert resample.resample(docs, labels, k=100).count() == 6
    assert resample.resample(docs, labels, k=0).count() == 0
    assert resample.resample(docs, labels.limit(0)).count() == 6
    assert resample.resample(docs.limit(0), labels).count() == 0
    assert resample.keep_worthy(docs, labels).columns == docs.columns


@pytest.mark.parametrize("n", [1, 2, 3, 5, 1000, 4097])
def test_feistel_is_a_permutation(n):
    x = order.feistel(np.arange(n), n, 11)
    assert sorted(x.tolist()) == list(range(n))
    assert n < 100 or (x != order.feistel(np.arange(n), n, 12)).mean() > 0.9


def stream(texts):
    with open(order.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("x", pat_str=order.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [i for t in texts for i in [*enc.encode_ordinary(t or ""), order.END_OF_TEXT]]


def test_shards_hold_the_permuted_stream(spark, tmp_path):
    texts = [("it's  a\n\n b ²½ Ⅷ x_y 12.5\t z ", 1), (None, 2), ("", 3), ("word " * 3000, None), ("tail", 5), ("a\n b  c", 5), ("\n x", 6)]
    spark.createDataFrame([(t, i, 0) for t, i in texts], "text string, doc_id long, row int").coalesce(1).write.parquet(f"{tmp_path}/in")
    rows = {}
    for name, size in (("a", "128m"), ("b", "200")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = order.materialise(spark.read.parquet(f"{tmp_path}/in"), length=16, rows=50, out=f"{tmp_path}/{name}").collect()
        rows[name] = sorted(map(tuple, got))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows["a"] == rows["b"]
    want = stream(t for t, _ in texts)
    n = -(-len(want) // 16)
    want += [order.END_OF_TEXT] * (n * 16 - len(want))
    assert sorted(r[0] for r in rows["a"]) == sorted(r[1] for r in rows["a"]) == list(range(n))
    read = list(order.read_slots(f"{tmp_path}/a", 0, 10**6, 16, 50))
    assert len(read) == n
    for slot, sequence, shard, _, _ in rows["a"]:
        assert shard == slot // 50 and read[slot].tolist() == want[sequence * 16 : sequence * 16 + 16]
    again = list(order.read_slots(f"{tmp_path}/a", 47, 9, 16, 50))
    assert [x.tolist() for x in again] == [x.tolist() for x in read[47:56]]
    assert not list((tmp_path / "a").glob("*.part"))


def test_long_white_space_is_split_alike():
    own, table = order._tokenizer(order.RANKS), {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(order.RANKS, "rb"))}
    exact = tiktoken.Encoding("t", pat_str=order.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    gaps = [" " * 1500, "\n" * 1200 + " ", "\t \u3000" * 500, " " * 999, "\x1c" * 1500, " " * 1200 + "\n"]
    texts = [f"{a}{g}{b}" for g in gaps for a in ("", "a", "don't", "!") for b in ("", "b", "7", "!?", "'s")] + ["a".join(gaps)]
    assert [own(t) for t in texts] == [exact(t) for t in texts]
    assert len(own("a" + " " * 3_000_000 + "b")) > 1


def test_order_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/in")
    assert order.materialise(spark.read.schema("doc_id long, text string").parquet(f"{tmp_path}/in"), out=f"{tmp_path}/o").count() == 0


def test_pipeline(spark):
    import corpus_pipeline as C

    from millrace.llm import pii, subword

    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "encoding"]
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    before = docs
    for name, stage in C.STAGES[:-1]:
        after = stage(spark, before, folder)
        assert after.columns == docs.columns
        after = spark.createDataFrame(after.collect(), docs.schema)
        assert after.count() <= before.count()
        if name == "personal_data":
            assert not any(pii.base_spans(r.text) for r in after.collect()) and all(r.n_chars == len(r.text) for r in after.collect())
        before = after
    left = {r.doc_id: r.text for r in before.collect()}
    assert not any(labels[i].quality == 0 for i in left if i in labels)
    out = C.run(spark, folder)
    assert {r.doc_id for r in out.collect()} == set(left)
    assert {r.doc_id: r.text for r in subword.decode(out).collect()} == left


@pytest.mark.parametrize("kind", ["array<double>", "array<float>"])
def test_extreme_components(spark, kind):
    """Tiny, huge and denormal components neither crash nor lose their cosine."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 6))
    sizes = [1e-200, 1e200, 1e300, 5e-310, 1e-300, 1.0] if kind == "array<double>" else [1e-30, 1e30, 1e38, 1e-37, 1.0]
    rows = [(i, (v * sizes[i % len(sizes)]).tolist()) for i, v in enumerate(base)] + [(50, [5e-324 if kind == "array<double>" else 2e-45] + [0.0] * 5), (51, [1e308 if kind == "array<double>" else 3e38] * 6)]
    got = results(neighbours.nearest(spark.createDataFrame(rows, f"vec_id long, embedding {kind}"), recall=1.0))
    unit = {i: (u := np.array(v) / max(map(abs, v))) / np.linalg.norm(u) for i, v in rows}
    for q, found in got.items():
        want = sorted(((float(unit[q] @ w), i) for i, w in unit.items() if i != q), key=lambda x: (-x[0], x[1]))[:5]
        assert [i for i, _ in found] == [i for _, i in want] and all(math.isclose(s, w, abs_tol=1e-5) for (_, s), (w, _) in zip(found, want))


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_the_filter_keeps_clean_documents(spark, folder):
    """Of documents labelled good 99 of 100 stay, of bad ones at most 8 (few labels) or 4 of 100; repeated runs agree."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{folder}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in resample.keep_worthy(docs, labels).select("doc_id").collect()}
    marks = [(r.doc_id in kept, r.quality, r.toxic or 0) for r in labels.collect()]
    share = lambda q: np.mean([k for k, quality, toxic in marks if quality == q and not (q and toxic)])
    assert share(1) >= 0.99 and share(0) <= (0.08 if folder == "sf0.01" else 0.04)
