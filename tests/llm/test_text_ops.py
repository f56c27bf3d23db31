"""Licences, preferences, decontamination, subwords."""

import random
import re
import textwrap
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from millrace.llm import decontaminate, licences, preference, subword
from millrace.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    c = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        c.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    text = lambda df: sorted(tuple(map(str, r)) for r in df[sorted(df.columns)].itertuples(index=False))
    assert text(QUERIES[name](spark, FOLDER).toPandas().astype(object)) == text(c.sql(ORACLE[name]).df().astype(object).where(lambda x: x.notna(), None))


def test_licence_variants(spark):
    body = licences.KNOWN[0][2]
    shouted = "MIT LICENCE\n\nCopyright (c) 2001 Some One\n  (c) Another\nAll rights reserved.\n\n" + body.upper().replace(" ", "\n ", 9).replace("SUBLICENSE", "SUB-LICENSE")
    rows = [(1, body), (2, shouted), (3, body + " More."), (4, None), (5, ""), (None, body), (1, body)]
    got = licences.scan(spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, license_id string")).collect()
    assert sorted((r.doc_id or 0, r.license_id or "") for r in got) == [(0, "MIT"), (1, "MIT"), (1, "MIT"), (2, "MIT"), (3, ""), (4, ""), (5, "")]
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("width", [50, 60, 72, 75, 80])
def test_licences_at_any_width(spark, width):
    rows = [(f"{i}", "\n".join(["Copyright (c) 2020 Some One", "Copyright 2001-2004 The Authors", "All rights reserved.", "", *textwrap.wrap(f"{title} {body}", width)])) for i, title, body in licences.KNOWN]
    rows += [(f"{i}", f"Copyright (c) 2020 Some One. {body}") for i, title, body in licences.KNOWN if i in ("MIT", "ISC", "BSD-3-Clause", "GPL-3.0-header")]
    rows += [(f"{i}", body.upper()) for i, _, body in licences.KNOWN]
    got = licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert [r.doc_id for r in got if r.doc_id != r.license_id] == []


def test_own_licence_collection(spark):
    own = licences.digests(spark.createDataFrame([("x-1", "You may do this.\nOrganisation"), ("x-0", "you may do this organization")], "license_id string, text string"))
    docs = spark.createDataFrame([(1, "(c) 1999 Me\n\nYOU MAY: do this; organisation!")], "doc_id long, text string")
    assert [r.license_id for r in licences.scan(docs, own).collect()] == ["x-0"]


def turns(*xs):
    return [(i, r, t) for i, (r, t) in enumerate(xs)]


def test_preference_edges(spark):
    u, a, b = ("user", "hi"), ("assistant", "yes é"), ("assistant", "no")
    rows = [(1, turns(u, a), turns(u, b)), (2, turns(u, a), turns(u, a)), (3, [], turns(u)), (4, None, None), (5, turns(u, a, u, a), turns(u, a)), (None, turns(a), turns(b))]
    kind = "array<struct<turn: bigint, role: string, text: string>>"
    got = {r.pair_id: r for r in preference.format_pairs(spark.createDataFrame(rows, f"pair_id long, chosen {kind}, rejected {kind}")).collect()}
    assert got[1].prompt == "<|user|>\nhi<|end|>\n" and got[1].n_prompt_turns == 1
    assert got[1].chosen == "<|assistant|>\nyes é<|end|>\n" and got[1].chosen_mask == "14:27"
    assert got[1].chosen[14:27] == "yes é<|end|>\n"
    assert (got[2].chosen, got[2].rejected, got[2].chosen_mask) == ("", "", "") and got[2].n_prompt_turns == 2
    assert got[3].prompt == "" and got[3].rejected_mask == "" and got[4].prompt == "" and got[5].rejected == "" and got[5].n_prompt_turns == 2
    assert got[None].n_prompt_turns == 0


def test_preference_null_turns(spark):
    kind = "array<struct<turn: bigint, role: string, text: string>>"
    rows = [(1, [(0, "user", "q"), (1, None, "a")], [(0, "user", "q"), (1, "assistant", "a")]), (2, [(0, "user", None)], [(0, "user", "x")]), (3, [None, (1, "assistant", None)], [(0, None, ""), (1, "assistant", "")])]
    got = {r.pair_id: r for r in preference.format_pairs(spark.createDataFrame(rows, f"pair_id long, chosen {kind}, rejected {kind}")).collect()}
    assert got[1].n_prompt_turns == 1 and got[1].chosen == "<||>\na<|end|>\n" and got[1].rejected == "<|assistant|>\na<|end|>\n"
    assert got[2].n_prompt_turns == 0 and got[2].rejected == "<|user|>\nx<|end|>\n" and got[3].n_prompt_turns == 2


def test_preference_pairs_of_odd_tables(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (20, 0, "assistant", "z"), (20, 0, "assistant", "z"), (None, 0, "user", "x"), (3, None, None, "y"), (4, 0, "user", "only"), (70, 5, "assistant", "w")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pairs = lambda df: {r.pair_id: r for r in preference.format_pairs(preference.neighbour_pairs(df)).collect()}
    got = pairs(d)
    assert set(got) == {1, 20, 70} and got[1].rejected == "<|assistant|>\nz<|end|>\n" and got[1].chosen == "<|assistant|>\n<|end|>\n"
    assert got[20].rejected.endswith("w<|end|>\n") and got[70].rejected == "<|assistant|>\n<|end|>\n"
    assert pairs(d.filter("conv_id < 5")) == {} and pairs(d.limit(0)) == {}


def brute_leaks(docs, items):
    """Best similarity of all windows of the item's size."""
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for i, it in items:
        w = words(it)
        k = min(5, len(w))
        if not w:
            continue
        want = Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1))
        for d, t in docs:
            x = words(t)
            for a in range(max(1, len(x) - len(w) + 1)):
                part = x[a : a + len(w)]
                have = Counter(tuple(part[j : j + k]) for j in range(len(part) - k + 1))
                both = sum((want & have).values())
                s = both / (sum(want.values()) + sum(have.values()) - both) if have else 0
                if s >= 0.8 and s > out.get((d, i), 0):
                    out[d, i] = s
    return out


def test_decontamination_against_brute_force(spark):
    rnd = random.Random(4)
    word = lambda: rnd.choice(["the", "of", "and"]) if rnd.random() < 0.3 else "".join(rnd.choice("abcdefgh") for _ in range(5))
    passage = lambda n: " ".join(word() for _ in range(n))
    items = [(i, passage(rnd.choice([3, 5, 12, 40, 90]))) for i in range(25)] + [(90, None), (91, ""), (92, "... !")]
    docs = []
    for d in range(120):
        w = passage(rnd.choice([0, 5, 60, 200])).split(" ")
        if d % 2:
            x = rnd.choice(items[:25])[1].split(" ")
            for _ in range(rnd.choice([0, 0, 1, 2])):
                x[rnd.randrange(len(x))] = word()
            at = rnd.randint(0, len(w))
            w = [*w[:at], *(y.upper() + "," if rnd.random() < 0.2 else y for y in x), *w[at:]]
        docs.append((d, " ".join(w)))
    docs += [(200, None), (201, "")]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contamination(df, bench).collect()}
    want = brute_leaks(docs, items)
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in got)
    left = {r.doc_id for r in decontaminate.drop_contaminated(df, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in got}
    assert decontaminate.contamination(df.limit(0), bench).count() == 0 and decontaminate.contamination(df, bench.limit(0)).count() == 0


def test_decontamination_finds_swapped_sentences(spark):
    """Items whose parts stand in another order have no shingle of their size's windows at its own offset."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(rnd.choice([40, 55, 90])))) for i in range(20)]
    docs = []
    for i, t in items:
        w = t.split(" ")
        half = len(w) // 2
        docs.append((i, " ".join([*(word() for _ in range(60)), *w[half:], *w[:half], *(word() for _ in range(i * 3))])))
        docs.append((100 + i, " ".join([*(word() for _ in range(i)), *w[half:], word(), word(), *w[:half]])))
        docs.append((200 + i, " ".join([*w[: len(w) // 3], *(word() for _ in range(30))])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    want = brute_leaks(docs, items)
    assert len(want) >= 20 and set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in got)


def test_decontamination_at_the_threshold(spark):
    """Pairs at exactly 0.8, the hardest there are: all of 600 are found."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    items, docs = [], []
    for i in range(600):
        m = rnd.choice([9, 18, 27, 45, 90])  # shingles of an item; a ninth of them differ
        w = [word() for _ in range(m + 4)]
        cut = m // 9
        other = [*(word() for _ in range(cut)), *w[cut:]]
        items.append((i, " ".join(w)))
        docs.append((i, " ".join(other)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.similarity for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect() if r.doc_id == r.item_id}
    assert len(got) == 600 and all(abs(s - 0.8) < 1e-9 for s in got.values())


def test_decontamination_null_and_shared_ids(spark):
    item = "one two three four five six seven"
    d = spark.createDataFrame([(None, f"x {item} y"), (1, item), (1, "else"), (1, item)], "doc_id long, text string")
    b = spark.createDataFrame([(7, item), (None, item), (7, item)], "item_id long, text string")
    rows = sorted((r.doc_id or 0, r.item_id or 0, r.start, r.similarity) for r in decontaminate.contamination(d, b).collect())
    assert rows == [(0, 0, 1, 1.0), (0, 7, 1, 1.0), (1, 0, 0, 1.0), (1, 7, 0, 1.0)]
    assert decontaminate.drop_contaminated(d, b).count() == 0


ODD = ["", " ", "  a  b ", "x\n\ty\x00z", "▁ literal ▁▁", "é漢字🙂 mixed", "word%%% WORD!! 12.5", "aaaa" * 3000, "it's <s> </s> <0x41>"]


def test_subword_without_dropout_is_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=subword.MODEL)
    enc = subword.encoder(subword.MODEL, 0.0, 1)
    texts = duckdb.sql(f"select text from '{FOLDER}/documents.parquet' limit 60").fetchall()
    for (t,) in texts + [(t,) for t in ODD if "▁" not in t]:
        assert np.frombuffer(enc([t], [1])[0], "<i4").tolist() == sp.encode(t)


def test_subword_round_trip_and_seeds(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(ODD)] + [(None, "null id", 0), (3, None, 0)], "doc_id long, text string, ids int")
    one, two = (subword.encode(docs, seed=s, dropout=0.3) for s in (1, 2))
    back = {r.doc_id: r.text for r in subword.decode(one.filter("doc_id != 3")).collect()}
    assert all(back[i] == t for i, t in enumerate(ODD) if i != 3)
    a, b = ({r.doc_id: r.ids for r in x.collect()} for x in (one, two))
    assert a != b and {r.doc_id: r.ids for r in subword.encode(docs, seed=1, dropout=0.3).collect()} == a
    assert all(r.lossless for r in subword.encode(docs, digest=True).collect())
    none = subword.encode(docs, dropout=0.0).collect()
    assert sum(len(x) for x in a.values()) > sum(len(r.ids) for r in none if r.doc_id != 3)
    assert subword.encode(docs.limit(0)).count() == 0


def plain_segments(p, chunk, key, rate):
    """Brute force: again and again, of all neighbouring parts that may merge and aren't skipped, those of lowest rank, then leftmost, merge."""
    cuts, limit = list(range(len(chunk) + 1)), int(rate * 2**64)
    skipped = lambda a, b: subword.draw(key ^ (a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F) & subword.MASK) < limit
    while found := [(r, a, m) for a, m, b in zip(cuts, cuts[1:], cuts[2:]) if (r := p.rank(chunk[a:b])) is not None and not skipped(a, b)]:
        cuts.remove(min(found)[2])
    out = []
    for a, b in zip(cuts, cuts[1:]):
        out += [p.ids(chunk[a:b])] if p.ids(chunk[a:b]) is not None else [p.bytes[c] for c in chunk[a:b].encode()]
    return np.array(out, "<i4").tobytes()


@pytest.mark.parametrize("rate", [0.1, 0.5])
def test_segments_against_brute_force(rate):
    p, enc = subword.load(subword.MODEL), subword.encoder(subword.MODEL, rate, 9)
    texts = [t for (t,) in duckdb.sql(f"select text from '{FOLDER}/documents.parquet' limit 40").fetchall()] + [t for t in ODD if len(t) < 1000] + ["internationalisationsmassnahmenkatalog " * 3, "ßéx🙂 é漢"]
    for doc, (t, got) in enumerate(zip(texts, enc(texts, list(range(len(texts)))))):
        parts = p.chunks(" " + t) if t else []
        assert got == b"".join(plain_segments(p, c, int(k), rate) for c, k in zip(parts, subword.occurrence_keys(doc, len(parts), 9)))


def test_every_occurrence_is_drawn_anew():
    """Segmentations of a word vary between documents and places, and equal those of the plain agenda with the same keys."""
    p, text = subword.load(subword.MODEL), " ".join(["international understanding"] * 50)
    enc = subword.encoder(subword.MODEL, 0.1, 7)
    parts, seen = p.chunks(" " + text), Counter()
    for doc in range(200):
        keys = subword.occurrence_keys(doc, len(parts), 7).tolist()
        got = [p.segment(c, 0.1, k) for c, k in zip(parts, keys)]
        assert enc([text], [doc]) == [b"".join(got)]
        seen.update((c.strip(), g) for c, g in zip(parts, got))
    assert all(sum(w == x for w, _ in seen) > 30 for x in ("international", "understanding"))
    held = subword.Chunks(p)
    held.segment([" international"], np.zeros(1, np.uint64), 0.0)
    tried = held.code.all[: held.code.used]  # draws of one occurrence are independent: none falls below the rate as often as that
    keys = np.concatenate([subword.occurrence_keys(doc, 100, 7) for doc in range(200)])
    low = subword.draws(keys[:, None] ^ tried[None, :]) < np.uint64(int(0.1 * 2**64))
    assert abs((~low.any(1)).mean() - 0.9 ** low.shape[1]) < 0.015 and abs(low.mean() - 0.1) < 0.003
    for rate in (0.3, 1.0):
        for t in ODD:
            parts = p.chunks(" " + t)
            assert subword.encoder(subword.MODEL, rate, 3)([t], [5])[0] == (b"".join(p.segment(c, rate, k) for c, k in zip(parts, subword.occurrence_keys(5, len(parts), 3).tolist())) if t else b"")


def test_memory_of_long_texts(monkeypatch):
    """The working set doesn't grow with the texts of a call: long ones are cut into chunks piece by piece, to the same ids."""
    enc = subword.encoder(subword.MODEL, 0.1, 7)
    texts = ["  international understanding, 12 \n of naïve development" * 3000] * 20
    enc(texts[:1], [0])
    tracemalloc.start()
    got = enc(texts, list(range(20)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * sum(map(len, got)) + 16e6
    p = subword.load(subword.MODEL)
    for t in [*ODD, *texts[:1]]:
        whole = p.chunks(" " + t)
        for size in (1, 7, 300) if len(t) < 5000 else (300,):
            monkeypatch.setattr(subword, "PIECE", size)
            assert [c for x in subword.text_pieces(" " + t) for c in p.chunks(x)] == whole
    monkeypatch.setattr(subword, "SLICE", 50)
    assert enc(texts[:2], [0, 1]) == got[:2]


def test_sliced_by_bytes():
    from millrace.llm.common import sliced

    texts = ["a" * 30, None, "", "b" * 100, "é" * 20, *["c"] * 9]
    b = pa.RecordBatch.from_arrays([pa.array(range(14)), pa.array(texts)], names=["id", "text"])
    got = [x.column(1).to_pylist() for x in sliced([b, b.slice(0, 0)], 6, 60)]
    assert sum(got, []) == texts and [len(x) for x in got] == [3, 1, 6, 4]


def test_skipped_merges_follow_the_rate():
    p = subword.load(subword.MODEL)
    words = ["information", "international", "understanding", "development"]
    whole = sum(len(p.segment(" " + w, 0.0, 1)) for w in words)
    some = sum(len(p.segment(" " + w, 0.1, k)) for w in words for k in range(200)) / 200
    every = sum(len(p.segment(" " + w, 1.0, 1)) for w in words)
    assert whole < some < every == sum(4 * (len(w) + 1) for w in words)


def licence_files():
    """``(text, licence)``: the same licences as they stand in files: commented out, under other titles, with notices of several lines."""
    out = []
    for i, title, body in licences.KNOWN:
        lines = textwrap.wrap(body, 72)
        notice = ["Copyright (c) 1999-2024 Some One, Some Two and", "    Some Three <three@example.org>,", "    The Authors", "All rights reserved."]
        for t in (None, title, *licences.TITLES.get(i, [])):
            plain = [*([t, ""] if t else []), *notice, "", *lines]
            out += [("\n".join(plain), i), ("/*\n" + "\n".join(f" * {x}" for x in plain) + "\n */\n", i), ("\n".join(f"# {x}" for x in plain), i), ("\n".join(f"// {x}" for x in plain) + "\n//\n// SPDX-License-Identifier: " + i, i)]
    out += [("Copyright (c) 2020 Me,\nYou.\n\nSome other text.", None), (licences.KNOWN[0][2] + "\n\nBut not on Sundays.", None), ("Copyright 2020 X\nNo use on Sundays.\n\n" + licences.KNOWN[0][2], None)]
    return out


def test_licences_in_files_and_in_sql(spark):
    """All are found, nothing else is, and the query's SQL finds the same."""
    import duckdb
    import pandas as pd

    rows = [(n, t) for n, (t, _) in enumerate(licence_files())]
    want = {n: i for n, (_, i) in enumerate(licence_files())}
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.license_id for r in got} == want and sum(i is not None for i in want.values()) > 100
    db = duckdb.connect()
    db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    assert sorted((r.doc_id, r.digest, r.license_id) for r in got if r.license_id) == sorted(x for x in db.sql(f"select doc_id, digest, license_id from ({licences.oracle()}) where license_id is not null").fetchall())


def test_long_lines_of_marks(spark):
    """Very long texts of comment marks, or of lines that end with commas, are normalised, too."""
    rows = [(1, "# " * 200_000), (2, "copyright a,\n" * 100_000), (3, "\n" + "#" * 300_000 + "\nMIT"), (4, "x, and\n" * 200_000)]
    assert [r.license_id for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [None] * 4
