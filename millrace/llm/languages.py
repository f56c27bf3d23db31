"""Languages of texts as mixtures: each word has a likelihood under each language, EM finds the proportions.

A language is a model of the next byte of a lower-case word given the three before, interpolated with shorter contexts.
A document is a mixture of languages that draw its words; expectation-maximisation finds the proportions, and of the sets of
its likeliest languages the one of largest likelihood less a penalty for each language stays.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.common import ship

#: Words looked at together, about; a longer text is taken alone.
BATCH = 150_000
#: Counts of four and three bytes, and of three as a context, are hashed to so many cells; shorter ones are exact.
CELLS = 1 << 17
SIZES = (256, 256, 65536, 65536, CELLS, CELLS, CELLS)
AT = np.r_[0, np.cumsum(SIZES)]
#: Counts that a shorter context is worth.
BACK = 4.0
#: Words that the languages' shares in the training documents are worth in a document's mixture.
PRIOR = 1.0
#: A word is at most so many times likelier under one language than under another: names and foreign words are in any text.
TRUST = 400.0
#: Languages of a task whose counts are held at a time.
HELD = 16
#: ASCII capitals become small, other ASCII characters than letters become blanks.
FOLD = bytes((c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32) for c in range(256))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """``(id, other, words)`` of rows ``(id, other, text)``, about BATCH words at a time."""
    rows, held = [], 0
    for b in batches:
        for i, o, t in zip(*b.columns):
            words = (t.as_py() or b"").translate(FOLD).split()
            rows.append((i.as_py(), o.as_py(), words))
            held += len(words)
            if held >= BATCH or len(rows) >= 20_000:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _numbered(rows: list[tuple]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """``(different words, number of each word in order, words of each row)``."""
    known: defaultdict = defaultdict()
    known.default_factory = known.__len__
    size = np.array([len(r[2]) for r in rows], np.int64)
    ids = np.fromiter(map(known.__getitem__, chain.from_iterable(r[2] for r in rows)), np.int64, int(size.sum()))
    return list(known), ids, size


def cells(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(7 x bytes places in the counts, number of the word of each byte)``; a word's bytes are its own and a blank at its end.

    The rows are: byte, byte as a context, two bytes, two as a context, three, three as a context, four.
    """
    text = np.frombuffer(b"".join(b"\0\0 " + w + b" " for w in words), np.uint8).astype(np.uint64)
    size = np.array([len(w) + 4 for w in words], np.int64)
    begin = size.cumsum() - size
    own = np.ones(len(text), bool)
    own[(begin[:, None] + np.arange(3)).reshape(-1)] = False
    at = np.flatnonzero(own)
    four = text[at - 3] << 24 | text[at - 2] << 16 | text[at - 1] << 8 | text[at]
    past = four >> 8
    mixed = lambda x, k: (x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(47)
    rows = [four & 0xFF, past & 0xFF, four & 0xFFFF, past & 0xFFFF, mixed(four & 0xFFFFFF, 1), mixed(past & 0xFFFFFF, 2), mixed(four, 3)]
    return np.stack(rows).astype(np.int64) + AT[:-1, None], np.repeat(np.arange(len(words)), size - 3)


@dataclass(frozen=True)
class Model:
    """Languages by name, their shares in the training documents, and their counts."""

    names: list[str]
    prior: np.ndarray
    counts: np.ndarray

    def likelihood(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihood of each word under each language."""
        place, of = cells(words)
        total = self.counts[:, : SIZES[0]].sum(1)
        out = np.empty((len(words), len(self.names)))
        for n, c in enumerate(self.counts):
            one, x1, two, x2, three, x3, four = (c[p] for p in place)
            p = (one + 0.5) / (total[n] + 128)
            for seen, context in ((two, x1), (three, x2), (four, x3)):
                p = (seen + BACK * p) / (context + BACK)
            out[:, n] = np.bincount(of, np.log(p), minlength=len(words))
        return out


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Counts over all documents whose language isn't null, a word once a document, so that what one repeats doesn't bend the model; tasks add up theirs, the driver gets one row per language and cell used."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, c in held.items():
                some = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some), pa.array(c[some])], names=["lang", "cell", "n"])
            held.clear()

        for rows in _batches(batches):
            words, ids, size = _numbered(rows)
            place, of = cells(words) if words else (np.empty((7, 0), np.int64), np.empty(0, np.int64))
            names = sorted({r[1] for r in rows})
            code = np.array([names.index(r[1]) for r in rows])
            once = np.unique(np.repeat(np.arange(len(rows)), size) * len(words) + ids)
            often = np.bincount(code[once // len(words)] * len(words) + once % len(words), minlength=len(names) * len(words)).reshape(len(names), -1) if words else None
            for n, name in enumerate(names):
                if len(held) >= HELD and name not in held:
                    yield from out()
                c = held.setdefault(name, np.zeros(AT[-1] + 1, np.int64))
                c[-1] += (code == n).sum()  # documents
                if len(words):
                    for p in place:
                        c += np.bincount(p, often[n][of], minlength=len(c)).astype(np.int64)
        yield from out()

    src = docs.filter(F.col(lang).isNotNull()).select(F.lit(0).alias("id"), F.col(lang).cast("string").alias("lang"), F.lower(text).cast("binary").alias("text"))
    got = src.mapInArrow(run, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(got.column("lang").unique().to_pylist()))
    counts = np.zeros((len(names), AT[-1] + 1))
    if names:
        code = pa.compute.index_in(got.column("lang"), pa.array(names)).to_numpy()
        counts[code, got.column("cell").to_numpy()] = got.column("n").to_numpy()
    prior = counts[:, -1] / max(1.0, counts[:, -1].sum())
    return Model(names, prior, counts[:, :-1].astype(np.float32))


def mixture(p: np.ndarray, n: np.ndarray, doc: np.ndarray, allowed: np.ndarray, prior: np.ndarray, rounds: int = 60, close: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """EM for all documents at once: ``(shares, log-likelihood)`` of mixtures of the ``allowed`` languages.

    ``p``: likelihood of a word of a document under each language, ``n`` how often it occurs, ``doc`` whose it is, ascending, every
    document at least once.
    """
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    start = (prior + 1e-9) * allowed
    share = start = start / start.sum(1, keepdims=True)
    live, out, ll = np.arange(len(allowed)), share.copy(), np.zeros(len(allowed))
    for k in range(rounds):
        r = share[doc] * p
        s = r.sum(1)
        gain = np.add.reduceat(r * (n / s)[:, None], first) + PRIOR * start[live]
        new = gain / gain.sum(1, keepdims=True)
        ll[live] = np.add.reduceat(n * np.log(s), first)
        out[live] = new
        moved = np.abs(new - share).max(1) >= close
        share = new
        if not moved.any():
            break
        if moved.mean() < 0.7:  # documents that have settled leave
            keep = moved[doc]
            number = np.cumsum(moved) - 1
            p, n, doc, live, share = p[keep], n[keep], number[doc[keep]], live[moved], share[moved]
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    return out, ll


def choose(p: np.ndarray, n: np.ndarray, doc: np.ndarray, prior: np.ndarray, strength: float, most: int) -> np.ndarray:
    """Shares of each document's languages, zero for those outside the chosen set.

    Sets are the ``k`` languages of largest share in the mixture of all, ``k`` up to ``most``; one of ``k`` has the penalty ``strength * k / 2 * log(words)``.
    """
    docs, langs = int(doc[-1]) + 1, p.shape[1]
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    words = np.add.reduceat(n, first)
    full, bound = mixture(p, n, doc, np.ones((docs, langs), bool), prior)
    alone = np.add.reduceat(n[:, None] * np.log(p), first) + np.log(prior + 1e-9)
    place = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    best = alone.argmax(1)
    share = np.zeros((docs, langs))
    share[np.arange(docs), best] = 1
    price = strength * np.log(words + 1) / 2
    value = alone.max(1) - price
    for k in range(2, min(most, langs) + 1):
        some = bound - k * price > value  # no mixture is likelier than that of all
        if not some.any():
            break
        keep, number = some[doc], np.cumsum(some) - 1
        got, ll = mixture(p[keep], n[keep], number[doc[keep]], place[some] < k, prior)
        at = np.flatnonzero(some)
        better = ll - k * price[at] > value[at]
        value[at[better]] = (ll - k * price[at])[better]
        share[at[better]] = got[better]
    return share


def identify(docs: DataFrame, model: Model, strength: float = 1.0, most: int = 4, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, lang_pred, score, langs array<struct<lang, share>>)`` for every row, whole texts.

    ``langs`` is the chosen set of at most ``most`` languages, largest share first (ties by name); ``lang_pred`` is the first of
    them and ``score`` its share.  Null texts, texts without a letter, and all texts where no language was learned, are
    ``und`` with score 0 and no languages.  Texts of any length count whole; repeated rows give a row each; ids may be null; no
    rows give none; other columns are ignored.  Nothing is shuffled.
    """
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)  # the number of languages times 2 MB
    kind = T.ArrayType(T.StructType().add("lang", "string").add("share", "double"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        for rows in _batches(batches):
            words, ids, size = _numbered(rows)
            use = np.array([bool(r[1]) for r in rows]) & (size > 0)
            found: list[list[dict]] = [[] for _ in rows]
            if m.names and use.any():
                doc = np.repeat(np.arange(len(rows)), size)
                keep = use[doc]
                pair, n = np.unique(doc[keep] * len(words) + ids[keep], return_counts=True)
                lk = m.likelihood(words)
                p = np.maximum(np.exp(lk - lk.max(1, keepdims=True)), 1 / TRUST)
                number = np.cumsum(use) - 1
                share = choose(p[pair % len(words)], n.astype(float), number[pair // len(words)], m.prior, strength, most)
                order = np.argsort(-share, axis=1, kind="stable")
                for k, s, o in zip(np.flatnonzero(use).tolist(), share.tolist(), order.tolist()):
                    found[k] = [{"lang": m.names[x], "share": min(1.0, s[x])} for x in o if s[x] > 0]
            best = [f[0] if f else {"lang": "und", "share": 0.0} for f in found]
            cols = [[r[0] for r in rows], [b["lang"] for b in best], [b["share"] for b in best], found]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    src = docs.select(F.col(id_col).alias(id_col), letter.alias("letter"), F.lower(text).cast("binary").alias("text"))
    out = T.StructType([src.schema[0]]).add("lang_pred", "string").add("score", "double").add("langs", kind)
    schema = to_arrow_schema(out)
    return src.mapInArrow(run, out)


def fold_of(id_col: str = "doc_id") -> Column:
    """CRC-32 of the decimal id, modulo 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def op13_predict(docs: DataFrame) -> DataFrame:
    """The registered query: languages are learned from the documents outside fold 0 (a null id is in no fold), all are predicted."""
    model = fit(docs.filter(fold_of() != 0))
    found = identify(docs, model)
    held = F.coalesce(fold_of() == 0, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "langs")
