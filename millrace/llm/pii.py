"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base matches (four fixed patterns) always stay.  Looser patterns propose further spans; labelers vote +1, 0 or -1 on
every span; expectation-maximisation over the counts of vote patterns estimates each labeler's reliability and a
posterior for each pattern; a logistic classifier on votes, shape and surrounding words is trained on these posteriors and
decides on the proposed spans.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import ship, sliced, written

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can't begin inside a run of digits unless the run's first digit began one, so the look-behind changes nothing but the cost.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"(?i)[0-9@]|\bdot\b")

#: Proposals beyond the base patterns.
LOOSE = {
    "email": re.compile(r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}\s?(?:\[at\]|\(at\)|\bat\b)\s?[a-z0-9-]{1,63}(?:\s?(?:\[dot\]|\(dot\)|\bdot\b)\s?[a-z0-9-]{1,63}){1,4}"),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){2}[._/][0-9]{1,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\([0-9]{2,4}\)|00[0-9]{1,3}|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
}
#: Gazetteers.
TLDS = frozenset("com org net edu gov int mil info biz io dev app ai co me tv name pro museum aero coop jobs mobi travel xyz online site tech store shop blog cloud "
                 "de fr es it uk us ca au jp cn br in nl se ch at be pl ru ua cz sk hu ro bg gr tr pt ie dk no fi is ee lv lt si hr rs mx ar cl pe kr tw hk sg my th vn id ph nz za ng ke eg ma il sa ae ir pk bd lk eu".split())
ISSUER = re.compile(r"3[47]|4|5[1-5]|2[2-7]|6(?:011|5)|35|30|36|38")
CALLING = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")
PREMIUM = re.compile(r"0{2,}|9{6,}|1234567|5550{4,}")
#: Context cues, before the span.
CUES = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write|reach|schreib|courriel|correo)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|address|addr|client|from|login)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|payment)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|téléphone|teléfono)\b"),
}
AGAINST = re.compile(r"(?i)\b(?:version|ver|isbn|issn|order|invoice|serial|build|sku|section|chapter|token|hash)\b")
WORD = re.compile(r"\w+")
LABELERS = 6
#: Numbers that traits of a span are hashed to, and spans of each kind that train the classifier (about so many).
TRAITS, SAMPLE = 256, 10_000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base matches by kind, then start; code points, end exclusive."""
    out, at, done = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and luhn(d := re.sub("[ -]", "", m[0])) and 13 <= len(d) <= 19:
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def luhn(digits: str) -> bool:
    if len(digits) > 19:
        return False
    total = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Proposed spans that touch no base span and not each other, leftmost first within a kind."""
    starts, ends, out = [], [], []  # of what is taken: disjoint, in order
    for a, b in sorted((a, b) for _, a, b in base):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for kind, name in enumerate(KINDS):
        if name == "email" and not re.search(r"(?i)dot", text):
            continue
        for m in LOOSE[name].finditer(text):
            i = bisect_right(ends, m.start())
            if i == len(ends) or m.end() <= starts[i]:
                out.append((kind, m.start(), m.end()))
                starts.insert(i, m.start())
                ends.insert(i, m.end())
    return out


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, ...]:
    """The labelers: pattern, boundary, validity, gazetteer, context for, context against."""
    name, span = KINDS[kind], text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    left, right = text[start - 1 : start], text[end : end + 1]
    boundary = -1 if left.isalnum() or right.isalnum() or (left and left in "_=/") else 1
    before = text[max(0, start - 48) : start]
    if name == "email":
        parts = re.split(r"(?i)\s?(?:\[dot\]|\(dot\)|\bdot\b)\s?|\.", span)
        gaz = 1 if parts[-1].lower() in TLDS else -1
        valid = 1 if 2 <= len(parts[-1]) <= 24 and parts[-1].isalpha() else -1
    elif name == "ip":
        nums = [int(x) for x in re.findall(r"[0-9]{1,3}", span)][:4]
        valid = 1 if max(nums) <= 255 else -1
        gaz = -1 if nums[0] in (0, 127) or nums[0] >= 240 else 1
    elif name == "card":
        valid = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        gaz = 1 if ISSUER.match(digits) else -1
    else:
        valid = 1 if 9 <= len(digits) <= 15 else -1
        gaz = -1 if PREMIUM.search(digits) else 1 if CALLING.match(digits.lstrip("0")) else 0
    return (1 if base else 0, boundary, valid, gaz, 1 if CUES[name].search(before) else 0, -1 if AGAINST.search(before) else 0)


def traits(text: str, start: int, end: int) -> list[int]:
    """What the final classifier sees of a span and its surroundings, hashed: its shape, the words around it, how long it is."""
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "0", text[start:end].lower()))
    words = [f"b{i}{w}" for i, w in enumerate(WORD.findall(text[max(0, start - 48) : start].lower())[-3:][::-1])]
    after = [f"a{w}" for w in WORD.findall(text[end : end + 24].lower())[:1]]
    parts = [f"s{shape}", f"s{re.sub('0+', '0', shape)}", f"n{min(40, end - start)}", f"l{text[start - 1 : start]}", f"r{text[end : end + 1]}", *words, *after]
    return sorted({xxhash.xxh32_intdigest(x.encode("utf-8", "replace"), 17) % TRAITS for x in parts})


def candidates(text: str | None) -> list[tuple[int, int, int, bool, int, list[int]]]:
    """``(kind, start, end, base, code, traits)``; the code packs the votes."""
    if not text or not ANY.search(text):
        return []
    base = base_spans(text)
    out = []
    for is_base, spans in ((True, base), (False, loose_spans(text, base))):
        for kind, a, b in spans:
            code = 0
            for v in votes(text, kind, a, b, is_base):
                code = code * 3 + v + 1
            out.append((kind, a, b, is_base, code, traits(text, a, b)))
    return sorted(out)


def unpack(code: int) -> list[int]:
    got = []
    for _ in range(LABELERS):
        code, v = divmod(code, 3)
        got.append(v - 1)
    return got[::-1]


def design(codes: list[int], traits_: list[list[int]]) -> np.ndarray:
    """A row per span: one, its votes for and against, its traits."""
    x = np.zeros((len(codes), 1 + 2 * LABELERS + TRAITS), np.float32)
    x[:, 0] = 1
    for row, code, some in zip(x, codes, traits_):
        pattern = np.array(unpack(code))
        row[1 : 1 + LABELERS], row[1 + LABELERS : 1 + 2 * LABELERS] = pattern == 1, pattern == -1
        row[np.array(some, np.int64) + 1 + 2 * LABELERS] = 1
    return x


@dataclass(frozen=True)
class Model:
    """Reliabilities by kind and labeler, and the classifier's coefficients by kind."""

    reliability: dict[str, list[float]]
    weights: dict[int, np.ndarray]

    def keeps(self, kind: int, code: int, traits_: list[int]) -> bool:
        return kind in self.weights and float((design([code], [traits_]) @ self.weights[kind])[0]) >= 0


def expectation_maximisation(pattern: np.ndarray, count: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote pattern and P(vote | class) as ``[class, labeler, vote + 1]``; starts from the vote share."""
    post = np.clip(0.5 + pattern.sum(1) / (2.0 * LABELERS), 0.02, 0.98)
    for _ in range(rounds):
        by = np.stack([(1 - post) * count, post * count])
        prior = (by.sum(1) + 1) / (by.sum() + 2)
        like = np.stack([[[(by[c] * (pattern[:, j] == v)).sum() + 0.5 + (v == (1 if c else -1)) for v in (-1, 0, 1)] for j in range(LABELERS)] for c in (0, 1)])
        like /= like.sum(2, keepdims=True)
        logs = np.log(prior)[:, None] + np.stack([np.log(like[c][np.arange(LABELERS), pattern + 1]).sum(1) for c in (0, 1)])
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return post, like


def classify(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Coefficients of a logistic regression on soft labels, by damped Newton steps with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + np.eye(len(w)), x.T @ (y - p) - w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-4:
            break
    return w


_SPAN = T.StructType().add("kind", "integer").add("start", "integer").add("end", "integer").add("base", "boolean").add("code", "integer").add("traits", T.ArrayType(T.IntegerType()))


def propose(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, spans)`` for every row: all base and proposed spans with their votes and traits, without the text."""
    ship(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("code", pa.int32()), ("traits", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            rows = [[dict(zip(_SPAN.names, s)) for s in candidates(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], names=[id_col, "spans"])

    src = docs.select(F.col(id_col).alias(id_col), F.col(text).alias("_text"))
    return src.mapInArrow(run, T.StructType([src.schema[0]]).add("spans", T.ArrayType(_SPAN)))


def fit(proposals: DataFrame, sample: int = SAMPLE) -> Model:
    """Estimate reliabilities over all proposals, then train the span classifier on their posteriors.

    What reaches the driver are counts by (kind, vote pattern), at most ``4 * 3**6`` rows, and the spans that train the
    classifier, about ``sample`` of each kind, chosen by a hash.  The posterior of a vote pattern labels its spans;
    the classifier sees shapes and words besides, so it also tells apart spans with the same votes.
    """
    span = proposals.select(F.inline("spans"))
    rows = span.groupBy("kind", "code").count().collect()
    total = {k: sum(r["count"] for r in rows if r["kind"] == k) for k in range(len(KINDS))}
    rate = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, n in total.items() for x in (k, min(1.0, sample / max(1, n)))]), F.col("kind")), F.lit(0.0))
    chance = F.shiftrightunsigned(F.xxhash64("kind", "start", "end", "code", "traits"), 11) / float(1 << 53)
    chosen = span.filter(chance < rate).select("kind", "code", "traits").distinct().collect()
    reliability, weights = {}, {}
    for kind, name in enumerate(KINDS):
        own = sorted((r["code"], r["count"]) for r in rows if r["kind"] == kind)
        some = sorted((r["code"], tuple(r["traits"])) for r in chosen if r["kind"] == kind)
        if own and some:
            pattern, count = np.array([unpack(c) for c, _ in own]), np.array([n for _, n in own], float)
            post, like = expectation_maximisation(pattern, count)
            label = {c: float(p) for (c, _), p in zip(own, post)}
            weights[kind] = classify(design([c for c, _ in some], [t for _, t in some]).astype(float), np.array([label[c] for c, _ in some]))
            reliability[name] = like[1, :, 2].tolist()
    return Model(reliability, weights)


def find(proposals: DataFrame, model: Model) -> DataFrame:
    """``(id, found array<struct<kind, start, end, base>>)`` for every row, by kind and start: base spans and those kept by the classifier."""
    ship(proposals.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [[{"kind": KINDS[s["kind"]], "start": s["start"], "end": s["end"], "base": s["base"]} for s in spans if s["base"] or model.keeps(s["kind"], s["code"], s["traits"])] for spans in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], names=[b.schema.names[0], "found"])

    return proposals.mapInArrow(run, T.StructType([proposals.schema[0]]).add("found", T.ArrayType(T.StructType().add("kind", "string").add("start", "integer").add("end", "integer").add("base", "boolean"))))


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs``; found spans become ``[EMAIL]`` and so on, null text stays null; overlapping spans merge."""
    ship(docs.sparkSession)

    def make(t: str | None) -> str | None:
        out, at = [], 0
        for a, b, k in sorted((a, b, k) for k, a, b, base, code, some in candidates(t) if base or model.keeps(k, code, some)):
            if b > at:
                if a >= at:
                    out += [t[at:a], f"[{KINDS[k].upper()}]"]
                at = b
        return t if not out else "".join(out) + t[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([make(t) for t in b.column(b.num_columns - 1).to_pylist()], pa.string())], names=b.schema.names)

    rest = [c for c in docs.columns if c != text]
    # Numbered names: the caller's can't clash with ours.
    src = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], F.col(f"`{text}`").alias("t"))
    return src.mapInArrow(run, src.schema).toDF(*rest, text).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_personal_data(docs: DataFrame) -> DataFrame:
    """Contract columns for every row of ``docs``, and ``n_added``.

    Null text counts as empty; texts of any length are searched whole; repeated rows and null ids stay; other columns are
    ignored; no rows give none.
    """
    proposals = written(propose(docs), "proposals")
    found = find(proposals, fit(proposals))
    text_of = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("found", lambda s: s["base"])
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind))
    n = [of(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *n, F.sha2(F.array_join(F.transform(base, text_of), ",").cast("binary"), 256).alias("base_sha256"), F.array_join(F.transform("found", text_of), ",").alias("spans"), (F.size("found") - F.size(base)).cast("long").alias("n_added"))
