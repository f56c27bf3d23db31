"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

The model file is read once per Python worker, from a path that every worker can open (a parameter).  Pieces never
cross from other text into a space, nor in most vocabularies between letters and other characters, so a text is cut
there.  Every occurrence of a chunk draws its own skips, keyed by document and place.  The agendas of many chunks run in
step on arrays; what is kept per chunk is only what no draw changes.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import give_back, ship, sliced

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Where no piece joins a letter to another character, words and marks are cut apart; else at spaces only.
FINE, COARSE = re.compile(r" *(?:[^\W\d_¹²³]+|(?:[\d_¹²³]|[^\w ])+)| +"), re.compile(r" *[^ ]+| +")
#: Chunks that a worker holds (about 40 MB); beyond, it starts anew.
CACHE = 64_000
#: Longer chunks are segmented one by one; rows and chunks that are looked at together (a piece's more at most).
LONG, ROWS, SLICE = 24, 400, 20_000
#: Characters of a text that are cut into chunks at a time; a piece ends before a space, where a chunk ends in any case.
PIECE = 1 << 16
PIECE_END = re.compile(r"(?<=[^ ]) ")
#: Rank of a pair that doesn't merge.
NEVER = 1 << 30
SPREAD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


class Cached(dict):
    """``make(key)``, kept for at least the last ``limit`` distinct keys; memory is bounded by two generations."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key) or self.make(key)
        if len(key) <= 64:  # long chunks hardly recur
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def draw(x: int) -> int:
    """64 random bits of a key; ``draws`` is the same for an array."""
    x = x * 0xD6E8FEB86659FD93 & MASK
    return (x ^ x >> 32) * 0xA0761D6478BD642F & MASK


def draws(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ x >> np.uint64(32)) * np.uint64(0xA0761D6478BD642F)


class Pieces:
    """A SentencePiece BPE vocabulary with byte fallback; a space stands for the word mark, so a literal mark is plain text."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        ids: dict[str, int] = {}
        self.bytes = [0] * 256
        self.text: list[bytes] = []
        for i in range(self.size):
            piece = sp.id_to_piece(i).replace("▁", " ")
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.text.append(b"")
            else:
                ids[piece] = i
                self.text.append(piece.encode())
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in ids.values()}, reverse=True))}
        self.chunks = (FINE if all(len(FINE.findall(p)) <= 1 for p in ids) else COARSE).findall
        self.ids = ids.get
        rank = {p: order[sp.get_score(i)] for p, i in ids.items()}
        self.rank = rank.get
        # For many chunks at once: pieces by a hash of their characters, with what only begins a piece.
        prefix = {p[:i]: -1 for p in ids for i in range(1, len(p))} | ids
        found: dict[int, int] = {}
        for text, i in prefix.items():
            h = 0
            for c in map(ord, text):
                h = (h ^ c + 1) * SPREAD & MASK
            found[h] = i
        if len(found) < len(prefix):
            raise ValueError("two beginnings of pieces share a hash")
        self.hash, self.piece = np.array(sorted(found), np.uint64), np.array([found[h] for h in sorted(found)], np.int32)
        self.ranks = np.full(self.size + 1, NEVER, np.int32)  # the last entry stands for no piece
        self.ranks[[ids[p] for p in rank]] = list(rank.values())
        self.first = np.full(0x110000, -1, np.int32)
        for c, i in ids.items():
            if len(c) == 1:
                self.first[ord(c)] = i

    def parts(self, chars: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece of every part of chunks of ``n`` characters each (-1: none), and where each chunk's begin; see ``part``."""
        size = n * (n + 1) // 2
        first = np.cumsum(size) - size
        out = np.full(int(size.sum()), -1, np.int32)
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(chars))
        a = at - np.repeat(np.cumsum(n) - n, n)
        slot, left, h = first[row] + part(a, a + 1, n[row]), (n[row] - a), np.zeros(len(at), np.uint64)
        while len(at):
            h = (h ^ (chars[at] + np.uint64(1))) * np.uint64(SPREAD)
            i = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            some = self.hash[i] == h
            out[slot[some]] = self.piece[i[some]]
            some &= left > 1
            slot, left, h, at = slot[some] + 1, left[some] - 1, h[some], at[some] + 1
        return out, first

    def segment(self, chunk: str, dropout: float, key: int) -> bytes:
        """Ids of ``chunk`` as little-endian int32.

        The agenda holds candidate merges by score, then position.  One that is popped is skipped if a hash of key
        and its place falls below ``dropout``; its two parts may still merge with their other neighbours.
        """
        limit = int(dropout * 2**64)
        return self._run(chunk, (lambda c: draw(key ^ c) < limit) if limit else None)

    def _run(self, chunk: str, skip) -> bytes:
        n, rank = len(chunk), self.rank
        end, before = list(range(1, n + 1)), list(range(-1, n))  # end of the part at i (0: merged away); start of the part before it
        bits = (n + 1).bit_length()
        low, two = (1 << bits) - 1, 2 * bits  # an entry packs score rank, start and end: one integer orders the agenda
        agenda = [r << two | i << bits | i + 2 for i, pair in enumerate(map(add, chunk, chunk[1:])) if (r := rank(pair)) is not None]
        if agenda:
            heapify(agenda)
            while agenda:
                x = heappop(agenda)
                a, b = x >> bits & low, x & low
                m = end[a]
                if not m or m >= b or end[m] != b:
                    continue
                if skip and skip((a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F) & MASK):
                    continue
                end[a], end[m] = b, 0
                if b < n:
                    before[b] = a
                    z = end[b]
                    r = rank(chunk[a:z])
                    if r is not None:
                        heappush(agenda, r << two | a << bits | z)
                if a:
                    p = before[a]
                    r = rank(chunk[p:b])
                    if r is not None:
                        heappush(agenda, r << two | p << bits | b)
        out, i, ids = [], 0, self.ids
        while i < n:
            z = end[i]
            got = ids(chunk[i:z])
            if got is None:
                out += [self.bytes[c] for c in chunk[i:z].encode("utf-8", "surrogatepass")]
            else:
                out.append(got)
            i = z
        return array("i", out).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text; the space that encoding puts in front is taken off."""
        return b"".join(map(self.text.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


_loaded: dict = {}


def load(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def occurrence_keys(doc, n: int, seed: int, first: int = 0) -> np.ndarray:
    """Keys of ``n`` chunks of a document from its chunk ``first`` on, by its id and their places."""
    base = np.uint64(xxhash.xxh64_intdigest(str(doc), seed & MASK))
    return draws(base + np.arange(first, first + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def text_pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of about ``PIECE`` characters; no chunk crosses their ends."""
    at = 0
    while len(text) - at > PIECE and (found := PIECE_END.search(text, at + PIECE)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def part(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of the part from ``a`` to ``b`` among all parts of a chunk of ``n`` characters."""
    return a * n - a * (a - 1) // 2 + b - a - 1


class Flat:
    """An array that grows."""

    def __init__(self, kind):
        self.all, self.used = np.empty(1 << 16, kind), 0

    def add(self, x: np.ndarray) -> None:
        while self.used + len(x) > len(self.all):
            self.all = np.concatenate([self.all, np.empty_like(self.all)])
        self.all[self.used : self.used + len(x)] = x
        self.used += len(x)


class Chunks:
    """What no draw changes, kept by a worker for the chunks that it met: which parts are pieces, the ids if nothing is
    skipped, and the codes of the merges tried.  So a batch's draws are looked at together, and only chunks that skip a
    merge are segmented again.  Number 0 stands for chunks that are segmented one by one: long ones and those with
    characters that aren't pieces."""

    def __init__(self, pieces: Pieces, limit: int = CACHE):
        self.pieces, self.limit = pieces, limit
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.piece, self.code, self.ids = Flat(np.int32), Flat(np.uint64), Flat(np.int32)
        self.size, self.at, self.code_at, self.ids_at = (Flat(np.int64) for _ in range(4))
        for x, first in ((self.size, [0]), (self.at, [0]), (self.code_at, [0, 0]), (self.ids_at, [0, 0])):
            x.add(np.array(first))

    def add(self, chunks: list[str]) -> None:
        chunks.sort(key=len)
        n = np.fromiter(map(len, chunks), np.int64, len(chunks))
        chars = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        odd = (n > LONG) | (np.minimum.reduceat(self.pieces.first[chars], np.cumsum(n) - n) < 0)
        if odd.any():
            self.number.update((chunks[i], 0) for i in np.flatnonzero(odd).tolist())
            chunks = [c for c, x in zip(chunks, odd.tolist()) if not x]
            chars, n = chars[np.repeat(~odd, n)], n[~odd]
        piece, at = self.pieces.parts(chars.astype(np.uint64), n)
        new = self.size.used
        self.at.add(at + self.piece.used)
        self.piece.add(piece)
        self.size.add(n)
        self.number.update(zip(chunks, range(new, new + len(chunks))))
        for some in _by_size(n):
            ids, ends, code, code_ends = self.together(some + new)
            self.ids_at.add(ends + self.ids.used)
            self.ids.add(ids)
            self.code_at.add(code_ends + self.code.used)
            self.code.add(code)

    def together(self, numbers: np.ndarray, keys: np.ndarray | None = None, limit: int = 0) -> tuple[np.ndarray, ...]:
        """``Pieces.segment`` for many chunks in step: the best merge of each agenda is popped, then the next of each.

        The ids and where each chunk's end.  Without keys nothing is skipped and the codes of the merges tried come too,
        in order, with where each chunk's end.
        """
        n, at, piece, ranks = self.size.all[numbers], self.at.all[numbers], self.piece.all, self.pieces.ranks
        m, width = len(n), int(n.max(initial=1))
        column = np.arange(width)
        alive = column < n[:, None]
        end, before = np.tile(column + 1, (m, 1)), np.tile(column - 1, (m, 1))
        rank = np.full((m, width), NEVER, np.int32)
        row, a = np.nonzero(column < n[:, None] - 1)
        rank[row, a] = ranks[piece[at[row] + part(a, a + 2, n[row])]]
        live, tried = np.arange(m), []
        while len(live):
            best = rank[live]
            a = best.argmin(1)
            some = best[np.arange(len(live)), a] < NEVER
            live, a = live[some], a[some]
            mid = end[live, a]
            z = end[live, mid]
            code = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ z.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            row = live
            if keys is None:
                tried.append((row, code))
            else:
                skip = draws(keys[row] ^ code) < np.uint64(min(limit, MASK))
                rank[row[skip], a[skip]] = NEVER
                row, a, mid, z = (x[~skip] for x in (row, a, mid, z))
            end[row, a], alive[row, mid], rank[row, a], rank[row, mid] = z, False, NEVER, NEVER
            on = z < n[row]
            r, x, y = row[on], a[on], z[on]
            before[r, y] = x
            rank[r, x] = ranks[piece[at[r] + part(x, end[r, y], n[r])]]
            on = a > 0
            r, y = row[on], z[on]
            x = before[r, a[on]]
            rank[r, x] = ranks[piece[at[r] + part(x, y, n[r])]]
        row, a = np.nonzero(alive)
        ids, ends = piece[at[row] + part(a, end[row, a], n[row])], np.cumsum(alive.sum(1))
        if keys is not None:
            return ids, ends
        row, code = (np.concatenate(x) for x in zip(*tried)) if tried else (np.empty(0, np.int64), np.empty(0, np.uint64))
        return ids, ends, code[np.argsort(row, kind="stable")], np.cumsum(np.bincount(row, minlength=m))

    def segment(self, parts: list[str], keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
        """``Pieces.segment`` for each chunk with its key: all ids, and how many each has."""
        if self.size.used > self.limit:
            self.clear()
        if new := [c for c in dict.fromkeys(parts) if c not in self.number]:
            self.add(new)
        limit = int(dropout * 2**64)
        number = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        first, size = self.ids_at.all[number], self.ids_at.all[number + 1] - self.ids_at.all[number]
        source = [self.ids.all[: self.ids.used]]
        used = self.ids.used
        if limit:
            begin = self.code_at.all[number]
            tries = self.code_at.all[number + 1] - begin
            owner = np.repeat(np.arange(len(parts)), tries)
            place = np.arange(len(owner)) + np.repeat(begin - np.cumsum(tries) + tries, tries)
            hit = owner[draws(keys[owner] ^ self.code.all[place]) < np.uint64(min(limit, MASK))]
            again = hit[np.r_[True, hit[1:] != hit[:-1]]] if len(hit) else hit
            for some in _by_size(self.size.all[number[again]]):
                at = again[some]
                ids, ends = self.together(number[at], keys[at], limit)
                size[at] = np.diff(ends, prepend=0)
                first[at] = ends - size[at] + used
                source.append(ids)
                used += len(ids)
        for i in np.flatnonzero(number == 0).tolist():
            ids = np.frombuffer(self.pieces.segment(parts[i], dropout, int(keys[i])), "<i4")
            first[i], size[i] = used, len(ids)
            source.append(ids)
            used += len(ids)
        place = np.arange(int(size.sum())) + np.repeat(first - np.cumsum(size) + size, size)
        return np.concatenate(source)[place], size


def _by_size(size: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of chunks of similar length."""
    for low, high in ((0, 5), (5, 9), (9, 14), (14, LONG)):
        some = np.flatnonzero((size > low) & (size <= high))
        if len(some):
            yield some


def encoder(path: str, dropout: float, seed: int):
    """``(texts, doc keys) -> ids of each as bytes`` for this worker."""
    pieces = load(path)
    if ("chunks", path) not in _loaded:
        _loaded["chunks", path] = Chunks(pieces)
    held, chunks = _loaded["chunks", path], pieces.chunks

    def run(texts: list, docs: list) -> list[bytes]:
        parts, keys, ends = [], [], [0]
        ids, size = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]

        def settle() -> None:
            for x, got in zip((ids, size), held.segment(parts, np.concatenate(keys), dropout)):
                x.append(got)
            parts.clear()
            keys.clear()

        for text, doc in zip(texts, docs):
            n = 0
            for piece in text_pieces(" " + text) if text else ():
                own = chunks(piece)
                parts += own
                keys.append(occurrence_keys(doc, len(own), seed, n))
                n += len(own)
                if len(parts) >= SLICE:
                    settle()
            ends.append(ends[-1] + n)
        if parts:
            settle()
        ids, at = np.concatenate(ids).astype("<i4", copy=False), np.cumsum(np.concatenate(size))[ends].tolist()
        return [ids[a:z].tobytes() for a, z in zip(at, at[1:])]

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text: str = "text", model: str = MODEL, dropout: float = 0.1, seed: int = 7, digest: bool = False) -> DataFrame:
    """``(id, ids array<int>)`` for every row, or with ``digest`` ``(id, n_tokens, ids_sha256, lossless)``.

    A merge is skipped with probability ``dropout``, by a hash keyed with ``seed``, the id and the place in the text:
    every occurrence of a word is drawn anew, equal input gives equal ids on every run and cluster, and other seeds give
    other segmentations.  Null and empty texts give no ids; whole texts of any length are encoded; null ids and repeated
    rows stay; other columns are ignored; no rows give none.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pieces = encoder(model, dropout, seed), load(model)
        for b in sliced(batches, ROWS):
            key, texts = b.column(0), b.column(1).to_pylist()
            part = enc(texts, key.to_pylist())
            if digest:
                same = [pieces.decode(np.frombuffer(p, "<i4")) == (t or "") for p, t in zip(part, texts)]
                cols = [pa.array([len(p) // 4 for p in part], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in part]), pa.array(same)]
            else:
                ends = np.cumsum([0] + [len(p) // 4 for p in part]).astype(np.int32)
                cols = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(part), "<i4")))]
            yield pa.RecordBatch.from_arrays([key, *cols], names=out.names)
        give_back()

    src = docs.select(F.col(id_col).alias(id_col), F.col(text).alias("_text"))
    out = T.StructType([src.schema[0]])
    out = out.add("n_tokens", "long").add("ids_sha256", "string").add("lossless", "boolean") if digest else out.add("ids", T.ArrayType(T.IntegerType()))
    return src.mapInArrow(run, out)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``(id, text)`` for every row of ``encode``'s result; null and empty arrays give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for b in batches:
            text = [pieces.decode(np.array(x, np.int32)) if x else "" for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=[id_col, "text"])

    ship(encoded.sparkSession)
    src = encoded.select(F.col(id_col).alias(id_col), F.col(ids).alias("ids"))
    return src.mapInArrow(run, T.StructType([src.schema[0], T.StructField("text", T.StringType())]))
