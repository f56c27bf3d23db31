"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride shards.

The token stream of all documents, in the order of files and rows, is cut into sequences of equal length.  A keyed
Feistel permutation with cycle-walking gives every sequence its global slot; range partitions of the slots, sorted, are
written as shards in which slot ``s`` lies at byte ``(s % rows) * stride``, so readers go through a shard sequentially
and resume anywhere.
"""

from __future__ import annotations

import base64
import os
import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import cut, shared_dir, ship

RANKS = os.environ.get("BPE_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: The pattern that splits text before the merges of the rank file (fixed value of that vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = 50256
#: Look-ahead makes the splitter slow and matters only where white space follows white space.
AHEAD, SPACES = r"|\s+(?!\S)", re.compile(r"\s\s")
#: Runs of white space (as the pattern knows it) beyond which look-ahead would exhaust the splitter's stack: they are cut out.
RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
LENGTH, ROWS = 512, 16384
#: Splits of the input whose offsets are broadcast at most (about 60 MB).
SPLITS = 2_000_000


def feistel(x: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """The keyed permutation of ``0..n-1``, of each entry of ``x``; values outside walk on until they are inside."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = [np.uint64(xxhash.xxh64_intdigest(r.to_bytes(2, "little"), key)) for r in range(rounds)]
    out, todo = x.astype(np.uint64), np.arange(len(x))
    while len(todo):
        a, b = out[todo] >> np.uint64(half), out[todo] & low
        for k in keys:
            h = (b ^ k) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, (a ^ (h >> np.uint64(32))) & low
        out[todo] = (a << np.uint64(half)) | b
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


_loaded: dict = {}


def _tokenizer(ranks: str):
    """This worker's ``text -> ids``."""
    if ranks not in _loaded:
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        exact, fast = (tiktoken.Encoding("own", pat_str=p, mergeable_ranks=table, special_tokens={}).encode_ordinary for p in (PATTERN, PATTERN.replace(AHEAD, "")))


        def encode(text: str) -> list[int]:
            if not SPACES.search(text):
                return fast(text)
            if not RUN.search(text):
                return exact(text)
            ids, at = [], 0
            for m in RUN.finditer(text):  # white space but its last character is one piece, all of it at the end
                stop = m.end() if m.end() == len(text) else m.end() - 1
                for part, split in ((text[at : m.start()], exact), (text[m.start() : stop], fast)):
                    ids += split(part)
                at = stop
            return ids + exact(text[at:])

        _loaded[ranks] = encode
    return _loaded[ranks]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for b in batches:
        for i in range(0, b.num_rows, 1000):
            yield from zip(*(b.column(c).slice(i, 1000).to_pylist() for c in range(3)))


def _runs(batches: Iterator[pa.RecordBatch]):
    """``(file, first row, texts)`` of each contiguous run of rows of a file."""
    last, start = None, None
    for file, row, text in _rows(batches):
        if last is None or file != last[0] or row != last[1] + 1:
            start = (file, row)
        last = (file, row)
        yield start, text


def _starts(counts: DataFrame) -> tuple[DataFrame, int]:
    """``(split, row, start, n)`` of the runs in ``counts(file, row, n)`` by file and row, and the sum of all ``n``.

    Runs are range-sorted and summed up within each range; the driver sees one sum per range.
    """
    spark, counts = counts.sparkSession, cut(counts)  # ranges are found by sampling, which would count anew
    ranged = counts.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "row")
    ranged = cut(ranged.withColumn("p", F.spark_partition_id()))
    base, at = [], 0
    for r in sorted(ranged.groupBy("p").agg(F.sum("n").alias("n")).collect()):
        base.append((r["p"], at))
        at += r["n"]
    before = F.coalesce(F.sum("n").over(Window.partitionBy("p").orderBy("file", "row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = F.broadcast(spark.createDataFrame(base, "p int, base long"))
    return cut(ranged.withColumn("before", before).join(known, "p").select(F.xxhash64("file").alias("split"), F.col("row").alias("at"), (F.col("base") + F.col("before")).alias("start"), "n")), at


def materialise(docs: DataFrame, text: str = "text", length: int = LENGTH, rows: int = ROWS, key: int = 2024, ranks: str = RANKS, out: str | None = None) -> DataFrame:
    """Write all shards, then their manifest, and return it: a row per sequence, ``slot, sequence, shard, n_tokens, xxh64``.

    ``docs`` is a scan of Parquet files: their names and row numbers fix the stream, so the result doesn't depend on how
    the scan is split; other input is an error.  Ids are uint16; each document ends with ``END_OF_TEXT``; only the last
    sequence is padded (with the same id).  Null and empty texts add only their end; texts of any length and white space
    count whole; repeated rows and null ids stay; other columns are ignored; no rows, no shards.

    The first pass counts tokens of each split of the input; stream offsets are summed up by ranges of splits and
    joined to the first row of each.  The second pass tokenises again, which costs less than keeping the tokens, and
    checks its counts against the first.  Shards are written under another name and renamed, so a repeated or lost task
    leaves no half shard; the manifest, with a checksum of every sequence, is committed when all are whole.
    """
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, total = _tokenizer(ranks), {}
        for run, t in _runs(batches):
            total[run] = total.get(run, 0) + (len(enc(t)) if t else 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in total], pa.string()), pa.array([r for _, r in total], pa.int64()), pa.array(total.values(), pa.int64())], names=["file", "row", "n"])

    starts, tokens = _starts(src.mapInArrow(count, "file string, row long, n long"))
    n = -(-tokens // length)
    shards = max(1, -(-n // rows))
    if starts.count() > SPLITS or starts.select("split", "at").distinct().count() < starts.count():
        raise ValueError("too many splits of the input: raise spark.sql.files.maxPartitionBytes")
    folder = out or f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    placed = src.join(F.broadcast(starts), (F.xxhash64("file") == F.col("split")) & (F.col("row") == F.col("at")), "left").select("text", "start", "n")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, due, held, start = _tokenizer(ranks), None, bytearray(), 0
        end = np.array([END_OF_TEXT], "<u2").tobytes()

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal start
            if last and due is not None and start + len(held) // 2 != due:
                raise RuntimeError("the two passes read different rows")
            seq, off, part, i = [], [], [], 0
            while i < len(held):
                room = (length - start % length) * 2
                if len(held) - i < room and not last:
                    break
                seq.append(start // length)
                off.append(start % length)
                part.append(bytes(held[i : i + room]))
                start += len(part[-1]) // 2
                i += room
            del held[: min(i, len(held))]
            if seq:
                seq = np.array(seq, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(feistel(seq, n, key)), pa.array(seq), pa.array(off, pa.int32()), pa.array(part, pa.binary())], names=["slot", "sequence", "off", "part"])

        for b in batches:
            for i in range(0, b.num_rows, 1000):
                for t, first, size in zip(*(b.column(c).slice(i, 1000).to_pylist() for c in range(3))):
                    if first is not None:
                        yield from flush(True)
                        start, due = first, first + size
                    elif due is None:
                        raise RuntimeError("the two passes read different rows")
                    if t:
                        held += array("H", enc(t)).tobytes()
                    held += end
                    if len(held) > 1 << 21:
                        yield from flush(False)
        yield from flush(True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, f, have = None, None, None
        done: list = []

        def finish() -> None:
            nonlocal have
            if have is not None:
                body = bytes(have[2]) + end * (length - len(have[2]) // 2)
                f.add(body)
                done.append((have[0], have[1], have[0] // rows, len(have[2]) // 2, xxhash.xxh64_intdigest(body) - (1 << 63)))
                have = None

        end = np.array([END_OF_TEXT], "<u2").tobytes()
        for b in batches:
            for slot, sequence, off, part in zip(*(c.to_pylist() for c in b.columns)):
                if have is None or slot != have[0]:
                    if have is not None:
                        finish()
                    if slot // rows != shard:
                        if f:
                            f.close()
                        shard = slot // rows
                        f = Shard(folder, shard)
                    have = (slot, sequence, bytearray())
                if len(have[2]) != off * 2:
                    raise RuntimeError("a part of a sequence is missing")
                have[2].extend(part)
            if done:
                yield _batch(done)
                done.clear()
        finish()
        if f:
            f.close()
        if done:
            yield _batch(done)

    schema = T.StructType().add("slot", "long").add("sequence", "long").add("shard", "long").add("n_tokens", "integer").add("xxh64", "long")
    parts = placed.mapInArrow(cut_up, "slot long, sequence long, off int, part binary")
    ranged = parts.repartitionById(shards, F.floor(F.col("slot") / rows).cast("integer")).sortWithinPartitions("slot", "off")
    ranged.mapInArrow(write, schema).write.parquet(f"{folder}/manifest")
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


def _batch(done: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=["slot", "sequence", "shard", "n_tokens", "xxh64"])


def _files(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class Shard:
    """A shard file, renamed to its final name when it is whole."""

    def __init__(self, folder: str, number: int):
        self.fs, path = _files(re.sub("^file:/*", "file:///", folder))
        self.fs.create_dir(path, recursive=True)
        self.path = f"{path}/shard-{number:08d}.bin"
        context = TaskContext.get()
        self.temp = f"{self.path}.{context.taskAttemptId() if context else 0}.{uuid.uuid4().hex}.part"
        self.f, self.held = self.fs.open_output_stream(self.temp), []

    def add(self, body: bytes) -> None:
        self.held.append(body)
        if len(self.held) >= 4096:
            self.f.write(b"".join(self.held))
            self.held.clear()

    def close(self) -> None:
        self.f.write(b"".join(self.held))
        self.f.close()
        self.fs.move(self.temp, self.path)


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, rows: int = ROWS) -> Iterator[np.ndarray]:
    """Sequences of slots ``first ..`` in order: one seek, then sequential reads; ends where the shards end."""
    files, path = _files(re.sub("^file:/*", "file:///", folder))
    while count > 0:
        name = f"{path}/shard-{first // rows:08d}.bin"
        if files.get_file_info(name).size in (None, -1):
            return
        with files.open_input_file(name) as f:
            f.seek(first % rows * length * 2)
            body = f.read(min(count, rows - first % rows) * length * 2)
        for i in range(0, len(body), length * 2):
            yield np.frombuffer(body[i : i + length * 2], "<u2")
        got = len(body) // (length * 2)
        if got < min(count, rows - first % rows):
            return
        first, count = first + got, count - got
