"""Shared helpers: the cluster's shared folder, lineage cuts and exact selection."""

from __future__ import annotations

import ctypes
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import suppress
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Where the setting is absent on a local master (tests on one machine), a temporary folder is set for this session; on a
    cluster no folder of one machine will do, so its absence is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back (columns prune, sizes are known)."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give Python workers this package where they can't find it by their path: elsewhere than in its own folder, the
    driver sends it along once a session, from a file of its own that stays for executors to fetch."""
    root = Path(__file__).resolve().parents[2]
    here = {Path(p or ".").resolve() for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(":"))}
    if root in here or spark.conf.get("spark.millrace.shipped", "") == spark.sparkContext.applicationId:
        return
    spark.sparkContext.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/millrace", "zip", root, "millrace"))
    spark.conf.set("spark.millrace.shipped", spark.sparkContext.applicationId)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, of ``rows`` and of ``size`` bytes of text each (a longer text is one batch), so that a
    worker holds few texts as Python objects at a time."""
    for b in batches:
        ends = np.zeros(b.num_rows, np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type):
                ends += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(ends), 0
        while at < b.num_rows:
            to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right"))
            to = min(max(to, at + 1), at + rows)
            yield b.slice(at, to - at)
            at = to


def give_back() -> None:
    """Return freed memory to the system at the end of a task: the worker lives on and may wait beside others for its next one."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
