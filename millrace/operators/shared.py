"""The folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder where it is unset on a local master, as in tests, elsewhere an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed; a failed one leaves a folder without the mark."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


#: Intermediate tables of this process that nobody has deleted, in the order they were written.
_written: list[str] = []


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that ``stored`` writes inside are deleted at the end, also after an error.

    For work whose results are written inside: a DataFrame that is read later may still need them.
    """
    mark = len(_written)
    try:
        yield
    finally:
        for path in _written[mark:]:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        del _written[mark:]


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, a lost executor costs nothing."""
    path = scratch(df.sparkSession, name)
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
