"""Surrogate keys from a stream as a log: each batch appends the keys that are new, and nothing else is written again.

``log.json`` names the parts that count, the last batch and the next free id; it is replaced by one rename.  A part is a Parquet
folder by hash bucket, so a batch looks up only the buckets that its values fall into.  Every ``compact`` parts become one.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.jobs import Folder
from millrace.operators.keys import dense_id

START = {"batch": -1, "next": 0, "generation": 0, "parts": []}


def _state(home: Folder) -> dict:
    return json.loads(home.read("log.json") or json.dumps(START))


def _read(spark: SparkSession, folder: str, parts: list[str]) -> DataFrame:
    out = None
    for p in parts:
        one = spark.read.parquet(f"{folder}/{p}")
        out = one if out is None else out.unionByName(one)
    return out


def append_keys(batch: DataFrame, n: int, cols: list[str], name: str, folder: str, buckets: int = 64, compact: int = 16) -> None:
    """Give ids to the values of batch ``n`` that the log lacks; ids go on from the largest, in the order of the values.

    A batch that was committed does nothing.  One that failed before its commit left at most a part that the log doesn't name, which
    is written anew with the same ids, as neither the log nor the free id has moved.  Nulls are values.
    """
    spark = batch.sparkSession
    home = Folder(spark, folder)
    log = _state(home)
    if n <= log["batch"]:
        return
    fresh = batch.select(*cols).distinct().withColumn("bucket", F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int"))
    if log["parts"]:
        met = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # ``buckets`` at most
        known = _read(spark, folder, log["parts"]).filter(F.col("bucket").isin(*met)).select(*[F.col(c).alias(f"_{c}") for c in cols], F.col("bucket").alias("_bucket"))
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols] + [F.col("bucket") == F.col("_bucket")]
        fresh = fresh.join(known, on, "left_anti")
    seen, part = Observation(), f"delta-{n}"
    rows = dense_id(fresh, list(cols), name).withColumn(name, F.col(name) + log["next"])
    rows.repartition("bucket").observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/{part}")
    added = seen.get["rows"]
    parts, gone = [*log["parts"], *([part] if added else [])], []
    if len(parts) >= compact:
        gone, whole = parts, f"base-{log['generation'] + 1}"
        _read(spark, folder, parts).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/{whole}")
        parts = [whole]
    home.write("log.json", json.dumps({"batch": n, "next": log["next"] + added, "generation": log["generation"] + bool(gone), "parts": parts}))
    for old in gone:
        home.delete(old)


def read_keys(spark: SparkSession, cols: list[str], name: str, folder: str) -> DataFrame | None:
    """All keys of the committed batches; None before the first key."""
    parts = _state(Folder(spark, folder))["parts"]
    return _read(spark, folder, parts).select(*cols, name) if parts else None


def log_ids(stream: DataFrame, cols: list[str], name: str, folder: str, checkpoint: str, **how) -> StreamingQuery:
    """Keep the log up to date from a stream; it ends when the input at hand has been read (``availableNow``)."""
    write = stream.writeStream.foreachBatch(lambda batch, n: append_keys(batch, n, cols, name, folder, **how))
    return write.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
