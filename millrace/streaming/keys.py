"""Surrogate keys for values as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.keys import incremental_ids
from millrace.operators.shared import complete


def assign_ids(stream: DataFrame, cols: list[str], name: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Keep a dimension table up to date from a stream: values seen before keep their id, new ones go on from the largest.

    Versions are written as ``folder/batch=<n>``; a batch that runs again finds its version written and does nothing,
    and each starts from the version before, so a failure between writing and committing is harmless.  The stream ends
    when the input at hand has been read (``availableNow``).
    """

    def upsert(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        if n == 0:
            known = batch.select(*cols).limit(0).selectExpr(*cols, f"cast(null as bigint) as {name}")
        else:
            known = spark.read.parquet(f"{folder}/batch={n - 1}")
        if not complete(spark, f"{folder}/batch={n}"):  # a version that a failed write left behind is written anew
            incremental_ids(known, batch, cols, name).write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
