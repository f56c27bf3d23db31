"""Corpus pipeline: quality filter, near-duplicates, decontamination, personal data, subword encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import pipeline_stages as stages

#: (name, function); each takes (spark, docs, sf_dir) and returns what the next one reads.
STAGES = [
    ("quality", stages.quality),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("personal_data", stages.personal_data),
    ("encoding", stages.encoding),
]
#: SQL can't express fingerprints by XXH64, EM or merge agendas; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again in the shared folder."""
    from millrace.llm.common import written

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
