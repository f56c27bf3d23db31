"""The stages of the corpus pipeline; each calls one operator of this package.

All but the last take and return the columns of ``documents``, whatever further ones there are and however they are called.

Null texts count as empty: they can't be rejected for their words and hold no item; texts without words are copies of each other, and the
one that stays has no tokens.  Texts of any length are taken whole.  Of near copies the row of smallest id stays, null ids last, of rows that are equal in id
and text one.  Rows that share an id but not their text stay or go together in the first and third stage, one by one in the second.
Empty tables give empty results; without labels of both kinds the first stage keeps all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, pii, resample, simhash, subword
from millrace.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose importance weight is too small to be worth drawing go."""
    return resample.keep_worthy(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest id stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    out = pii.redact(docs, pii.fit(written(pii.propose(docs), "proposals")))
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and its token ids."""
    return subword.encode(docs)
