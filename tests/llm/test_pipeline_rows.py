"""The corpus pipeline on odd rows: nulls, empty and very long texts, repeated rows, shared ids, further columns, empty tables."""

import random

import pytest

import corpus_pipeline
from millrace.llm import subword

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start int, spans string, fp long, key double"


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 8))) for _ in range(n))


ITEM, TWICE = prose("item", 60), prose("twice", 80)
TEXTS = [
    (1, None), (2, ""), (3, " \n\t"), (4, prose("long", 60_000)), (5, TWICE), (6, TWICE), (6, TWICE), (7, f"{prose('a', 30)} {ITEM} {prose('b', 30)}"), (8, f"{prose('c', 40)} mail jane.doe@example.org now"),
    (9, prose("shared", 50)), (9, prose("other", 50)), (None, prose("none", 40)), (10, "one"),
]


def written(spark, folder, texts, labels):
    rows = [(i, t, "en", None, None if t is None else len(t), 1, "x", 2, 0.5) for i, t in texts]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.mark.parametrize("labels", [[], [(5, 1, 0), (4, 1, None), (None, 0, 1), (9, None, None)]])
def test_odd_rows(spark, tmp_path, labels):
    folder = written(spark, tmp_path, TEXTS, labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
    out = corpus_pipeline.run(spark, folder)
    got = out.collect()
    ids = sorted((r.doc_id for r in got if r.doc_id is not None))
    assert set(ids) == {1, 4, 5, 8, 9, 10} and ids.count(9) == 2 and any(r.doc_id is None for r in got)
    text = {r.doc_id: r.text for r in subword.decode(out.filter("doc_id in (4, 5, 8)")).collect()}
    assert text[4] == TEXTS[3][1] and text[5] == TWICE and "jane.doe" not in text[8] and "[EMAIL]" in text[8]


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [], [])).count() == 0
