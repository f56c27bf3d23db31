"""Every registered query with SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from millrace.plans import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    df = df[sorted(df.columns)]
    text = lambda v: "" if v is None or v != v else repr(round(v, 9)) if isinstance(v, float) else str(v)
    return list(df.columns), sorted(tuple(text(v) for v in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert name in ORACLE
    assert rows(QUERIES[name](spark, FOLDER).toPandas()) == rows(db.sql(ORACLE[name]).df())
