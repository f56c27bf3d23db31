"""Frames of tokens at the rate of the source: every token in a listed video has some."""

import duckdb

from millrace.plans import ORACLE, QUERIES

NAME = "build_frames_of_tokens"
KEY = ["DocumentID", "ASLConsultantID", "UtteranceSequence", "TokenSequence"]


def both(spark, folder, turns):
    """The query's rows and its SQL's over ``turns``, sorted."""
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    got, want = QUERIES[NAME](spark, str(folder)).toPandas(), db.sql(ORACLE[NAME]).df()
    assert sorted(got.columns) == sorted(want.columns)
    return got, sorted(got[sorted(got.columns)].itertuples(index=False, name=None)), sorted(want[sorted(want.columns)].itertuples(index=False, name=None))


def test_no_token_is_without_frames(spark, tmp_path):
    """Turns 0, 1, 3 and 4 are in videos of the index, turn 2 isn't; each of their words at odd places is a token of 90 ms."""
    turns = [(c, n, "user" if n % 2 == 0 else "assistant", " ".join(["ab"] * (1 + 3 * c + n))) for c in (4, 9) for n in range(5)]
    got, rows, want = both(spark, tmp_path, turns)
    assert rows == want
    frames = got.groupby(KEY).FrameSequence.agg(["count", "min", "max"])
    assert len(frames) == sum(-(-len(text.split()) // 2) for _, n, _, text in turns if n % 3 < 2)
    assert set(frames["count"]) == {2, 3} and (frames["max"] - frames["min"] + 1 == frames["count"]).all()


def test_frames_of_a_turn_over_100_seconds(spark, tmp_path):
    """A last turn of 2600 words ends at 104.05 s; its frames are there to the end."""
    got, rows, want = both(spark, tmp_path, [(1, 0, "user", " ".join(["a"] * 2600)), (2, 0, "user", None), (3, 0, "user", "1 2")])
    assert rows == want and len(got.groupby(KEY)) == 1300
    assert got.FrameSequence.max() == round((2598 * 40 + 90) / 1000 * 30) - 1 > 3000
