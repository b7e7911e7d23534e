"""Streaming per-game counts equal the batch operator on the same rows."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from plaudit.operators import clean as C
from plaudit.operators import games as G
from plaudit.sources import fixtures as FX
from plaudit.streaming import start_game_sentiment


def test_stream_matches_batch(spark, tmp_path):
    e = FX.reviews_e(spark, SF_SMALL)
    folder = str(tmp_path / "incoming")
    first, second = e.filter(F.col("row_id") % 2 == 0), e.filter(F.col("row_id") % 2 == 1)
    first.write.parquet(f"{folder}/part1")
    q = start_game_sentiment(spark, f"{folder}/*", e.schema, "plaudit_stream_test",
                             checkpoint=str(tmp_path / "ckpt"))
    try:
        q.processAllAvailable()
        second.write.parquet(f"{folder}/part2")
        q.processAllAvailable()
        got = {tuple(r) for r in spark.table("plaudit_stream_test").collect()}
    finally:
        q.stop()
    want = {tuple(r) for r in G.sentiment_counts(C.clean_reviews(e, dedup=False)).collect()}
    assert got == want and len(got) > 10


def test_stream_to_parquet_table(spark, tmp_path):
    e = FX.reviews_e(spark, SF_SMALL)
    folder = str(tmp_path / "incoming")
    e.write.parquet(f"{folder}/part1")
    out = str(tmp_path / "table")
    q = start_game_sentiment(spark, f"{folder}/*", e.schema, sink_path=out,
                             checkpoint=str(tmp_path / "ckpt"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    want = {tuple(r) for r in G.sentiment_counts(C.clean_reviews(e, dedup=False)).collect()}
    assert got == want


def test_stream_reads_quoted_csv(spark, tmp_path):
    e = FX.reviews_e(spark, SF_SMALL)  # review_text is JSON: quotes and commas
    folder = str(tmp_path / "incoming")
    e.write.option("header", True).option("escape", '"').csv(f"{folder}/part1")
    schema = ("row_id BIGINT, game_id BIGINT, game STRING, app_name STRING, review_text STRING, "
              "review_score DOUBLE, review_votes DOUBLE")
    q = start_game_sentiment(spark, f"{folder}/*", schema, "plaudit_stream_csv", fmt="csv",
                             checkpoint=str(tmp_path / "ckpt"))
    try:
        q.processAllAvailable()
        got = {tuple(r) for r in spark.table("plaudit_stream_csv").collect()}
    finally:
        q.stop()
    want = {tuple(r) for r in G.sentiment_counts(C.clean_reviews(e, dedup=False)).collect()}
    assert got == want
