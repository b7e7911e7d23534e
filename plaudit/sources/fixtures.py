"""Review-shaped views of the provided parquet tables (see FIXTURES.md).

All views share the standardised schema ``row_id, game_id, game, app_name,
review_text, review_score, review_votes`` except the score-scale views
(``O5``, ``O10``, ``OW``, ``O0``), which only carry ``review_score``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reviews_r(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R: documents as reviews; label quality is the score (null when unlabelled)."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("row_id"),
        F.expr("substr(source, 4)").cast("bigint").alias("game_id"),
        F.col("source").alias("game"),
        F.col("lang").alias("app_name"),
        F.col("text").alias("review_text"),
        F.col("quality").cast("double").alias("review_score"),
        F.col("toxic").cast("double").alias("review_votes"),
    )


def reviews_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D: documents keyed by text only (constant game_id), every row scored."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("row_id"),
        F.lit(0).cast("bigint").alias("game_id"),
        F.col("lang").alias("game"),
        F.col("lang").alias("app_name"),
        F.col("text").alias("review_text"),
        (F.col("doc_id") % 2).cast("double").alias("review_score"),
        F.lit(0.0).alias("review_votes"),
    )


def reviews_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S: line items as reviews of parts; zero discount is a positive review."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    return li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
        F.col("l_partkey").alias("game_id"),
        F.concat(F.lit("part"), F.col("l_partkey").cast("string")).alias("game"),
        F.col("p_brand").alias("app_name"),
        F.lit("").alias("review_text"),
        F.when(F.col("l_discount") == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("review_score"),
        F.col("l_quantity").alias("review_votes"),
    )


def reviews_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E: events as reviews of users; a purchase is a positive review."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").alias("game_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("game"),
        F.col("event_type").alias("app_name"),
        F.col("props").alias("review_text"),
        F.when(F.col("event_type") == "purchase", F.lit(1.0)).otherwise(F.lit(0.0)).alias("review_score"),
        F.col("value").alias("review_votes"),
    )


def scores_o5(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.expr("substr(o_orderpriority, 1, 1)").cast("double").alias("review_score"))


def scores_o10(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_quantity") <= 10).select(F.col("l_quantity").alias("review_score"))


def scores_ow(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_quantity").alias("review_score"))


def reviews_o5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5G: orders as reviews of customers on a 1-5 scale (the priority
    digit), for the score-threshold sentiment rule."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").alias("game_id"),
        F.concat(F.lit("cust"), F.col("o_custkey").cast("string")).alias("game"),
        F.col("o_orderstatus").alias("app_name"),
        F.lit("").alias("review_text"),
        F.expr("substr(o_orderpriority, 1, 1)").cast("double").alias("review_score"),
        F.col("o_totalprice").alias("review_votes"),
    )


def scores_o0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5 restricted to orders with a negative price: none exist, but the
    filter depends on the data, so the whole table is still scanned."""
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_totalprice") < 0).select(
        F.expr("substr(o_orderpriority, 1, 1)").cast("double").alias("review_score"))


VIEWS = {
    "R": reviews_r, "D": reviews_d, "S": reviews_s, "E": reviews_e,
    "O5": scores_o5, "O10": scores_o10, "OW": scores_ow, "O0": scores_o0, "O5G": reviews_o5,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name](spark, sf_dir)
