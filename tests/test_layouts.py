"""Results that must not depend on the partition layout; fixed word list."""

import hashlib

from pyspark.sql import functions as F

from paths import SF_ORACLE, SF_SMALL
from plaudit.functions.text import STOP_WORDS
from plaudit.operators import clean as C
from plaudit.operators import scale as SC
from plaudit.operators import stats as ST
from plaudit.sources import fixtures as FX
from plaudit.sources.reviews import read_reviews


def test_score_profile_under_layouts(spark):
    df = FX.scores_ow(spark, "/root/testdata/sf0.1")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = set()
    try:
        for n in (1, 2, 8, 50):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.add(SC.score_profile(df).first().threshold)
        seen.add(SC.score_profile(df.repartition(31)).first().threshold)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen == {25.0}


def test_survivor_without_order_by_under_layouts(spark):
    df = FX.reviews_d(spark, SF_ORACLE).withColumn("review_text", F.concat(F.lit("t"), F.col("row_id") % 50))
    a, b = (sorted(map(tuple, C.clean_reviews(x).collect())) for x in (df.repartition(3), df.repartition(17)))
    assert a == b and len(a) == 50
    best = {r.review_text: r.row_id for r in df.groupBy("review_text").agg(F.min("row_id").alias("row_id")).collect()}
    assert {r[df.columns.index("review_text")]: r[df.columns.index("row_id")] for r in a} == best


def test_trimmed_histogram_equals_trimming_the_rows(spark):
    df = C.sentiment_lengths(C.clean_reviews(FX.reviews_r(spark, SF_ORACLE), order_by="row_id"))
    rows = ST.histogram(ST.trim_upper_quantile(df, "review_length", 0.95), "review_length", 20)
    fold = ST.histogram(df, "review_length", 20, upper=0.95)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, fold.collect()))


def test_split_reader_makes_several_tasks(spark, tmp_path):
    FX.reviews_s(spark, SF_ORACLE).coalesce(1).write.option("header", True).csv(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 19)
    try:
        whole = read_reviews(spark, str(tmp_path / "in"))
        parts = read_reviews(spark, str(tmp_path / "in"), multiline=False)
        count = lambda df: df.select(F.spark_partition_id().alias("p")).distinct().count()
        assert count(whole) == 1 < count(parts)
        assert whole.count() == parts.count() == FX.reviews_s(spark, SF_ORACLE).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stop_words_are_pinned():
    assert len(set(STOP_WORDS)) == 247
    assert hashlib.md5(" ".join(sorted(set(STOP_WORDS))).encode()).hexdigest() == "1b55391432357061b90c232b1a0b0efa"


def test_sampled_texts_are_an_option(spark):
    """The same reviews under any layout, about a tenth."""
    df = C.clean_reviews(FX.reviews_r(spark, SF_SMALL))
    a, b = (sorted(r.row_id for r in C.sample_reviews(x, 0.1).collect()) for x in (df, df.repartition(9)))
    assert a == b
