"""Invariants from SURVEY §5 on the provided tables."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from paths import SF_ORACLE, SF_SMALL
from plaudit.functions.sampling import BUCKETS
from plaudit.operators import clean as C
from plaudit.operators import games as G
from plaudit.operators import stats as ST
from plaudit.sources import fixtures as FX


@pytest.fixture(scope="module")
def s_reviews(spark):
    return FX.reviews_s(spark, SF_ORACLE).cache()


def test_positive_plus_negative_is_total(s_reviews):
    bad = G.sentiment_counts(s_reviews).filter(
        F.col("positive_reviews") + F.col("negative_reviews") != F.col("total_reviews"))
    assert bad.count() == 0


def test_twin_paths_agree_after_cleaning(spark):
    cleaned = C.clean_reviews(FX.reviews_r(spark, SF_ORACLE), order_by="row_id")
    a = {tuple(r) for r in G.review_counts(cleaned, scored_only=True).collect()}
    b = {tuple(r) for r in G.review_counts(cleaned).collect()}
    assert a == b


def test_percentages_sum_to_100(s_reviews):
    sums = G.review_percentages(s_reviews).groupBy("game").agg(F.sum("percentage").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 100) > 0.011).count() == 0


def test_histogram_counts_sum_to_rows(s_reviews):
    h = ST.histogram(s_reviews, "review_votes", 17)
    assert h.agg(F.sum("n")).first()[0] == s_reviews.count()
    assert h.count() == 17


def test_categories_sum_to_positive_rows(s_reviews):
    pct = G.review_percentages(s_reviews)
    cats = G.percentage_categories(pct)
    positive = pct.filter(F.col("sentiment") == "positive").count()
    assert cats.agg(F.sum("n_games")).first()[0] == positive


def test_density_integrates_to_one(s_reviews):
    d = sorted(ST.density(s_reviews, "review_votes", cut=4.0, grid=400).collect(), key=lambda r: r.i)
    area = sum((b.x - a.x) * (a.density + b.density) / 2 for a, b in zip(d, d[1:]))
    assert abs(area - 1) < 0.01


def test_describe_matches_python(spark):
    lengths = C.review_lengths(C.clean_reviews(FX.reviews_r(spark, SF_ORACLE), order_by="row_id"))
    vals = sorted(r.review_length for r in lengths.collect())
    d = ST.describe(lengths, "review_length").first()
    n = len(vals)
    mean = sum(vals) / n
    std = math.sqrt(sum((v - mean) ** 2 for v in vals) / (n - 1))

    def q(p):
        pos = p * (n - 1)
        lo = math.floor(pos)
        hi = min(lo + 1, n - 1)
        return vals[lo] + (vals[hi] - vals[lo]) * (pos - lo)

    assert d["count"] == n and abs(d.mean - mean) < 1e-9 and abs(d["std"] - std) < 1e-6
    assert abs(d.q25 - q(0.25)) < 1e-9 and abs(d.q50 - q(0.5)) < 1e-9 and abs(d.q75 - q(0.75)) < 1e-9


def test_hash_sample_matches_brute_force(spark):
    s = FX.reviews_s(spark, SF_SMALL)
    got = sorted(r.row_id for r in C.sample_reviews(s, 0.1, keys=["row_id"]).collect())
    ids = [r.row_id for r in s.select("row_id").collect()]
    want = sorted(i for i in ids
                  if int(hashlib.md5(f"42|{i}".encode()).hexdigest()[:5], 16) < round(0.1 * BUCKETS))
    assert got == want and 0 < len(got) < len(ids)


def test_hash_sample_independent_of_layout(spark):
    s = FX.reviews_s(spark, SF_ORACLE)
    a = sorted(r.row_id for r in C.sample_reviews(s, 0.1, keys=["row_id"]).collect())
    b = sorted(r.row_id for r in C.sample_reviews(s.repartition(7), 0.1, keys=["row_id"]).collect())
    assert a == b
    n = s.count()
    assert 0.08 * n < len(a) < 0.12 * n


def test_sample_fraction_outside_range_keeps_all(spark):
    s = FX.reviews_s(spark, SF_SMALL)
    assert C.sample_reviews(s, 1.0).count() == s.count()
    assert C.sample_reviews(s, 0.0).count() == s.count()


def test_approximate_quantiles_close_to_exact(spark):
    s = FX.reviews_s(spark, SF_ORACLE)
    exact = ST.describe(s, "review_votes").first()
    approx = ST.describe(s, "review_votes", accuracy=1000).first()
    for c in ("q25", "q50", "q75"):
        assert abs(exact[c] - approx[c]) <= 1.0
    assert exact["count"] == approx["count"]
    box = ST.box_stats(s, "review_votes", accuracy=1000).first()
    assert abs(box.median - exact.q50) <= 1.0


def test_sampled_cloud_uses_only_sampled_reviews(spark):
    import __spark_entry__ as E
    from plaudit.operators import text as TX
    got = E.queries()["cloud_weights_sampled"](spark, SF_ORACLE).collect()
    cleaned = C.clean_reviews(FX.reviews_r(spark, SF_ORACLE), order_by="row_id")
    sampled = C.sample_reviews(cleaned, 0.1, keys=["row_id"])
    want = [(r.word, r.freq, round(r.weight, 6))
            for r in TX.cloud_weights(TX.cleaned_word_freq(sampled), 150).collect()]
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 0
    assert max(r.weight for r in got) == 1.0
