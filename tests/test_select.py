"""Bracketed selection, binned densities and the one-scan audit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaudit.operators import clean as C
from plaudit.operators import select as S
from plaudit.operators import stats as ST
from test_plans import plan


def _rows(spark, data):
    return spark.createDataFrame([(g, float(v), int(w)) for g, v, w in data], "group string, value double, _w long")


def _columns():
    rng = np.random.default_rng(5)
    return {
        "skewed": np.exp(rng.normal(0, 12, 3001)), "signs": rng.normal(0, 1, 2000) * 10.0 ** rng.integers(-200, 200, 2000),
        "equal": np.full(500, 7.25), "two": np.r_[np.full(900, -1.0), np.full(901, 1.0)],
        "close": 1 + np.arange(3000) * 2.0 ** -52, "ends": np.r_[[-np.inf] * 3, rng.normal(0, 1, 50), [np.inf] * 9],
        "huge": np.r_[-1.7e308, 1.7e308, rng.normal(0, 1e300, 99)], "one": np.array([3.5]), "zero": np.array([0.0, -0.0, 5e-324, -5e-324])}


def test_every_rank_of_hard_columns(spark):
    """All ranks of all groups in the same rounds, null group included."""
    cols = _columns() | {None: np.arange(40.0)}
    data = [(g, v, 1) for g, x in cols.items() for v in x]
    got = S.rank_values(_rows(spark, data).repartition(5), lambda n: F.transform(
        F.array(F.lit(0.0), F.lit(0.1), F.lit(0.25), F.lit(0.5), F.lit(0.9), F.lit(1.0)),
        lambda p, i: F.struct(i.alias("slot"), (F.floor((n - 1) * p) + 1).cast("long").alias("need")))).collect()
    want = {(g, i): np.sort(x)[int((len(x) - 1) * p)] for g, x in cols.items() for i, p in enumerate((0, .1, .25, .5, .9, 1))}
    assert {(r.group, r.slot): r.value for r in got} == want
    assert all(r.total == len(cols[r.group]) for r in got)


def test_quantiles_match_numpy_with_weights(spark):
    rng = np.random.default_rng(6)
    x, w = rng.lognormal(0, 3, 400), rng.integers(1, 9, 400)
    rows = _rows(spark, [(g, v, k) for g in "ab" for v, k in zip(x * (2 if g == "b" else 1), w)])
    got = {r.group: r._q for r in S.quantiles(rows, [0, 0.05, 0.5, 0.95, 1]).collect()}
    for g, f in (("a", 1), ("b", 2)):
        assert np.allclose(got[g], np.quantile(np.repeat(x * f, w), [0, 0.05, 0.5, 0.95, 1]), rtol=1e-12)
    assert S.quantiles(rows.where("value < 0"), [0.5]).count() == 0


def test_pinned_tables_beyond_the_limit_are_written(spark):
    df = spark.range(50).select(F.col("id").alias("x"))
    assert S.pinned(df, 10).count() == 50 and "parquet" in plan(S.pinned(df, 10))
    assert S.pinned(df, 50).count() == 50 and "parquet" not in plan(S.pinned(df, 50))


def test_no_window_over_values_and_no_fold(spark):
    df = spark.range(1000).select(F.rand(1).alias("v"), (F.col("id") % 2).alias("g"))
    for out in (ST.describe(df, "v", by="g"), ST.box_stats(df, "v", by="g"), ST.histogram(df, "v", 20, by="g")):
        text = plan(out)
        assert "Window" not in text and "value#" not in "".join(
            line for line in text.splitlines() if "hashpartitioning" in line)


@pytest.mark.parametrize("kind", ["normal", "outliers", "ties"])
def test_density_error_bound(spark, kind):
    """Against the full sum: within 1e-12 of the peak."""
    rng = np.random.default_rng(7)
    x = {"normal": rng.normal(5, 2, 4000), "outliers": np.r_[rng.normal(0, 1, 3000), 1e4, -1e4],
         "ties": rng.integers(0, 30, 5000).astype(float)}[kind]
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    out = ST.density(df, "v").orderBy("i").collect()
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    full = np.exp(-0.5 * ((grid[:, None] - x) / bw) ** 2).sum(1) / (len(x) * bw * np.sqrt(2 * np.pi))
    assert len(out) == 200 and np.allclose([r.x for r in out], grid)
    assert np.abs(np.array([r.density for r in out]) - full).max() < 1e-12 * full.max()


def test_audit_counts_what_cleaning_leaves(spark):
    rows = [(1, " a ", "1"), (1, "a", "0"), (2, "a", "x"), (2, "  ", "1"), (None, "a", "1"), (None, "a ", "1"), (3, None, "1"),
            (4, "b", "NaN"), (4, "b", None), (5, "c", "2")]
    df = spark.createDataFrame(rows, "game_id long, review_text string, review_score string")
    for dedup in (True, False):
        got = C.audit_cleaning(df, dedup).first()
        assert (got.rows_before, got.rows_after) == (10, C.clean_reviews(df, dedup=dedup).count())
    assert tuple(C.audit_cleaning(df.where("game_id > 9")).first()) == (0, 0)
    text = plan(C.audit_cleaning(df.withColumn("review_score", F.lit(1.0))), "simple")
    assert text.count("Scan") == 1
