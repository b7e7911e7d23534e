"""Boundary conditions of the statistics and per-game operators."""

import pytest
from pyspark.sql import functions as F

from plaudit.operators import games as G
from plaudit.operators import stats as ST


@pytest.fixture(scope="module")
def vals(spark):
    return lambda xs: spark.createDataFrame([(x,) for x in xs], "v double")


def test_histogram_single_bin_holds_everything(vals):
    h = ST.histogram(vals([1.0, 2.0, 9.0]), "v", 1).collect()
    assert [(r.bin, r.lo, r.hi, r.n) for r in h] == [(0, 1.0, 9.0, 3)]


def test_histogram_right_edge_in_last_bin(vals):
    h = sorted(ST.histogram(vals([0.0, 5.0, 10.0]), "v", 2).collect(), key=lambda r: r.bin)
    assert [r.n for r in h] == [1, 2]  # 5.0 opens the second bin, 10.0 closes it


def test_histogram_ignores_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert sum(r.n for r in ST.histogram(df, "v", 4).collect()) == 2


def test_density_needs_spread(vals):
    assert ST.density(vals([4.0]), "v").count() == 0
    assert ST.density(vals([4.0, 4.0, 4.0]), "v").count() == 0
    assert ST.density(vals([4.0, 5.0]), "v", grid=7).count() == 7


def test_describe_single_row(vals):
    d = ST.describe(vals([7.0]), "v").first()
    assert d["count"] == 1 and d.mean == 7.0 and d["std"] is None
    assert d.q25 == d.q50 == d.q75 == d["min"] == d["max"] == 7.0


def test_box_stats_constant(vals):
    b = ST.box_stats(vals([2.0] * 5), "v").first()
    assert (b.q1, b.median, b.q3, b.iqr, b.whisker_lo, b.whisker_hi, b.n_outliers) == (2.0, 2.0, 2.0, 0.0, 2.0, 2.0, 0)


def test_correlation_with_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None)], "a double, b double")
    cm = {(r.x, r.y): r.r for r in ST.correlation_matrix(df).collect()}
    assert cm[("a", "b")] is None and cm[("b", "b")] is None and abs(cm[("a", "a")] - 1) < 1e-12


def test_grouped_stats_keep_a_null_group(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), (None, 2.0), (None, 4.0)], "g string, v double")
    groups = {r.group: r["count"] for r in ST.describe(df, "v", by="g").collect()}
    assert groups == {"x": 2, None: 2}
    h = ST.histogram(df, "v", 2, by="g").collect()
    assert sum(r.n for r in h if r.group is None) == 2 and len(h) == 4


def test_categories_edges_are_right_closed(spark):
    rows = [(f"g{i}", "positive", p) for i, p in enumerate([0.0, 5.0, 5.01, 10.0, 50.0, 50.01, 100.0])]
    rows += [(f"low{i}", "positive", 1.0) for i in range(5)]  # open the gate
    pct = spark.createDataFrame(rows, "game string, sentiment string, percentage double")
    cats = {r.category: r.n_games for r in G.percentage_categories(pct).collect()}
    assert cats["0-5%"] == 7 and cats["5-10%"] == 2 and cats["40-50%"] == 1 and cats["50%+"] == 2


def test_top_k_larger_than_table(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "game string, review_score double")
    assert [r.game for r in G.top_games(df, n=10).collect()] == ["a", "b"]


def test_percentages_without_minimum(spark):
    df = spark.createDataFrame([("a", 1.0)], "game string, review_score double")
    out = G.review_percentages(df, min_reviews=0, include_zero=True).collect()
    assert sorted((r.sentiment, r["count"], r.percentage) for r in out) == [
        ("negative", 0, 0.0), ("positive", 1, 100.0)]


def test_weighted_fold_equals_rows(spark, vals):
    rows = vals([1.0, 1.0, 2.0, 5.0, 5.0, 5.0])
    folded = spark.createDataFrame([(1.0, 2), (2.0, 1), (5.0, 3)], "v double, n long")
    a = ST.describe(rows, "v").first()
    b = ST.describe(folded, "v", weight="n").first()
    assert a == b
    with pytest.raises(ValueError):
        ST.describe(folded, "v", weight="n", accuracy=100)


def _games(spark, n_games, per_game=10):
    rows = [(f"g{i:02d}", 1.0 if j == 0 else 0.0) for i in range(n_games) for j in range(per_game)]
    return spark.createDataFrame(rows, "game string, review_score double")


def test_top_reviewed_gate_at_ten_games(spark):
    ten, nine = (G.games_sentiment(_games(spark, k)) for k in (10, 9))
    assert G.top_reviewed_games(ten, min_games=10).count() == 10
    assert G.top_reviewed_games(nine, min_games=10).count() == 0
    assert G.top_reviewed_games(nine).count() == 9  # no gate by default
    assert [r.game for r in G.top_reviewed_games(ten, n=3, min_games=10).collect()] == ["g00", "g01", "g02"]
    assert G.top_reviewed_games(nine, n=3, min_games=10).count() == 0


def test_extended_label_cut(spark):
    long_name = "x" * 31
    rows = [(long_name, "positive", 1.0)] + [(f"g{i}", "positive", 2.0) for i in range(5)]
    pct = spark.createDataFrame(rows, "game string, sentiment string, percentage double")
    labels = {r.game: r.label for r in G.low_positive_extended(pct).collect()}
    assert labels[long_name] == "x" * 30 + "..." and labels["g0"] == "g0"


def test_empty_inputs(spark):
    from plaudit.operators import clean as C
    from plaudit.operators import scale as SC
    from plaudit.operators import text as TX
    empty = spark.createDataFrame([], "game string, review_text string, review_score double")
    assert SC.global_sentiment_summary(empty).count() == 0  # not binary: no summary
    assert C.cleaning_audit(empty, C.clean_reviews(empty)).first() == (0, 0)
    assert TX.cloud_weights(TX.cleaned_word_freq(empty)).count() == 0
    assert ST.histogram(empty, "review_score", 5).count() == 0
    none = G.review_percentages(empty)
    assert G.percentage_categories(none, min_games=5).count() == 0
    assert [r.n_games for r in G.percentage_categories(none).collect()] == [0] * 9


def test_dedup_without_game_id_uses_game(spark):
    from plaudit.operators import clean as C
    df = spark.createDataFrame([("a", "t", 1.0), ("a", "t", 0.0), ("b", "t", 1.0)],
                               "game string, review_text string, review_score double")
    assert C.dedup_key(df) == ["game", "review_text"]
    assert C.clean_reviews(df).count() == 2


def test_sample_default_key_ignores_added_columns(spark):
    from plaudit.operators import clean as C
    df = spark.createDataFrame([(i % 7, f"text {i}", 1.0) for i in range(2000)],
                               "game_id long, review_text string, review_score double")
    a = {(r.game_id, r.review_text) for r in C.sample_reviews(df, 0.2).collect()}
    b = {(r.game_id, r.review_text) for r in C.sample_reviews(df.withColumn("extra", F.lit(1)), 0.2).collect()}
    assert a == b and 300 < len(a) < 500


def test_correlation_data_without_votes(spark):
    from plaudit.operators import clean as C
    df = spark.createDataFrame([("abc", 1.0)], "review_text string, review_score double")
    assert C.correlation_data(df).columns == ["review_length", "review_score"]


def test_raw_word_counts_keep_case_and_punctuation(spark):
    from plaudit.operators import text as TX
    df = spark.createDataFrame([("Good  game, good game!",)], "review_text string")
    wc = {r.word: r["count"] for r in TX.word_counts(df).collect()}
    assert wc == {"Good": 1, "game,": 1, "good": 1, "game!": 1}
