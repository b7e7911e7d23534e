"""Hand-written edge rows (FIXTURES.md §2) through the CSV reader and operators."""

import math

import pytest
from pyspark.sql import functions as F

from plaudit.functions.text import STOP_WORDS, clean_text
from plaudit.operators import clean as C
from plaudit.operators import games as G
from plaudit.operators import scale as SC
from plaudit.operators import stats as ST
from plaudit.operators import text as TX
from plaudit.sources.reviews import read_reviews, standardize_columns

HEADER = "Game ID,app_name,Game Name,review_text,review_score,review_votes"
ROWS = [
    '1,app1,Alpha,"line one\nline two, with ""quotes""",1,3',   # quoted newline/comma/quote
    "2,app2,Beta,,1,0",                                      # empty text
    "3,app3,Gamma,   ,1,0",                                  # spaces only
    '4,app4,Delta,"\t\n",0,0',                               # tab/newline only: kept
    "5,app5,Eps,no score,,0",                                # null score
    "6,app6,Zeta,bad score,abc,0",                           # malformed score
    "7,app7,Eta,nan score,NaN,0",                            # NaN score
    "8,app8,Theta,same text,1,0",                            # duplicate pair ...
    "8,app8,Theta,same text,0,0",                            # ... same game id and text
    "9,app9,Iota,same text,1,0",                             # same text, other game
    "10,app10,,null game a,0,1",                             # null game, twice
    "10,app10,,null game b,1,1",
    "11,app11,Kappa,only negative,0,2",
    "11,app11,Kappa,only negative again,0,5",
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("edge")
    p = d / "reviews.csv"
    p.write_text(HEADER + "\n" + "\n".join(ROWS) + "\n", encoding="utf-8")
    return standardize_columns(read_reviews(spark, str(p)))


@pytest.fixture(scope="module")
def cleaned(raw):
    return C.clean_reviews(raw, order_by="review_score").cache()


def test_multiline_quoted_row(raw):
    rows = raw.filter(F.col("game_id") == "1").collect()
    assert len(rows) == 1
    assert rows[0].review_text == 'line one\nline two, with "quotes"'
    assert raw.count() == len(ROWS)


def test_standardized_names_and_types(raw):
    assert {"game", "game_id", "app_name", "review_text", "review_score", "review_votes"} <= set(raw.columns)
    types = dict(raw.dtypes)
    assert types["review_score"] == "double" and types["review_votes"] == "double"
    assert types["game_id"] == "string"  # ids keep the type they were read with


def test_blank_scores_and_dedup(cleaned):
    ids = sorted(int(r.game_id) for r in cleaned.collect())
    # dropped: 2, 3 (blank), 5, 6, 7 (score); 8 once; 9 kept; 4 (tab/newline) kept
    assert ids == [1, 4, 8, 9, 10, 10, 11, 11]
    # order_by picks the smallest score among the duplicates
    assert cleaned.filter(F.col("game_id") == "8").first().review_score == 0.0


def test_unordered_dedup_keeps_one_per_key(raw):
    out = C.clean_reviews(raw)
    assert out.filter(F.col("review_text") == "same text").count() == 2


def test_tab_only_text_gives_empty_tokens(cleaned):
    wc = {r.word: r["count"] for r in TX.word_counts(cleaned.filter(F.col("game_id") == "4")).collect()}
    assert wc == {"": 2}


def test_null_game_is_one_group_not_zero(cleaned):
    sc = {r.game: r for r in G.sentiment_counts(cleaned).collect()}
    assert None in sc and 0 not in sc
    assert sc[None].total_reviews == 2 and sc[None].positive_reviews == 1


def test_only_negative_game(cleaned):
    sc = {r.game: r for r in G.sentiment_counts(cleaned).collect()}
    assert sc["Kappa"].positive_reviews == 0 and sc["Kappa"].positive_ratio == 0.0
    pct = G.review_percentages(cleaned, min_reviews=1)
    kappa = {r.sentiment for r in pct.filter(F.col("game") == "Kappa").collect()}
    assert kappa == {"negative"}
    with_zero = G.review_percentages(cleaned, min_reviews=1, include_zero=True)
    assert with_zero.filter((F.col("game") == "Kappa") & (F.col("sentiment") == "positive")).count() == 1


def test_having_limits(spark):
    rows = [("g9", 1.0)] * 9 + [("g10", 1.0)] * 10 + [("g4", 0.0)] * 4 + [("g5", 0.0)] * 5
    df = spark.createDataFrame(rows, "game string, review_score double")
    assert {r.game for r in G.games_sentiment(df).collect()} == {"g10"}
    assert {r.game for r in G.review_percentages(df).collect()} == {"g5", "g9", "g10"}


def test_ties_ordered_by_game(spark):
    rows = [("b", 1.0), ("a", 1.0), ("c", 0.0)]
    df = spark.createDataFrame(rows, "game string, review_score double")
    assert [r.game for r in G.top_games(df, n=2).collect()] == ["a", "b"]


def test_constant_scores(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in range(10)], "a double, b double")
    cm = {(r.x, r.y): r.r for r in ST.correlation_matrix(df).collect()}
    assert cm[("a", "b")] is None and cm[("b", "b")] is None
    assert abs(cm[("a", "a")] - 1.0) < 1e-12
    h = ST.histogram(df, "b", 20).orderBy("bin").collect()
    assert len(h) == 20 and h[0].lo == 2.5 and h[-1].hi == 3.5
    assert sum(r.n for r in h) == 10 and h[10].n == 10


def test_token_cleaner(spark):
    df = spark.createDataFrame([("Games PLAYED 123 don't café",), (None,)], "t string")
    assert [r.c for r in df.select(clean_text("t").alias("c")).collect()] == ["caf", ""]


def test_stop_words_fixed():
    assert len(STOP_WORDS) == 247 and "game" in STOP_WORDS and "being" in STOP_WORDS


def test_app_name_fallback(spark):
    df = spark.createDataFrame([(1, "x", "hello", 1.0)], "app_id long, app_name string, review_text string, review_score double")
    std = standardize_columns(df)
    assert "game" in std.columns and "game_id" in std.columns and "app_name" not in std.columns
    assert G.app_avg_scores(std).columns == ["game", "avg_review_score"]


def test_score_profile_branches(spark):
    def prof(values):
        df = spark.createDataFrame([(v,) for v in values], "review_score double")
        return SC.score_profile(df).first()
    assert prof([-1.0, 1.0]).threshold == 1.0 and prof([-1.0, 1.0]).binary
    assert prof([1.0, 3.0, 5.0]).threshold == 4.0
    assert prof([1.0, 10.0]).threshold == 7.0
    wide = prof([float(v) for v in range(1, 101)])
    assert not wide.binary and 49.0 <= wide.threshold <= 51.0
    empty = SC.score_profile(spark.createDataFrame([], "review_score double")).first()
    assert empty.threshold == 4.0 and not empty.binary and empty["distinct"] == 0


def test_threshold_rule(spark):
    df = spark.createDataFrame([("g", 5.0), ("g", 4.0), ("g", 1.0)], "game string, review_score double")
    eq1 = G.sentiment_counts(df).first()
    thr = G.sentiment_counts(df, rule="threshold", threshold=SC.score_threshold(df)).first()
    assert eq1.positive_reviews == 1          # the original job: score == 1
    assert thr.positive_reviews == 2          # score >= 4 on a five-star scale


def test_low_positive_gate_and_categories(spark):
    rows = []
    for i, pos in enumerate([0, 1, 1, 1, 1, 1, 3, 10, 20]):
        rows += [(f"g{i}", 1.0)] * pos + [(f"g{i}", 0.0)] * (20 - pos)
    df = spark.createDataFrame(rows, "game string, review_score double")
    pct = G.review_percentages(df)
    low = G.low_positive_games(pct).collect()
    assert [r.game for r in low][:5] == ["g1", "g2", "g3", "g4", "g5"]
    cats = {r.category: r.n_games for r in G.percentage_categories(pct).collect()}
    assert cats["0-5%"] == 5 and cats["10-15%"] == 1 and cats["40-50%"] == 1
    assert cats["50%+"] == 1 and cats["5-10%"] == 0 and len(cats) == 9
    summ = G.low_positive_summary(pct).first()
    assert summ.n_le_10 == 5 and summ.worst_game == "g1" and summ.worst_percentage == 5.0
    # fewer than five low games: everything gated empty
    closed = G.review_percentages(df.filter(~F.col("game").isin("g1", "g2")))
    assert G.low_positive_games(closed, min_games=5).count() == 0
    assert G.low_positive_extended(closed, min_games=5).count() == 0
    assert G.low_positive_summary(closed, min_games=5).count() == 0
    assert G.percentage_categories(closed, min_games=5).count() == 0
    # no gate by default, an open gate changes nothing
    assert G.low_positive_games(closed).count() == 3 and G.percentage_categories(closed).count() == 9
    assert G.low_positive_games(pct, min_games=5).collect() == low
    assert G.low_positive_games(pct, n=2, min_games=5).collect() == low[:2]
    assert G.low_positive_extended(pct, min_games=5).count() == G.low_positive_extended(pct).count() == 6


def test_box_stats_matches_numpy(spark):
    np = pytest.importorskip("numpy")
    vals = [1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 40.0, -30.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    b = ST.box_stats(df, "v").first()
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    iqr = q3 - q1
    inside = [v for v in vals if q1 - 1.5 * iqr <= v <= q3 + 1.5 * iqr]
    assert (b.q1, b.median, b.q3) == (q1, med, q3)
    assert b.whisker_lo == min(inside) and b.whisker_hi == max(inside) and b.n_outliers == 2


def test_density_matches_direct_sum(spark):
    vals = [1.0, 2.0, 2.0, 3.5, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    out = sorted(ST.density(df, "v", grid=5).collect(), key=lambda r: r.i)
    n = len(vals)
    mean = sum(vals) / n
    std = math.sqrt(sum((v - mean) ** 2 for v in vals) / (n - 1))
    bw = std * n ** -0.2
    for r in out:
        expect = sum(math.exp(-0.5 * ((r.x - v) / bw) ** 2) for v in vals) / (n * bw * math.sqrt(2 * math.pi))
        assert abs(r.density - expect) < 1e-12
    assert out[0].x == 1.0 and out[-1].x == 7.0
