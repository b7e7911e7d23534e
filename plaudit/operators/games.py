"""Per-game aggregates, percentages and top-k lists.

Every per-game table derives from one ``groupBy(game)`` with partial
aggregation, so a game holding a third of all reviews is pre-aggregated on
the map side and costs one row per task in the shuffle. Top-k lists are
``orderBy(...).limit(n)`` (TakeOrderedAndProject) with the game name as the
last sort key, so ties are deterministic. Gates ("only if at least N games
qualify") are scalar subqueries in a filter: the result is empty when the
gate is closed, and nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plaudit.functions.sentiment import NEGATIVE, POSITIVE, is_positive

# FIXED VALUES — sizes and limits of the original job's tables and charts.
TOP_N = 10
MIN_GAME_REVIEWS = 10          # games_sentiment HAVING total_reviews >= 10
MIN_PERCENTAGE_TOTAL = 5       # review_percentages HAVING total_by_game >= 5
TOP_REVIEWED_N = 20
TOP_REVIEWED_MIN_GAMES = 10
LOW_POSITIVE_MAX_PCT = 10.0
LOW_POSITIVE_N = 15
LOW_POSITIVE_MIN_GAMES = 5
LOW_EXTENDED_MAX_PCT = 20.0
LOW_EXTENDED_N = 20
LABEL_MAX_CHARS = 30
VERY_LOW_PCT = 5.0
PERCENTAGE_CATEGORY_EDGES = (0, 5, 10, 15, 20, 25, 30, 40, 50, 100)
PERCENTAGE_CATEGORY_LABELS = ("0-5%", "5-10%", "10-15%", "15-20%", "20-25%",
                              "25-30%", "30-40%", "40-50%", "50%+")
BUBBLE_DIVISOR = 50.0


def _scored(df: DataFrame, scored_only: bool) -> DataFrame:
    return df.filter(F.col("review_score").isNotNull()) if scored_only else df


def game_metrics(df: DataFrame, rule: str = "equals_one", threshold=None) -> DataFrame:
    """One row per game: review_count, scored_count, score_sum, positive.

    Every per-game table below is a projection of this single aggregate
    (Catalyst drops the parts a projection does not use). ``run_all``
    writes it once and derives all per-game outputs from the written table,
    instead of scanning the reviews once per output.
    """
    return df.groupBy("game").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.count("review_score").alias("scored_count"),
        F.sum("review_score").alias("score_sum"),
        F.count_if(is_positive("review_score", rule, threshold)).alias("positive"),
    )


def review_counts_from_metrics(gm: DataFrame) -> DataFrame:
    return gm.select("game", "review_count")


def avg_scores_from_metrics(gm: DataFrame) -> DataFrame:
    return gm.select("game", F.try_divide(F.col("score_sum"), F.col("scored_count"))
                     .alias("avg_review_score"))


def sentiment_counts_from_metrics(gm: DataFrame) -> DataFrame:
    return gm.select(
        "game",
        F.col("positive").alias("positive_reviews"),
        (F.col("review_count") - F.col("positive")).alias("negative_reviews"),
        F.col("review_count").alias("total_reviews"),
        F.try_divide(F.col("positive"), F.col("review_count")).alias("positive_ratio"),
    )


def games_sentiment_from_metrics(gm: DataFrame, min_reviews: int = MIN_GAME_REVIEWS) -> DataFrame:
    return gm.filter(F.col("review_count") >= min_reviews).select(
        "game",
        F.col("positive").alias("positive"),
        (F.col("review_count") - F.col("positive")).alias("negative"),
        F.col("review_count").alias("total_reviews"),
        F.try_divide(F.col("positive"), F.col("review_count")).alias("positive_ratio"),
    )


def review_percentages_from_metrics(gm: DataFrame, min_reviews: int = MIN_PERCENTAGE_TOTAL,
                                    include_zero: bool = False) -> DataFrame:
    g = gm.filter(F.col("review_count") >= min_reviews)
    total, pos = F.col("review_count"), F.col("positive")
    sides = F.array(
        F.struct(F.lit(POSITIVE).alias("sentiment"), pos.alias("count")),
        F.struct(F.lit(NEGATIVE).alias("sentiment"), (total - pos).alias("count")),
    )
    out = g.select("game", total.alias("total_by_game"), F.inline(sides))
    if not include_zero:
        out = out.filter(F.col("count") > 0)
    return out.select(
        "game", "sentiment", "count", "total_by_game",
        F.round(F.col("count") / F.col("total_by_game") * 100, 2).alias("percentage"),
    )


def top_games_from_metrics(gm: DataFrame, n: int = TOP_N) -> DataFrame:
    return review_counts_from_metrics(gm).orderBy(
        F.col("review_count").desc(), F.col("game").asc_nulls_last()).limit(n)


def review_counts(df: DataFrame, scored_only: bool = False) -> DataFrame:
    """(game, review_count); ``scored_only`` drops null scores first."""
    return review_counts_from_metrics(game_metrics(_scored(df, scored_only)))


def avg_scores(df: DataFrame, scored_only: bool = False) -> DataFrame:
    """(game, avg_review_score): mean of the non-null scores."""
    return avg_scores_from_metrics(game_metrics(_scored(df, scored_only)))


def sentiment_counts(df: DataFrame, scored_only: bool = False, rule: str = "equals_one",
                     threshold=None) -> DataFrame:
    """(game, positive_reviews, negative_reviews, total_reviews, positive_ratio).

    One aggregate instead of count-by-(game, sentiment) + pivot; a missing
    side is 0 and the group key is never filled (a null game stays null).
    The ratio is null when there are no reviews (D3, D6, D7).
    """
    return sentiment_counts_from_metrics(game_metrics(_scored(df, scored_only), rule, threshold))


def games_sentiment(df: DataFrame, min_reviews: int = MIN_GAME_REVIEWS, rule: str = "equals_one",
                    threshold=None) -> DataFrame:
    """(game, positive, negative, total_reviews, positive_ratio) for games with
    at least ``min_reviews`` reviews (D8)."""
    return games_sentiment_from_metrics(game_metrics(df, rule, threshold), min_reviews)


def review_percentages(df: DataFrame, min_reviews: int = MIN_PERCENTAGE_TOTAL,
                       include_zero: bool = False, rule: str = "equals_one",
                       threshold=None) -> DataFrame:
    """(game, sentiment, count, total_by_game, percentage).

    Rows exist only for sentiments a game actually has (a game without any
    positive review has no positive row) unless ``include_zero``. Computed
    from the per-game aggregate and unfolded into at most two rows per game,
    so there is one shuffle and no window over a possibly huge game.
    """
    return review_percentages_from_metrics(game_metrics(df, rule, threshold), min_reviews,
                                           include_zero)


def percentage_summary(pct: DataFrame) -> DataFrame:
    """Per sentiment: number of games, mean and median percentage."""
    return pct.groupBy("sentiment").agg(
        F.count(F.lit(1)).alias("n_games"),
        F.avg("percentage").alias("mean_percentage"),
        F.median("percentage").alias("median_percentage"),
    )


def app_key(df: DataFrame) -> str:
    return "app_name" if "app_name" in df.columns else "game"


def app_avg_scores(df: DataFrame) -> DataFrame:
    """(app_name, avg_review_score); grouped by ``game`` when there is no
    ``app_name`` column (D10). Unsorted; ``top_apps_by_avg`` orders."""
    key = app_key(df)
    return df.groupBy(key).agg(F.avg("review_score").alias("avg_review_score"))


def top_apps_from_avg(app_avg: DataFrame, n: int = TOP_N) -> DataFrame:
    """First ``n`` rows of an ``app_avg_scores`` table, best average first."""
    key = app_avg.columns[0]
    return app_avg.orderBy(F.col("avg_review_score").desc_nulls_last(),
                           F.col(key).asc_nulls_last()).limit(n)


def top_apps_by_avg(df: DataFrame, n: int = TOP_N) -> DataFrame:
    return top_apps_from_avg(app_avg_scores(df), n)


def top_games(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """Most reviewed games."""
    return top_games_from_metrics(game_metrics(df), n)


def top_positive_games(gs: DataFrame, n: int = TOP_N) -> DataFrame:
    """Highest positive ratio among ``games_sentiment`` rows."""
    return gs.orderBy(F.col("positive_ratio").desc_nulls_last(),
                      F.col("game").asc_nulls_last()).limit(n)


def bottom_positive_games(gs: DataFrame, n: int = TOP_N) -> DataFrame:
    """Lowest positive ratio."""
    return gs.orderBy(F.col("positive_ratio").asc_nulls_last(),
                      F.col("game").asc_nulls_last()).limit(n)


def _first_if(df: DataFrame, order: list, n: int, min_games: int | None, counted) -> DataFrame:
    """First ``n`` rows in ``order``; with ``min_games`` none unless at
    least that many of its rows are ``counted``. Rows that count come first in
    the order, so the first ``max(n, min_games)`` rows decide: one pass, and
    the windows run over those few rows."""
    if min_games is None:
        return df.orderBy(*order).limit(n)
    few = df.orderBy(*order).limit(max(n, min_games))
    enough = F.count_if(counted).over(Window.partitionBy()) >= min_games
    rank = F.row_number().over(Window.orderBy(*order))
    return (few.withColumn("_enough", enough & (rank <= n)).filter("_enough").drop("_enough"))


def top_reviewed_games(gs: DataFrame, n: int = TOP_REVIEWED_N,
                       min_games: int | None = None) -> DataFrame:
    """Top games by total reviews (E5); with ``min_games`` none for fewer games
    (the original draws the chart from 10 on, ``TOP_REVIEWED_MIN_GAMES``)."""
    order = [F.col("total_reviews").desc(), F.col("game").asc_nulls_last()]
    return _first_if(gs, order, n, min_games, F.lit(True))


def _positive_rows(pct: DataFrame) -> DataFrame:
    return pct.filter(F.col("sentiment") == POSITIVE)


def _lowest(pct: DataFrame, max_pct: float, n: int, min_games: int | None) -> DataFrame:
    low = _positive_rows(pct).filter(F.col("percentage") <= max_pct)
    order = [F.col("percentage").asc(), F.col("game").asc_nulls_last()]
    return _first_if(low, order, n, min_games, F.col("percentage") <= LOW_POSITIVE_MAX_PCT)


def low_positive_games(pct: DataFrame, max_pct: float = LOW_POSITIVE_MAX_PCT,
                       n: int = LOW_POSITIVE_N, min_games: int | None = None) -> DataFrame:
    """Games whose positive share is at most ``max_pct``, lowest first, first
    ``n`` (E6). With ``min_games`` none unless that many games are at or under
    10 % (the original draws the low-positive charts from 5 on,
    ``LOW_POSITIVE_MIN_GAMES``); E7, E8 and G9 take the same argument."""
    return _lowest(pct, max_pct, n, min_games).select("game", "percentage")


def low_positive_extended(pct: DataFrame, max_pct: float = LOW_EXTENDED_MAX_PCT,
                          n: int = LOW_EXTENDED_N, min_games: int | None = None) -> DataFrame:
    """Wider list (<= 20 %, first 20) with a label cut to 30 characters plus
    ``...`` (E7)."""
    label = F.when(F.length("game") > LABEL_MAX_CHARS,
                   F.concat(F.substring("game", 1, LABEL_MAX_CHARS), F.lit("..."))
                   ).otherwise(F.col("game"))
    return _lowest(pct, max_pct, n, min_games).select("game", label.alias("label"), "percentage")


def low_positive_summary(pct: DataFrame, min_games: int | None = None) -> DataFrame:
    """One row: games at <= 10 % and <= 5 % positive, the worst game and its
    percentage, ties by name (E8)."""
    pos = _positive_rows(pct)
    low = F.col("percentage") <= LOW_POSITIVE_MAX_PCT
    worst = F.min(F.when(low, F.struct(F.col("percentage"), F.col("game"))))
    out = pos.agg(
        F.count_if(low).alias("n_le_10"),
        F.count_if(F.col("percentage") <= VERY_LOW_PCT).alias("n_le_5"),
        worst.alias("_worst"),
    )
    if min_games is not None:
        out = out.filter(F.col("n_le_10") >= min_games)
    return out.select("n_le_10", "n_le_5", F.col("_worst.game").alias("worst_game"),
                      F.col("_worst.percentage").alias("worst_percentage"))


def percentage_categories(pct: DataFrame, min_games: int | None = None) -> DataFrame:
    """Games per positive-percentage band (G9): right-closed bands over
    0,5,10,...,50,100, the first one also holding 0; every band is present
    (count 0 when empty).

    A single global aggregate of nine conditional counts, unfolded to nine
    rows — no join against a label table.
    """
    p = F.col("percentage")
    edges = PERCENTAGE_CATEGORY_EDGES
    counts = []
    for i, label in enumerate(PERCENTAGE_CATEGORY_LABELS):
        lo, hi = edges[i], edges[i + 1]
        cond = ((p >= lo) if i == 0 else (p > lo)) & (p <= hi)
        counts.append(F.struct(F.lit(i).alias("ord"), F.lit(label).alias("category"),
                               F.count_if(cond).alias("n_games")))
    out = _positive_rows(pct).agg(F.array(*counts).alias("_c"),
                                  F.count_if(p <= LOW_POSITIVE_MAX_PCT).alias("_low"))
    if min_games is not None:
        out = out.filter(F.col("_low") >= min_games)
    return out.select(F.inline("_c"))


def score_distribution(df: DataFrame) -> DataFrame:
    """(review_score, count) over all rows."""
    return df.groupBy("review_score").agg(F.count(F.lit(1)).alias("count"))


def popularity_points(gs: DataFrame) -> DataFrame:
    """Popularity against quality (G10): total, ratio, log10 total, bubble size."""
    return gs.select(
        "game", "total_reviews", "positive_ratio",
        F.log10(F.col("total_reviews")).alias("log10_total"),
        (F.col("total_reviews") / F.lit(BUBBLE_DIVISOR)).alias("bubble_size"),
    )
