"""Score-scale profile and the global binary summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaudit.functions.sentiment import is_positive
from plaudit.operators.select import lower_median as select_lower_median
from plaudit.operators.select import pinned

# FIXED VALUES — thresholds of the original job: binary scale -> 1,
# max <= 5 -> 4, max <= 10 -> 7, otherwise the median; 4 when
# there is no data (its POSITIVE_THRESHOLD constant). The original allows its median a relative error of 0.01.
BINARY_MAX_DISTINCT = 3
FIVE_STAR_THRESHOLD = 4.0
TEN_POINT_THRESHOLD = 7.0
FALLBACK_THRESHOLD = 4.0


def _binary(mn, mx, distinct):
    """The original's binary-scale test over the aggregate columns."""
    cond = ((distinct <= BINARY_MAX_DISTINCT) & mn.isNotNull() & mx.isNotNull()
            & (mn >= -1) & (mx <= 1))
    return F.coalesce(cond, F.lit(False))


def score_profile(df: DataFrame, score: str = "review_score") -> DataFrame:
    """One row: min, max, distinct, binary, threshold.

    Min, max and distinct are one aggregate. Only a wide scale needs its
    median, found by bracketed selection (``select.rank_values``): exact, the
    same under any layout, and no task holds the values. Both run at once, as
    the scale decides whether the second is needed."""
    s = F.col(score)
    agg = pinned(df.agg(F.min(s).cast("double").alias("min"), F.max(s).cast("double").alias("max"),
                        F.count_distinct(s).alias("distinct")))
    row = agg.select("max", _binary(F.col("min"), F.col("max"), F.col("distinct")).alias("binary")).first()
    if row["binary"]:
        threshold = F.lit(1.0)
    elif row["max"] is None:
        threshold = F.lit(FALLBACK_THRESHOLD)
    elif row["max"] <= 5:
        threshold = F.lit(FIVE_STAR_THRESHOLD)
    elif row["max"] <= 10:
        threshold = F.lit(TEN_POINT_THRESHOLD)
    else:
        threshold = F.coalesce(lower_median(df, score), F.lit(FALLBACK_THRESHOLD))
    return agg.select("min", "max", "distinct", F.lit(bool(row["binary"])).alias("binary"), threshold.alias("threshold"))


def lower_median(df: DataFrame, col: str) -> Column:
    """The smallest value with at least half of the values at or below it, as a
    scalar subquery; null without values."""
    x = F.col(col).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(
        F.lit("all").alias("group"), x.alias("value"), F.lit(1).cast("long").alias("_w"))
    return select_lower_median(rows).select("value").scalar()


def score_threshold(df: DataFrame, score: str = "review_score"):
    """The threshold as a scalar-subquery Column (usable in later filters)."""
    return score_profile(df, score).select("threshold").scalar()


def global_sentiment_summary(df: DataFrame, score: str = "review_score",
                             only_binary: bool = True) -> DataFrame:
    """One row (positive_count, negative_count, positive_ratio 6 dp); empty
    unless the scale is binary (C5), as the original writes it only then.

    The binary test (min, max, distinct) is part of the same aggregate, so
    the input is read once.
    """
    s = F.col(score)
    out = df.agg(
        F.count_if(is_positive(score)).alias("positive_count"),
        F.count(F.lit(1)).alias("_total"),
        _binary(F.min(s), F.max(s), F.count_distinct(s)).alias("_binary"),
    )
    if only_binary:
        out = out.filter(F.col("_binary"))
    return out.select(
        "positive_count",
        (F.col("_total") - F.col("positive_count")).alias("negative_count"),
        F.round(F.coalesce(F.try_divide(F.col("positive_count"), F.col("_total")), F.lit(0.0)), 6)
        .alias("positive_ratio"),
    )
