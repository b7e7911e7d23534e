"""Sentiment label of a review score.

Two rules:

* ``"equals_one"`` (default): positive exactly when the score equals 1, as
  the original job does on every scale (the computed threshold is unused).
* ``"threshold"``: positive when ``score >= threshold``; ``threshold`` may be
  a number or a Column (for example the scalar from ``score_profile``).

A null score is negative under both rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE = "positive"
NEGATIVE = "negative"
RULES = ("equals_one", "threshold")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_positive(score="review_score", rule: str = "equals_one", threshold=None) -> Column:
    """Null-safe boolean: never null, null scores are False."""
    s = _col(score)
    if rule == "equals_one":
        cond = s == F.lit(1.0)
    elif rule == "threshold":
        if threshold is None:
            raise ValueError("rule='threshold' needs a threshold")
        t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
        cond = s >= t
    else:
        raise ValueError(f"unknown sentiment rule {rule!r}; expected one of {RULES}")
    return F.coalesce(cond, F.lit(False))


def sentiment(score="review_score", rule: str = "equals_one", threshold=None) -> Column:
    return F.when(is_positive(score, rule, threshold), F.lit(POSITIVE)).otherwise(F.lit(NEGATIVE))
