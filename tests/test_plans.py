"""Physical-plan checks: JVM-only expressions, no cartesian joins, pushdown."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from paths import SF_SMALL
from plaudit.operators import clean as C
from plaudit.operators import games as G
from plaudit.plans import catalog
from plaudit.sources import fixtures as FX

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin")


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_no_cartesian(spark, name):
    text = plan(E.queries()[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in text, f"{name}: {node} in plan"


def test_scan_pruning_and_pushdown(spark):
    o10 = FX.scores_o10(spark, SF_SMALL)
    text = plan(G.score_distribution(o10))
    assert "ReadSchema: struct<l_quantity:double>" in text
    assert "LessThanOrEqual(l_quantity,10.0)" in text


def test_per_game_counts_do_not_read_text(spark):
    text = plan(G.review_counts(FX.reviews_r(spark, SF_SMALL)))
    assert "text" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_dedup_aggregates_partially_before_shuffle(spark):
    d = FX.reviews_d(spark, SF_SMALL)
    text = plan(C.dedup_reviews(d, order_by="row_id"))
    assert "partial_min" in text
    assert text.index("partial_min") > text.index("Exchange")  # formatted plan lists the partial step after


def test_gates_need_no_second_pass(spark):
    pct = G.review_percentages(FX.reviews_s(spark, SF_SMALL))
    for df in (G.low_positive_games(pct, min_games=5), G.low_positive_games(pct, n=2, min_games=5),
               G.low_positive_extended(pct, min_games=5), G.low_positive_summary(pct, min_games=5),
               G.percentage_categories(pct, min_games=5)):
        text = plan(df)
        assert "Subquery" not in text
        assert text.split("== Physical Plan ==")[1].count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", ["review_counts_s", "sentiment_counts_s", "games_sentiment_s",
                                  "review_percentages_s", "word_counts", "sentiment_word_counts",
                                  "score_distribution", "app_avg_scores_s", "dedup_reviews",
                                  "histogram_score", "density_score"])
def test_aggregates_partially_before_every_shuffle(spark, name):
    """A key holding a third of the rows must be pre-aggregated map-side:
    every hash exchange on a grouping key sits on a partial aggregate."""
    df = E.queries()[name](spark, SF_SMALL)
    physical = df._jdf.queryExecution().executedPlan().toString()
    lines = physical.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and i + 1 < len(lines):
            below = "\n".join(lines[i + 1:i + 3])
            assert "partial_" in below or "Aggregate" in below, f"{name}: exchange without map-side aggregate:\n{physical}"
