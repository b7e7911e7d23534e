"""Distribution statistics that the original job computed in driver-side
pandas/numpy for its charts, re-aimed as Spark aggregates (SURVEY §2.7).

Common pattern: the rows are reduced to (group, value, weight) and scanned
narrowly a few times, each time into a bounded number of cells a group:

* quantiles by recursive bracketing of all ranks together (``select``),
* histograms counted map-side after one min/max scan,
* box statistics from the quartiles and one more scan for the fences,
* densities from moments in cells of a sixteenth of the bandwidth.

Distinct values are never shuffled and no task holds a group's values. Per-group
figures (n, mean, min, max, quartiles) are attached as a broadcast table of
checked size (``select.pinned``) or, without grouping, as one scalar subquery.

Quantiles are exact (linear interpolation, as numpy/pandas); ``accuracy=``
takes ``percentile_approx`` sketches instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window  # Window: two-row share totals only
from pyspark.sql import functions as F

from plaudit.functions.sentiment import sentiment as sentiment_expr
from plaudit.operators import select
from plaudit.operators.select import on_group, pinned

# FIXED VALUES — plotting-library defaults the original charts rely on.
BOX_WHISKER = 1.5          # boxplot whiskers at 1.5 IQR
KDE_GRID = 200             # density curve over a histogram: 200 points, cut 0
VIOLIN_GRID = 100          # violin density: 100 points ...
VIOLIN_CUT = 2.0           # ... extended 2 bandwidths past the data
DESCRIBE_PROBS = (0.25, 0.5, 0.75)
KDE_CELLS = 16             # cells of a bandwidth, powers summed in each, reach of the kernel
KDE_ORDER = 8
KDE_REACH = 8.5
DEGENERATE_HALF_WIDTH = 0.5  # numpy histogram range when min == max
ALL = "all"                # group label when no grouping column is given


def _valid(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)



def _base(df: DataFrame, value: str, by: str | None, weight: str | None = None) -> DataFrame:
    v = F.col(value).cast("double")
    g = F.col(by).cast("string") if by else F.lit(ALL)
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return (df.select(g.alias("group"), v.alias("value"), w.alias("_w"))
            .filter(_valid(F.col("value")) & F.col("_w").isNotNull()))


def _attach(rows: DataFrame, per_group: DataFrame, by: str | None) -> DataFrame:
    """Join per-group figures onto ``rows`` (null group is a group too).

    Without grouping there is one group: its figures come in as one
    struct-valued scalar subquery instead of a (constant-key, i.e. cross) join.
    ``per_group`` must then have its row whenever ``rows`` is not empty
    (callers null out figures instead of filtering the summary).
    """
    if by is None:
        cols = [c for c in per_group.columns if c != "group"]
        one = per_group.select(F.struct(*cols).alias("_s")).scalar()
        return rows.select("*", *[one.getField(c).alias(c) for c in cols])
    return on_group(rows, pinned(per_group))


def _moments(base: DataFrame, by: str | None, weighted: bool) -> DataFrame:
    """Per group: _n, _mean, _std (sample), _min, _max of (group, value, _w).
    Weights need a second scan: the mean first, then squared deviations."""
    if not weighted:
        return base.groupBy("group").agg(
            F.count(F.lit(1)).alias("_n"), F.avg("value").alias("_mean"), F.min("value").alias("_min"),
            F.max("value").alias("_max"), F.stddev_samp("value").alias("_std"))
    first = base.groupBy("group").agg(
        F.sum("_w").alias("_n"), F.try_divide(F.sum(F.col("value") * F.col("_w")), F.sum("_w")).alias("_mean"),
        F.min("value").alias("_min"), F.max("value").alias("_max"))
    dev = _attach(base, first, by).groupBy("group").agg(
        F.max("_n").alias("_n"), F.max("_mean").alias("_mean"),
        F.max("_min").alias("_min"), F.max("_max").alias("_max"),
        F.sum(F.col("_w") * (F.col("value") - F.col("_mean")) ** 2).alias("_m2"))
    return dev.select("group", "_n", "_mean", "_min", "_max",
                      F.sqrt(F.try_divide(F.col("_m2"), F.col("_n") - 1)).alias("_std"))


def _quantiles(base: DataFrame, probs: Sequence[float], accuracy: int | None, weighted: bool) -> DataFrame:
    """(group, _q array): exact, or approximate (``percentile_approx`` sketch)
    when ``accuracy`` is set."""
    if not accuracy:
        return select.quantiles(base, probs)
    if weighted:
        raise ValueError("accuracy= works on unweighted rows; a weighted table is folded already")
    return base.groupBy("group").agg(
        F.percentile_approx("value", list(probs), accuracy).cast("array<double>").alias("_q"))


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every column pair, pairwise-complete (G1).

    Output (x, y, r), diagonal included; r is null when a side has zero
    variance or fewer than two complete pairs. One aggregate pass computes
    every pair; ``try_divide(covar_pop, stddev_pop * stddev_pop)`` on the
    rows where both are present stays defined under ANSI mode.
    """
    cols = list(cols) if cols else list(df.columns)
    aggs, cells = [], {}
    for i, a in enumerate(cols):
        for b in cols[i:]:
            both = _valid(F.col(a).cast("double")) & _valid(F.col(b).cast("double"))
            xa = F.when(both, F.col(a).cast("double"))
            xb = F.when(both, F.col(b).cast("double"))
            r = F.try_divide(F.covar_pop(xa, xb), F.stddev_pop(xa) * F.stddev_pop(xb))
            name = f"_r{len(aggs)}"
            clipped = F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0))  # greatest skips nulls
            aggs.append(F.when(r.isNotNull(), clipped).alias(name))
            cells[(a, b)] = cells[(b, a)] = name
    entries = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(cells[(a, b)]).alias("r"))
               for a in cols for b in cols]
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def describe(df: DataFrame, value: str, by: str | None = None,
             probs: Sequence[float] = DESCRIBE_PROBS, accuracy: int | None = None,
             weight: str | None = None) -> DataFrame:
    """count, mean, std (sample), min, quartiles (linear), max per group.

    Quantile columns are named ``q25``, ``q50``, ``q75`` for the default
    probabilities (``q<100*p>`` in general).
    """
    base = _base(df, value, by, weight)
    m = _moments(base, by, weight is not None)
    q = _quantiles(base, probs, accuracy, weight is not None)
    out = _attach(m, q, by)
    qcols = [F.col("_q")[i].alias(f"q{round(p * 100):d}") for i, p in enumerate(probs)]
    return out.select("group", F.col("_n").alias("count"), F.col("_mean").alias("mean"),
                      F.col("_std").alias("std"), F.col("_min").alias("min"), *qcols,
                      F.col("_max").alias("max"))


def describe_lengths(df: DataFrame) -> DataFrame:
    """``describe`` of the review length in characters."""
    return describe(df.select(F.length("review_text").alias("review_length")),
                    "review_length").drop("group")


def quantile(df: DataFrame, value: str, q: float, accuracy: int | None = None,
             weight: str | None = None) -> Column:
    """Quantile of ``value`` (exact, linear; approximate with ``accuracy``)
    as a scalar-subquery Column."""
    qs = _quantiles(_base(df, value, None, weight), [q], accuracy, weight is not None)
    return qs.select(F.col("_q")[0]).scalar()


def quartiles(df: DataFrame, value: str, by: str | None = None, weight: str | None = None) -> DataFrame:
    """(group, q1, median, q3) as values that occur: the smallest with at least
    a quarter, a half, three quarters of the group at or below it. Found
    together, in the same rounds."""
    def ranks(n: Column) -> Column:
        return F.array(*[F.struct(F.lit(i).alias("slot"), F.greatest(
            F.ceil(n * p), F.lit(1)).cast("long").alias("need")) for i, p in enumerate(DESCRIBE_PROBS)])

    found = select.rank_values(_base(df, value, by, weight), ranks).groupBy("group").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "value"))).alias("m"))
    return found.select("group", *[F.col("m")[i].alias(c) for i, c in enumerate(("q1", "median", "q3"))])


def trim_upper_quantile(df: DataFrame, value: str, q: float = 0.95,
                        accuracy: int | None = None, weight: str | None = None) -> DataFrame:
    """Rows whose ``value`` is at most its ``q`` quantile."""
    return df.filter(F.col(value) <= quantile(df, value, q, accuracy, weight))


def _bin_index(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """numpy's equal-width bin of ``v`` on [lo, hi]: right edge closed in the
    last bin, index checked against the linspace edges like numpy does."""
    step = (hi - lo) / bins

    def edge(i: Column) -> Column:
        return F.when(i == bins, hi).otherwise(lo + i * step)

    i0 = ((v - lo) / (hi - lo) * bins).cast("int")
    i1 = F.least(i0, F.lit(bins - 1))
    return (F.when(v < edge(i1), i1 - 1)
            .when((v >= edge(i1 + 1)) & (i1 != bins - 1), i1 + 1)
            .otherwise(i1))


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None,
              weight: str | None = None, upper: float | None = None) -> DataFrame:
    """Equal-width histogram over each group's own min..max (G5). With
    ``upper`` the values over the whole table's ``upper`` quantile are left
    out first (G4). One scan finds the ranges, one counts (group, bin) map-side.

    Output (group, bin, lo, hi, n) with every bin present (n = 0 when
    empty). When min = max the range is widened to min-0.5 .. max+0.5.
    """
    base = _base(df, value, by, weight)
    if upper is not None:
        base = base.filter(F.col("value") <= quantile(df, value, upper, weight=weight))
    span = base.groupBy("group").agg(F.min("value").alias("_min"), F.max("value").alias("_max"))
    same = F.col("_max") == F.col("_min")
    span = span.select(
        "group",
        F.when(same, F.col("_min") - DEGENERATE_HALF_WIDTH).otherwise(F.col("_min")).alias("_lo"),
        F.when(same, F.col("_max") + DEGENERATE_HALF_WIDTH).otherwise(F.col("_max")).alias("_hi"))
    span = pinned(span) if by else span
    binned = on_group(base, span) if by else _attach(base, span, by)
    binned = binned.withColumn("bin", _bin_index(F.col("value"), F.col("_lo"), F.col("_hi"), bins))
    counts = binned.groupBy("group", "bin").agg(F.sum("_w").alias("n"))
    # One row per group with a bin -> count map of at most ``bins`` entries.
    per_group = counts.groupBy("group").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_m"))
    full = (on_group(span, per_group) if by else _attach(span, per_group, None)).select(
        "group", "_lo", "_hi", "_m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = (F.col("_hi") - F.col("_lo")) / bins
    return full.select(
        "group", "bin",
        (F.col("_lo") + F.col("bin") * step).alias("lo"),
        F.when(F.col("bin") == bins - 1, F.col("_hi"))
        .otherwise(F.col("_lo") + (F.col("bin") + 1) * step).alias("hi"),
        F.coalesce(F.element_at(F.col("_m"), F.col("bin")), F.lit(0).cast("long")).alias("n"),
    )


def sentiment_shares(df: DataFrame, rule: str = "equals_one", threshold=None) -> DataFrame:
    """(sentiment, count, percent 1 dp), most frequent first."""
    counts = df.groupBy(sentiment_expr("review_score", rule, threshold).alias("sentiment")).agg(
        F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # over at most two rows
    return counts.select("sentiment", "count",
                         F.round(F.col("count") * 100.0 / total, 1).alias("percent")
                         ).orderBy(F.col("count").desc(), F.col("sentiment"))


def box_stats(df: DataFrame, value: str, by: str | None = None,
              whis: float = BOX_WHISKER, accuracy: int | None = None,
              weight: str | None = None) -> DataFrame:
    """Box-plot statistics per group (G7): n, q1, median, q3, iqr, whiskers
    (most extreme values within ``whis`` IQR of the box, never inside it),
    number of outliers beyond them, min and max."""
    base = _base(df, value, by, weight)
    f = _attach(base, _quantiles(base, [0.25, 0.5, 0.75], accuracy, weight is not None), by)
    q1, q3 = F.col("_q")[0], F.col("_q")[2]
    iqr = q3 - q1
    lo_fence, hi_fence = q1 - whis * iqr, q3 + whis * iqr
    v = F.col("value")
    out = f.groupBy("group").agg(
        F.sum("_w").alias("n"),
        F.max(q1).alias("q1"), F.max(F.col("_q")[1]).alias("median"), F.max(q3).alias("q3"),
        F.min(F.when(v >= lo_fence, v)).alias("_wlo"),
        F.max(F.when(v <= hi_fence, v)).alias("_whi"),
        F.sum(F.when((v < lo_fence) | (v > hi_fence), F.col("_w")).otherwise(0)).alias("n_outliers"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    return out.select(
        "group", "n", "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        F.least(F.coalesce(F.col("_wlo"), F.col("q1")), F.col("q1")).alias("whisker_lo"),
        F.greatest(F.coalesce(F.col("_whi"), F.col("q3")), F.col("q3")).alias("whisker_hi"),
        "n_outliers", "min", "max")


def density(df: DataFrame, value: str, by: str | None = None, grid: int = KDE_GRID,
            cut: float = 0.0, weight: str | None = None) -> DataFrame:
    """Gaussian kernel density per group (G8): (group, i, x, density).

    Scott's rule: bandwidth = sample std * n^(-1/5). Evaluated on ``grid``
    evenly spaced points from min - cut*bw to max + cut*bw. Groups with zero
    variance or a single value get no curve.

    The values are reduced to cells of a sixteenth of a bandwidth, each with the
    sums of the first powers of the distance from its centre. With these the
    kernel's expansion around the centre (Hermite polynomials, remainder below
    1e-14 of the curve's peak) gives a cell's share at every grid point within
    8.5 bandwidths; beyond, the kernel is under 1e-15. So work is cells x near
    grid points, whatever the number of values or distinct values."""
    base = _base(df, value, by, weight)
    m = _moments(base, by, weight is not None)
    bw = F.col("_std") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    m = m.withColumn("_bw", F.when(bw > 0, bw))  # null: no spread, no curve
    m = pinned(m.select(
        "group", "_n", "_bw", F.col("_min").alias("_at"),
        (F.col("_min") - cut * F.col("_bw")).alias("_gmin"),
        (F.col("_max") + cut * F.col("_bw")).alias("_gmax")).where(F.col("_bw").isNotNull()))
    def on(rows: DataFrame) -> DataFrame:
        return on_group(rows, m) if by else _attach(rows, m, None)

    far = (F.col("value") - F.col("_at")) / F.col("_bw") * KDE_CELLS
    cells = on(base).select("group", "_w", F.floor(far).alias("cell"),
                                     ((far - F.floor(far) - 0.5) / KDE_CELLS).alias("z"))
    power, sums = F.col("_w").cast("double"), []
    for k in range(KDE_ORDER):
        sums.append(F.sum(power).alias(f"s{k}"))
        power = power * F.col("z")
    cells = on(cells.groupBy("group", "cell").agg(*sums))
    step = (F.col("_gmax") - F.col("_gmin")) / (grid - 1)
    centre = F.col("_at") + (F.col("cell") + 0.5) / KDE_CELLS * F.col("_bw")
    first = F.greatest(F.ceil((centre - KDE_REACH * F.col("_bw") - F.col("_gmin")) / step), F.lit(0))
    last = F.least(F.floor((centre + KDE_REACH * F.col("_bw") - F.col("_gmin")) / step), F.lit(grid - 1))
    x = F.when(F.col("i") == grid - 1, F.col("_gmax")).otherwise(F.col("_gmin") + F.col("i") * step)
    near = cells.where(first <= last).select("*", centre.alias("_c"), F.explode(F.sequence(first, last)).alias("i"))
    near = near.withColumn("t", (x - F.col("_c")) / F.col("_bw"))
    before, now, factorial, share = F.lit(0.0), F.lit(1.0), 1, F.lit(0.0)
    for k in range(KDE_ORDER):  # He_k(t) s_k / k!
        share = share + now * F.col(f"s{k}") / float(factorial)
        before, now, factorial = now, F.col("t") * now - k * before, factorial * (k + 1)
    near = near.select("group", "i", (share * F.exp(F.lit(-0.5) * F.col("t") * F.col("t"))).alias("_c"))
    sums = near.groupBy("group", "i").agg(F.sum("_c").alias("_c"))
    points = m.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid - 1).cast("long"))).alias("i"))
    right = sums.select(F.col("group").alias("_g"), F.col("i").alias("_i"), "_c")
    out = points.join(right, points["group"].eqNullSafe(right["_g"]) & (points["i"] == right["_i"]), "left")
    norm = F.col("_n") * F.col("_bw") * F.lit(math.sqrt(2 * math.pi))
    return out.select("group", F.col("i").cast("int").alias("i"), x.alias("x"),
                      (F.greatest(F.coalesce(F.col("_c"), F.lit(0.0)), F.lit(0.0)) / norm).alias("density"))
