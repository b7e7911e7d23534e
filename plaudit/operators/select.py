"""Exact order statistics by recursive bracketing, several ranks a group.

A rank is bracketed by counts: the values of a group are counted in cells, the
cell that holds the rank is found from the running counts, and the cell's own
range (its least and greatest value) is cut into cells again, until it holds a
single value. The first cells are logarithmic, so that no spread of values
makes one cell of everything; the later ones are equal parts of a range that
shrinks to a fraction each round. All ranks of all groups go through a round
together, and only (group, cell) counts are shuffled: no task holds a group's
values, no window runs over them, and distinct values are never folded.

Between rounds the open brackets (a few rows a group) are brought to the driver
if there are at most ``PINNED_ROWS`` of them and broadcast from there; beyond
that they are written to the shared folder and joined as Spark sees fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.sources.sinks import materialize, run_folder

CELLS = 1 << 14        # cells of a bracket, in rounds after the first
LOG_CELLS = 64         # cells of a unit of ln(1 + |x|) in the first round
PINNED_ROWS = 50_000   # rows that may be held by the driver and broadcast


def pinned(df: DataFrame, limit: int = PINNED_ROWS) -> DataFrame:
    """``df`` evaluated once: as a broadcast table where it has at most
    ``limit`` rows, else as a written table of the shared folder."""
    spark, rows = df.sparkSession, df.limit(limit + 1).collect()
    if len(rows) <= limit:
        return F.broadcast(spark.createDataFrame(rows, df.schema))
    return materialize(df, "pinned", run_folder(spark))


def on_group(rows: DataFrame, per_group: DataFrame) -> DataFrame:
    """Attach per-group figures to ``rows``; a null group is a group too."""
    right = per_group.withColumnRenamed("group", "_g")
    return rows.join(right, rows["group"].eqNullSafe(right["_g"])).drop("_g")


def _first_cell(x: Column) -> Column:
    """At most about 45 000 cells on either side of 0, rising with x."""
    size = F.floor(F.log1p(F.abs(x)) * LOG_CELLS)
    return F.when(F.abs(x) == float("inf"), F.signum(x) * 1_000_000).otherwise(F.signum(x) * size).cast("int")


def _pick(counts: DataFrame, within: list[str], ranks: DataFrame) -> DataFrame:
    """(group, slot, need, lo, hi, total): the cell of each rank. ``counts`` has
    (within, cell, n, lo, hi), ``ranks`` (within, slot, need), ``need`` counted
    from 1 inside ``within``; the window runs over cells, not values."""
    upto = F.sum("n").over(Window.partitionBy(*within).orderBy("cell"))
    cells = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
    right = ranks.select(*[F.col(c).alias(f"_{c}") for c in within], "slot", "need", "total")
    same = F.lit(True)
    for c in within:
        same &= cells[c].eqNullSafe(right[f"_{c}"])
    found = cells.join(right, same & (F.col("need") > F.col("before")) & (F.col("need") <= F.col("upto")))
    return found.select("group", "slot", (F.col("need") - F.col("before")).alias("need"), "lo", "hi", "total")


def rank_values(rows: DataFrame, ranks) -> DataFrame:
    """(group, slot, value, total) for ``rows`` (group, value double, _w long).

    ``ranks`` maps the column with a group's number of values (``_w`` counted)
    to an array of struct<slot, need>, ``need`` the rank from 1. Values must not
    be null or NaN. The result has at most a row a group and slot."""
    cells = (rows.groupBy("group", _first_cell(F.col("value")).alias("cell"))
             .agg(F.sum("_w").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).where("n > 0"))
    total = F.sum("n").over(Window.partitionBy("group"))
    upto = F.sum("n").over(Window.partitionBy("group").orderBy("cell"))
    wide = (cells.withColumn("total", total).withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
            .select("*", F.inline(ranks(F.col("total")))))
    found = wide.where((F.col("need") > F.col("before")) & (F.col("need") <= F.col("upto"))).select(
        "group", "slot", (F.col("need") - F.col("before")).alias("need"), "lo", "hi", "total")
    done, opened = [], pinned(found)
    while True:
        done.append(opened.where("lo = hi").select("group", "slot", F.col("lo").alias("value"), "total"))
        opened = opened.where("lo < hi")
        if opened.isEmpty():
            break
        # the brackets of a group are apart, so a value falls into one at most
        ranges = opened.select(F.col("group").alias("_g"), "lo", "hi").distinct()
        ranges = F.broadcast(ranges) if opened.count() <= PINNED_ROWS else ranges
        inside = rows.join(ranges, rows["group"].eqNullSafe(ranges["_g"])
                           & (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")))
        # halves, as the width of a range can overflow a double
        part = (F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        part = F.when(F.col("hi") - F.col("lo") < float("inf"),
                      (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(part)
        cell = F.least(F.floor(part * CELLS), F.lit(CELLS - 1)).cast("int")
        counts = (inside.groupBy("group", F.col("lo").alias("bracket"), cell.alias("cell"))
                  .agg(F.sum("_w").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")))
        opened = pinned(_pick(counts, ["group", "bracket"],
                              opened.select("group", F.col("lo").alias("bracket"), "slot", "need", "total")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out if len(done) == 1 else pinned(out)


def quantiles(rows: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(group, _q): linearly interpolated quantiles of ``rows`` (group, value,
    _w) as an array in the order of ``probs``, a row a group."""
    def ranks(n: Column) -> Column:
        out = []
        for i, p in enumerate(probs):
            at = (n - 1) * F.lit(float(p))
            for side, rank in ((0, F.floor(at)), (1, F.ceil(at))):
                out.append(F.struct(F.lit(2 * i + side).alias("slot"), (rank + 1).cast("long").alias("need")))
        return F.array(*out)

    found = rank_values(rows, ranks).groupBy("group").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "value"))).alias("m"),  # two entries a quantile
        F.max("total").alias("n"))

    def value(i: int, p: float) -> Column:
        at = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col("m")[2 * i], F.col("m")[2 * i + 1]
        share = at - F.floor(at)
        return F.when(low == high, low).otherwise(low * (1 - share) + high * share)

    return pinned(found.select("group", F.array(*[value(i, p) for i, p in enumerate(probs)]).alias("_q")))


def lower_median(rows: DataFrame) -> DataFrame:
    """(group, slot, value): the smallest value with at least half of the
    group's values at or below it."""
    return rank_values(rows, lambda n: F.array(F.struct(
        F.lit(0).alias("slot"), F.floor((n + 1) / 2).cast("long").alias("need"))))
