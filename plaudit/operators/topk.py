"""Exact most frequent values with a shuffle that does not grow with the vocabulary.

Counting every word to report a few sends each task's whole vocabulary through
the shuffle. Here words are first counted by hash cell, a fixed number of
cells; a cell's count bounds the count of each word in it. The words of the
fullest cells are counted exactly, which fixes the k-th largest count so far,
and only cells that reach this count can hold a word that belongs to the list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 16          # rows a task sends in the first pass, at most
CELLS_PER_WORD = 4       # fullest cells counted exactly, for each word asked for
LISTED_CELLS = 1 << 12   # beyond this many cells in reach all words are counted


def exact_top(values: DataFrame, column: str, n: int, min_freq: int = 1, cells: int = CELLS) -> DataFrame:
    """(column, freq): the ``n`` most frequent values, ties by value, those
    seen at least ``min_freq`` times. Exact on every input.

    Two passes over ``values``; a third where the bound leaves cells open
    (values of nearly equal counts), which then counts the open cells, all
    values if these are more than ``LISTED_CELLS``. At most ``cells`` counts
    and ``n`` rows come to the driver. A null counts as a value and sorts first
    among ties; no rows or ``n`` = 0 give an empty table.
    """
    spark = values.sparkSession
    values = values.select(column)
    cell = F.pmod(F.xxhash64(column), F.lit(cells))
    full = dict(tuple(r) for r in values.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect())

    def top(inside):
        rows = values.filter(cell.isin(sorted(inside))) if inside is not None else values
        freq = rows.groupBy(column).agg(F.count(F.lit(1)).alias("freq"))
        return (freq.filter(F.col("freq") >= min_freq)
                .orderBy(F.col("freq").desc(), F.col(column).asc()).limit(n).collect())

    seen = set(sorted(full, key=lambda c: (-full[c], c))[:max(1, n * CELLS_PER_WORD)])
    rows = top(seen) if full and n > 0 else []
    reach = max(min_freq, rows[-1].freq if len(rows) == n and rows else 1)
    within = {c for c, k in full.items() if k >= reach}
    if n > 0 and within - seen:
        rows = top(within if len(within) <= LISTED_CELLS else None)
    schema = values.schema.add("freq", "long")
    return spark.createDataFrame(rows, schema).coalesce(1)
