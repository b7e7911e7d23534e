"""Shared pieces of the training-data operators: lineage cuts, ordered
prefix sums without a single-task window, connected components."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plaudit.session import checkpoint_root
from plaudit.sources.sinks import drop_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_SCOPES = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    for scope in getattr(_SCOPES, "open", []):
        scope.append((name, path))
    return path


def drop(path: str) -> None:
    """Delete a scratch folder; nothing if it is gone."""
    drop_folder(path)


@contextmanager
def scratch_scope(spark: SparkSession, keep: tuple[str, ...] = ()):
    """Scratch folders that this thread names inside the block are deleted when
    it ends, but for those called one of ``keep``. What reads them lazily must
    be written inside the block."""
    mine: list[tuple[str, str]] = []
    _SCOPES.open = [*getattr(_SCOPES, "open", []), mine]
    try:
        yield
    finally:
        _SCOPES.open = [s for s in _SCOPES.open if s is not mine]
        for name, path in mine:
            if name not in keep:
                drop(path)


@contextmanager
def shuffle_files_dropped(spark: SparkSession):
    """Writes inside the block free their shuffle files when they end."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that
    a lost executor cannot undo, read with column pruning afterwards."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffle_files_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def no_text(col: str) -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


# --------------------------------------------------------------------------
# Global order without one task holding it
# --------------------------------------------------------------------------

def bucket_count(rows: int) -> int:
    """Range buckets for ``rows`` rows: about a thousand rows each up to 8192
    buckets, then at most 200 000 rows each."""
    return max(16, min(8192, rows // 1000), rows // 200_000)


def range_bucket(df: DataFrame, key: str, name: str, buckets: int, on: DataFrame | None = None,
                 no_key: Column | None = None) -> DataFrame:
    """Add ``name`` to ``on`` (default ``df``): the range bucket of the numeric
    ``key``, ascending with it. Nulls are alone in the negative buckets, spread
    over as many by the hash ``no_key``, or in bucket -1 without one.

    The splitters are approximate quantiles over all rows, at most ``buckets``
    numbers, so the buckets hold about the same number of rows; rows are
    placed by binary search."""
    steps = [i / buckets for i in range(1, buckets)]
    splits = df.agg(F.percentile_approx(key, F.array(*map(F.lit, steps)), 10 * buckets)).first()[0] if steps else []
    splits = sorted({float(x) for x in splits or []})
    out = (df if on is None else on).withColumn("_key", F.coalesce(F.col(key), F.lit(0)).cast("double"))
    out = Bucketizer(splits=[-float("inf"), *splits, float("inf")] if splits else [-float("inf"), 0.0, float("inf")],
                     inputCol="_key", outputCol=name).transform(out)
    null = F.lit(-1) if no_key is None else -1 - F.pmod(no_key, F.lit(buckets))
    return out.withColumn(name, F.when(F.col(key).isNull(), null).otherwise(F.col(name)).cast("int")).drop("_key")


def running_offset(df: DataFrame, bucket: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows before this one, by
    (bucket, order). Two levels: a window inside each bucket and a window
    over one row per bucket, whose number is fixed by the caller."""
    inside = Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(bucket).agg(F.sum(value).alias("_total"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        F.col(bucket).alias("_b"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    out = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (out.join(F.broadcast(base), out[bucket] == base["_b"])
            .withColumn(name, F.col("_base") + F.col("_inside"))
            .drop("_b", "_base", "_inside"))


# --------------------------------------------------------------------------
# Connected components
# --------------------------------------------------------------------------

def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: bigint); root is the
    smallest node of the component.

    Alternating large-star and small-star steps. Each step is a partial
    aggregate (min per node) joined back, so a hub costs one row per task in
    the aggregate and its own edges, dealt again by AQE when skewed, in the
    join. Every step is written to the shared folder."""
    cur = cut(edges.where("u <> v")
              .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(cur)
    while state[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m"))
                  .select("u", F.least("u", "m").alias("m")), "large-min")
        large = cut(both.where("v > u").join(low, "u")
                    .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")), "small-min")
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        cur = cut(small.where("u <> v").distinct(), "small-star")
        now = _state(cur)
        if now == state:
            break
        state = now
    leaves = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
