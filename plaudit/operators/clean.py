"""Cleaning, dedup, sampling and row projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.functions.sampling import hash_sample_predicate
from plaudit.functions.sentiment import sentiment as sentiment_expr
from plaudit.sources.sinks import materialize

REPEATED_HASHES = 1 << 20  # hashes of repeated keys that are broadcast, 8 bytes each


def _require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s) {missing}; have {df.columns}")


def dedup_key(df: DataFrame) -> list[str]:
    """(game_id, review_text), or (game, review_text) without a game id."""
    return ["game_id", "review_text"] if "game_id" in df.columns else ["game", "review_text"]


def dedup_reviews(df: DataFrame, order_by: str | None = None,
                  keys: Sequence[str] | None = None) -> DataFrame:
    """One row per key; null keys compare equal.

    The survivor is the row with the smallest ``order_by`` value, ties by the
    remaining columns; without ``order_by`` the smallest remaining columns in
    their order. Either way it does not depend on the partition layout.

    Computed as ``min(struct(...))`` per key: an aggregate, so duplicates
    collapse map-side before the shuffle and a key holding a third of the rows
    never lands whole in one task, unlike a ``row_number`` window. The grouping
    leads with a hash of the key, so the sorts on either side of the shuffle
    compare eight bytes where they can; the key itself still decides.
    """
    keys = list(keys) if keys else dedup_key(df)
    _require(df, *keys)
    if order_by is not None:
        _require(df, order_by)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if order_by is not None:
        rest.sort(key=lambda c: c != order_by)  # order_by first, the others as they are
    best = F.min(F.struct(*[F.col(c) for c in rest])).alias("_best")
    out = df.groupBy(F.xxhash64(*keys).alias("_key_hash"), *keys).agg(best)
    return out.select(*[F.col(k) for k in keys],
                      *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)


def dedup_reviews_late(df: DataFrame, order_by: str | None = None, keys: Sequence[str] | None = None,
                       folder: str | None = None, max_hashes: int = REPEATED_HASHES) -> DataFrame:
    """``dedup_reviews``, the same rows, for inputs with few duplicates: only
    rows whose key may occur twice are shuffled.

    A first pass shuffles one 64-bit hash per distinct key and task and writes
    the hashes that occur more than once into ``folder``. Rows with another
    hash are unique and pass without a shuffle; the others go through
    ``dedup_reviews``, which compares whole keys, so keys that merely share a
    hash stay apart. The hashes are counted before they are broadcast; above
    ``max_hashes`` all rows are de-duplicated the plain way.

    Runs its first pass when called and reads ``df`` up to three times, so
    ``df`` should be a written table and give the same rows each time.
    """
    keys = list(keys) if keys else dedup_key(df)
    _require(df, *keys)
    if order_by is not None:
        _require(df, order_by)
    hashes = df.select(F.xxhash64(*keys).alias("_repeated")).groupBy("_repeated").agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(hashes.filter("n > 1").select("_repeated"), "repeated_keys", folder)
    if repeated.count() > max_hashes:
        return dedup_reviews(df, order_by, keys)
    same = F.xxhash64(*[df[k] for k in keys]) == repeated["_repeated"]
    alone = df.join(F.broadcast(repeated), same, "left_anti")
    return alone.unionByName(dedup_reviews(df.join(F.broadcast(repeated), same, "left_semi"), order_by, keys))


def clean_reviews(df: DataFrame, dedup: bool = True, order_by: str | None = None, late: bool = False,
                  folder: str | None = None) -> DataFrame:
    """Trim text (spaces only), drop null/blank text, drop null/NaN/malformed
    scores, then dedup (B1-B6).

    The score is cast with ``try_cast`` before the null filter, so a malformed
    score (``abc``) is dropped instead of failing the job; NaN is dropped too.
    ``late`` leaves texts without a duplicate out of the dedup's shuffle
    (``dedup_reviews_late``, which writes into ``folder``); ``df`` should then
    be a written table.
    """
    _require(df, "review_text")
    text = F.trim(F.col("review_text"))
    out = df.withColumn("review_text", text).filter(
        F.col("review_text").isNotNull() & (F.length(F.col("review_text")) > 0))
    if "review_score" in out.columns:
        score = F.col("review_score").try_cast("double")
        out = out.withColumn("review_score", score).filter(
            F.col("review_score").isNotNull() & ~F.isnan(F.col("review_score")))
    if dedup and late:
        return dedup_reviews_late(out, order_by, folder=folder)
    if dedup:
        out = dedup_reviews(out, order_by=order_by)
    return out


def sample_reviews(df: DataFrame, fraction: float, keys: Sequence[str] | None = None,
                   seed: int = 42) -> DataFrame:
    """Keep about ``fraction`` of the rows.

    ``fraction`` outside (0, 1) keeps everything, as in the original job. A row
    is kept by a hash of ``keys``, stable under any repartitioning and under
    added columns. Without ``keys`` the review identity is used — the dedup key
    (game id or game, and text) — or all columns when those are missing; rows
    sharing the key are kept or dropped together.
    """
    if not 0 < fraction < 1:
        return df
    if not keys:
        identity = dedup_key(df)
        keys = identity if all(k in df.columns for k in identity) else df.columns
    return df.filter(hash_sample_predicate(list(keys), fraction, seed))


def audit_cleaning(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """One row: rows before and after ``clean_reviews(raw, dedup)``, from one
    scan (B8). The rows are counted by dedup key and validity; every key with
    a valid row leaves one row. Invalid rows carry no key, so they fold into
    one row a task before the shuffle."""
    _require(raw, "review_text")
    marked = raw.withColumn("review_text", F.trim(F.col("review_text")))
    valid = F.coalesce(F.length("review_text") > 0, F.lit(False))
    if "review_score" in raw.columns:
        score = F.col("review_score").try_cast("double")
        valid &= score.isNotNull() & ~F.isnan(score)
    keys = dedup_key(raw) if dedup else []
    if dedup:
        _require(raw, *keys)
    rows = marked.select(valid.alias("_valid"), *[F.when(valid, F.col(k)).alias(k) for k in keys])
    counts = rows.groupBy(F.xxhash64(*keys).alias("_hash") if keys else F.lit(0).alias("_hash"), "_valid", *keys).agg(
        F.count(F.lit(1)).alias("n"))
    after = F.when(F.col("_valid"), F.lit(1) if dedup else F.col("n")).otherwise(0)
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_before"),
                      F.coalesce(F.sum(after), F.lit(0)).cast("long").alias("rows_after"))


def cleaning_audit(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: rows before and after cleaning (B8), of tables that are both
    written already; ``audit_cleaning`` counts from the raw rows alone."""
    after = cleaned.select(F.count(F.lit(1))).scalar()
    return raw.agg(F.count(F.lit(1)).alias("rows_before")).select(
        "rows_before", after.alias("rows_after"))


def review_lengths(df: DataFrame) -> DataFrame:
    return df.select(F.length(F.col("review_text")).alias("review_length"))


def sentiment_lengths(df: DataFrame, rule: str = "equals_one", threshold=None) -> DataFrame:
    return df.select(sentiment_expr("review_score", rule, threshold).alias("sentiment"),
                     F.length(F.col("review_text")).alias("review_length"))


def correlation_data(df: DataFrame) -> DataFrame:
    """The numeric columns the correlation uses, those that exist."""
    cols = []
    if "review_text" in df.columns:
        cols.append(F.length(F.col("review_text")).alias("review_length"))
    for c in ("review_score", "review_votes"):
        if c in df.columns:
            cols.append(F.col(c))
    return df.select(*cols)
