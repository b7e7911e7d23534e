"""Document fingerprints by winnowing, in SQL functions only.

A text is its white-space words. Every run of ``gram`` words gets the cyclic
polynomial (buzhash) of its word hashes: the value a rolling hash takes at that
run, computed for all runs together by doubling. In every ``window``
consecutive runs the smallest hash is selected, the rightmost of equal ones,
and its position kept. Two texts that share ``gram + window - 1`` words share a
selected hash. A text with fewer runs than a window keeps them all; one with
fewer words than a gram has one run of all its words; without words the
fingerprint is empty.

A selected run is one bigint: 39 bits of hash, then 24 bits that fall with the
position, so that the least number is the rightmost smallest hash. Positions
are exact up to 2^24 words and modulo 2^24 beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_count, cut, no_text, range_bucket

_LOW = (1 << 24) - 1


def _rotate(x: Column, by: int) -> Column:
    return F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, 64 - by))


def _extend(by: int):
    """Joins the hash of a run with that of the ``by`` words after it."""
    return lambda a, b: _rotate(a, by % 64).bitwiseXOR(b)


def _pairs(a: str, b: str, shift: int, join) -> Column:
    """join(a[i], b[i + shift]) for all i where both exist."""
    n = F.greatest(F.lit(0), F.least(F.size(a), F.size(b) - shift))
    return F.zip_with(F.slice(a, 1, n), F.slice(b, shift + 1, n), join)


def with_fingerprint(df: DataFrame, text: str, name: str, gram: int = 5, window: int = 8) -> DataFrame:
    """Add ``name``: the selected runs of column ``text`` as array<bigint>, by position."""
    out = df.withColumn("_w", F.array_remove(F.split(F.col(text), r"\s+"), ""))
    out = out.withColumn("_h1", F.transform("_w", lambda w: F.xxhash64(w)))
    # hashes of 2, 4, ... words, then the rest of the gram
    have, cols, parts = 1, ["_w", "_h1"], [(1, "_h1")]
    while have * 2 <= gram:
        out = out.withColumn(f"_h{have * 2}", _pairs(
            f"_h{have}", f"_h{have}", have, _extend(have)))
        have *= 2
        cols.append(f"_h{have}")
        parts.append((have, f"_h{have}"))
    done, current = have, f"_h{have}"
    for size, col in reversed(parts):
        while done + size <= gram:
            out = out.withColumn(f"_g{done + size}", _pairs(
                current, col, done, _extend(size)))
            done += size
            current = f"_g{done}"
            cols.append(current)
    runs = (F.when(F.size("_w") == 0, F.array().cast("array<bigint>"))
            .when(F.size("_w") < gram, F.array(F.xxhash64(F.array_join("_w", " "))))
            .otherwise(F.col(current)))
    out = out.withColumn("_v1", F.transform(runs, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 25), 24).bitwiseOR(
        F.lit(_LOW).cast("long") - i.cast("long").bitwiseAND(F.lit(_LOW).cast("long")))))
    cols.append("_v1")
    least = 1
    while least < window:
        step = min(least, window - least)
        out = out.withColumn(f"_v{least + step}", _pairs(
            f"_v{least}", f"_v{least}", step, lambda a, b: F.least(a, b)))
        least += step
        cols.append(f"_v{least}")
    out = out.withColumn(name, F.when(F.size("_v1") < window, F.col("_v1"))
                         .otherwise(F.array_distinct(F.col(f"_v{window}"))))
    return out.drop(*cols)


def selected(fingerprint: str) -> Column:
    """The runs as array<struct<hash, pos>>."""
    return F.transform(fingerprint, lambda x: F.struct(
        F.shiftrightunsigned(x, 24).alias("hash"),
        (F.lit(_LOW).cast("long") - x.bitwiseAND(F.lit(_LOW).cast("long"))).alias("pos")))


def as_text(fingerprint: str) -> Column:
    """hash and falling position of each run in hexadecimal, blank-separated."""
    return F.array_join(F.transform(fingerprint, lambda x: F.hex(x)), " ")


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of the selected hashes, 0 to 1; two empty fingerprints are alike."""
    left, right = (F.transform(c, lambda x: F.shiftrightunsigned(x, 24)) for c in (a, b))
    both = F.size(F.array_intersect(left, right))
    any_ = F.size(F.array_union(left, right))
    return F.when(any_ == 0, F.lit(1.0)).otherwise(both / any_)


def _first_of_next(rows: DataFrame, gram: int, window: int) -> DataFrame:
    """(_b, _over): for each bucket the first row of the next lower one, the
    topmost after the lowest. The first row of a bucket is chosen by its id,
    and only these are fingerprinted; the order of the buckets is that of
    their numbers, without texts."""
    first = (rows.groupBy("_b").agg(
        F.max_by("text", F.struct(F.col("doc_id"), -F.xxhash64("text").cast("decimal(20,0)"))).alias("text")))
    heads = cut(with_fingerprint(first, "text", "fp", gram, window), "bucket-heads")
    order = Window.orderBy(F.col("_b").desc())
    follows = heads.select("_b", F.coalesce(
        F.lead("_b").over(order), heads.agg(F.max("_b")).scalar()).alias("_n"))
    return follows.join(heads.select(F.col("_b").alias("_n"), F.struct("text", "fp").alias("_over")), "_n").select("_b", "_over")


def fingerprint_edits(docs: DataFrame, text: str = "text", id_col: str = "doc_id", gram: int = 5, window: int = 8,
                      buckets: int | None = None) -> DataFrame:
    """Per row: doc_id, text, edited (the last third of its code points, rounded
    down, replaced by as many of the next document's first), fp, edited_fp,
    next_fp. Null texts count as empty.

    The next document is the one that follows in descending doc_id, the first
    one after the last. Rows of one id follow each other by a hash of their
    text, rows without an id come last. The order is cut into range buckets: a
    window looks one row ahead inside a bucket, and one row a bucket hands the
    first row of the next bucket over."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), no_text(text).alias("text"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    rows = range_bucket(ids, "doc_id", "_b", buckets or bucket_count(docs.count()), on=rows,
                        no_key=F.xxhash64("text"))
    ahead = Window.partitionBy("_b").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    seen = with_fingerprint(rows, "text", "fp", gram, window).withColumn("_next", F.lead(F.struct("text", "fp")).over(ahead))
    seen = (seen.join(_first_of_next(rows, gram, window), "_b", "left")
            .withColumn("_next", F.coalesce("_next", "_over")))
    third = F.floor(F.length("text") / 3).cast("int")
    seen = seen.select(
        "doc_id", "text", "fp", F.col("_next.fp").alias("next_fp"),
        F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 3) as int))"),
                 F.left(F.col("_next.text"), third)).alias("edited"))
    return with_fingerprint(seen, "edited", "edited_fp", gram, window)
