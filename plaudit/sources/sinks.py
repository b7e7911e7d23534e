"""Sinks and the lineage cut used by the whole-job plan."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.functions.sentiment import sentiment as sentiment_expr
from plaudit.functions.text import clean_text
from plaudit.session import checkpoint_root


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a result table; CSV gets a header like the original outputs."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


def write_key_values(df: DataFrame, path: str, formats: dict[str, str] | None = None,
                     mode: str = "overwrite") -> None:
    """One ``key=value`` text line per column of a one-row summary table
    (the original's ``score_scale_summary.txt`` / ``global_binary_summary.txt``).

    Booleans print as ``True``/``False`` and nulls as ``None``, as the
    original's Python formatting did; ``formats`` maps a column to a
    ``format_string`` pattern (for example ``{"positive_ratio": "%.6f"}``).
    """
    formats = formats or {}
    dtypes = dict(df.dtypes)

    def text(c: str):
        col = F.col(c)
        if c in formats:
            v = F.format_string(formats[c], col)
        elif dtypes[c] == "boolean":
            v = F.when(col, F.lit("True")).otherwise(F.lit("False"))
        else:
            v = col.cast("string")
        return F.coalesce(v, F.lit("None"))

    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.concat(F.lit(f"{c}="), text(c)).alias("line"))
                      for i, c in enumerate(df.columns)])
    lines = df.select(F.inline(pairs)).orderBy("i").select(F.col("line").alias("value"))
    lines.coalesce(1).write.mode(mode).text(path)  # a handful of lines


def write_corpus(df: DataFrame, path: str, rule: str = "equals_one", threshold=None,
                 mode: str = "overwrite") -> None:
    """Cleaned review text, one line per review, one folder per sentiment.

    Replaces the single concatenated string per corpus: the whole corpus is
    ``path/*``, the positive one ``path/sentiment=positive``.
    """
    out = df.select(
        sentiment_expr("review_score", rule, threshold).alias("sentiment"),
        clean_text("review_text").alias("value"),
    )
    out.write.mode(mode).partitionBy("sentiment").text(path)


def run_folder(spark: SparkSession) -> str:
    """A fresh folder for one run's intermediates under the shared checkpoint
    folder. Everything a run materialises lies in it, so an operator (or the
    folder's retention rule) removes a run, also a failed one, as a whole."""
    return f"{checkpoint_root(spark).rstrip('/')}/plaudit-run-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as parquet into ``folder`` (default: a fresh run folder)
    and read it back.

    Cuts the lineage (an executor loss re-reads files instead of re-running
    the scan and dedup shuffle) and, unlike an RDD checkpoint, later readers
    get column pruning and filter pushdown from the parquet scan.
    """
    spark = df.sparkSession
    path = f"{folder or run_folder(spark)}/{name}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(folder: str) -> None:
    """Delete a run folder through its file system; nothing if it is gone."""
    fs, path = pafs.FileSystem.from_uri(folder)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_dir(path)
