"""Review input: CSV (or parquet) scan and column standardisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.sources.split_csv import read_split_csv

REVIEW_COLUMNS = ("game_id", "game", "app_name", "review_text", "review_score", "review_votes")


def read_reviews(spark: SparkSession, path: str, fmt: str = "csv",
                 schema: T.StructType | str | None = None,
                 multiline: bool = True, infer_schema: bool = False, split: bool = False) -> DataFrame:
    """Scan review files.

    CSV is read with a header. ``multiline`` (default on) with ``escape='"'``
    keeps a quoted review holding newlines, commas or doubled quotes in one
    row; ``multiline=False`` restores the plain header-only reader (faster to
    split, but such reviews break into several rows). Without a schema and
    without ``infer_schema`` every column is read as a string and
    ``standardize_columns`` casts it, which avoids the extra inference pass
    over the input. ``split`` reads uncompressed files with quoted newlines by
    byte ranges, many tasks to a file (``read_split_csv``).
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    if split and multiline:
        if infer_schema or isinstance(schema, str):
            raise ValueError("split reading takes a StructType, or reads strings")
        return read_split_csv(spark, path, schema)
    reader = spark.read.option("header", True)
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename to the working names and type the numeric columns.

    ``Game Name`` becomes ``game``, else ``app_name`` does; ``Game ID``
    becomes ``game_id``, else ``app_id`` does — each only when the target name
    is not present yet. Scores and votes become double through ``try_cast``
    (malformed values become null instead of failing the job). Ids keep the
    type they were read with: casting a non-numeric id to a number would turn
    it into null and merge different games in the dedup; pass a schema (or
    parquet input) for typed ids.
    """
    cols = set(df.columns)
    if "game" not in cols:
        if "Game Name" in cols:
            df = df.withColumnRenamed("Game Name", "game")
        elif "app_name" in cols:
            df = df.withColumnRenamed("app_name", "game")
    cols = set(df.columns)
    if "game_id" not in cols:
        if "Game ID" in cols:
            df = df.withColumnRenamed("Game ID", "game_id")
        elif "app_id" in cols:
            df = df.withColumnRenamed("app_id", "game_id")
    typed = {
        "review_score": "double",
        "review_votes": "double",
    }
    dtypes = dict(df.dtypes)
    for name, target in typed.items():
        if name in dtypes and dtypes[name] != target:
            df = df.withColumn(name, F.col(name).try_cast(target))
    return df
