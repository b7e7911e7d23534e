"""Per-game sentiment counts kept up to date as review files arrive.

The same cleaning and the same per-game aggregate as the batch operators
(``clean_reviews`` without dedup, ``sentiment_counts``), run by Structured
Streaming over a folder that receives new CSV or parquet files. The running
counts live in the state store (one row per game), checkpointed under the
shared checkpoint folder, so a restarted query resumes where it stopped.

Text dedup is off by default here: without an event-time column there is no
watermark to expire seen texts, and the dedup state would grow with the
input forever. ``dedup=True`` keeps that unbounded state deliberately.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plaudit.operators import clean as C
from plaudit.operators import games as G
from plaudit.session import checkpoint_root
from plaudit.sources.reviews import standardize_columns


def game_sentiment_stream(spark: SparkSession, folder: str, schema: T.StructType | str,
                          fmt: str = "parquet", dedup: bool = False,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of (game, positive_reviews, negative_reviews,
    total_reviews, positive_ratio) over every file in ``folder``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    reviews = C.clean_reviews(standardize_columns(reader.load(folder)), dedup=dedup)
    return G.sentiment_counts(reviews)


def start_game_sentiment(spark: SparkSession, folder: str, schema: T.StructType | str,
                         sink_table: str | None = None, fmt: str = "parquet", dedup: bool = False,
                         checkpoint: str | None = None, processing_time: str | None = None,
                         sink_path: str | None = None) -> StreamingQuery:
    """Start the query (complete mode: each trigger emits the whole table,
    one row per game).

    ``sink_path`` rewrites a parquet table with the current counts after
    every trigger (``foreachBatch``); otherwise the table is the in-memory
    sink ``sink_table``, meant for tests and notebooks.
    """
    if (sink_table is None) == (sink_path is None):
        raise ValueError("give exactly one of sink_table or sink_path")
    ckpt = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/plaudit-stream-{uuid.uuid4().hex}"
    writer = (game_sentiment_stream(spark, folder, schema, fmt, dedup)
              .writeStream.outputMode("complete").option("checkpointLocation", ckpt))
    if sink_path is not None:
        writer = writer.foreachBatch(
            lambda batch, _epoch: batch.write.mode("overwrite").parquet(sink_path))
    else:
        writer = writer.format("memory").queryName(sink_table)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
