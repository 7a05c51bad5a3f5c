"""Incremental runs: only input that earlier runs have not seen, with state for duplicates and late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_a_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    return (r.option("maxFilesPerTrigger", files_a_trigger) if files_a_trigger else r).load(path)


def first_seen(rows: DataFrame, key: list[str], time: str, late: str = "1 day") -> DataFrame:
    """Rows whose key was not seen within the watermark; state goes as time passes."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def windowed(rows: DataFrame, time: str, width: str, late: str, keys: list[str], **aggregates) -> DataFrame:
    """Aggregates by time window and keys; a window is final once the watermark has passed it."""
    out = rows.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(*(c.alias(n) for n, c in aggregates.items()))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *aggregates)


def run_available(rows: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop; the checkpoint makes the next call take only what is new."""
    rows.writeStream.format("parquet").outputMode(mode).option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def for_each_batch(rows: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """work(batch, number) for each micro-batch of what is there; a number comes again after a failure, so work must be idempotent in it."""
    rows.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def remaining(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Batch form of the same: rows whose key is in no finished part."""
    return rows.join(done.select(key).distinct(), key, "left_anti")
