"""Incremental processing of the event log: deduplicated work items, windows, keyed merges by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, folder: str, pattern: str = "events.parquet") -> DataFrame:
    """The event log as a stream of files."""
    schema = spark.read.parquet(f"{folder}/{pattern}").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def work_items(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """One work item for each dedupe key within the time that late events are waited for."""
    keyed = events.withColumn("dedupe_key", F.concat_ws(":", "event_type", F.col("user_id").cast("string")))
    return keyed.withWatermark("ts", late).dropDuplicatesWithinWatermark(["dedupe_key"])


def outcome_windows(events: DataFrame, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Misses and all events by window and type: an extra, as the polling rules have no event time."""
    windows = events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type")
    return windows.agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def merge_by_batch(stream: DataFrame, target: str, keys: list[str], order: str, checkpoint: str):
    """Keep the latest row of each key: every micro-batch writes the next version of the table beside the last.

    A batch that is run again finds its own version and writes it anew from the one before, so the result is the same.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if number > 0:
            rows = spark.read.parquet(f"{target}/version={number - 1}").unionByName(batch, allowMissingColumns=True)
        latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), order).alias("x")).select("x.*")
        latest.write.mode("overwrite").parquet(f"{target}/version={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
