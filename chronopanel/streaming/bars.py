"""Bars of an event stream. An addition: the batch engine rebuilds its data as a whole.

Events later than the watermark are dropped; a window's bar is final when the watermark passes its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hourly_bars(events: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Open, high, low, close and count of each type and window; events need ts (timestamp), event_id, event_type, value."""
    at = F.struct("ts", "event_id")
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", window).alias("w"), F.col("event_type").alias("ticker"))
        .agg(F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.count("*").alias("n"))
        .select("ticker", F.col("w.start").alias("start"), "open", "high", "low", "close", "n")
    )


def replay(spark: SparkSession, sf_dir: str, transform, name: str = "bars_replay") -> DataFrame:
    """Runs a stream over the stored events to its end and gives the result table."""
    files = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)
    q = transform(files.withColumn("ts", F.col("ts").cast("timestamp"))).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)
