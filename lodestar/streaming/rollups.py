"""Streaming roll-ups over an event stream (extra, not a reference feature).

Both jobs use event-time windows with a watermark, so state for a window is
dropped once the watermark passes it and late rows within the allowance
still count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_stream(events: DataFrame, ts: str = "ts", key: str = "event_type", value: str = "value", lateness: str = "1 hour") -> DataFrame:
    """Per hour window and key: n, mean and max of ``value`` (streaming A23)."""
    return (
        events.withColumn("__ts", F.col(ts).cast("timestamp"))
        .withWatermark("__ts", lateness)
        .groupBy(F.window("__ts", "1 hour").alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"), F.max(value).alias("max_value"))
        .select(F.col("w.start").alias("hour"), key, "n", "mean_value", "max_value")
    )


def daily_weighted_stream(events: DataFrame, ts: str = "ts", weight: str = "value", lateness: str = "1 day") -> DataFrame:
    """Per day window: sum of the weight (streaming A03)."""
    return (
        events.withColumn("__ts", F.col(ts).cast("timestamp"))
        .withWatermark("__ts", lateness)
        .groupBy(F.window("__ts", "1 day").alias("w"))
        .agg(F.sum(weight).alias("n"))
        .select(F.col("w.start").alias("day"), "n")
    )


def start_to_table(df: DataFrame, checkpoint: str, table: str, trigger_once: bool = True):
    """Run a streaming aggregate in append mode into a table; the checkpoint
    folder holds offsets and state, so a restarted query resumes."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.toTable(table)
