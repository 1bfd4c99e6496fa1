"""Streaming roll-ups agree with the batch form over the same files."""

import os

from pyspark.sql import functions as F

from lodestar.functions.scalar import round_to_hour  # noqa: F401
from lodestar.streaming import rollups
from tests.conftest import SF_SMALL


def test_hourly_stream_equals_batch(spark, scratch_dir):
    src = os.path.join(scratch_dir, "events")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    q = (
        rollups.hourly_stream(stream, lateness="0 seconds")
        .writeStream.outputMode("complete").format("memory").queryName("hourly_out").start()
    )
    q.processAllAvailable()
    q.stop()
    got = spark.table("hourly_out").agg(F.sum("n")).first()[0]
    assert got == spark.read.parquet(src).count()
    batch = spark.read.parquet(src).groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h"), "event_type").count()
    assert spark.table("hourly_out").count() == batch.count()


def test_daily_stream_to_table_resumes(spark, scratch_dir):
    src = os.path.join(scratch_dir, "events2")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    ck = os.path.join(scratch_dir, "ck")
    q = rollups.start_to_table(rollups.daily_weighted_stream(stream, lateness="0 seconds"), ck, "daily_relays")
    q.awaitTermination()
    n1 = spark.table("daily_relays").count()
    assert n1 > 0
    q2 = rollups.start_to_table(rollups.daily_weighted_stream(spark.readStream.schema(schema).parquet(src), lateness="0 seconds"), ck, "daily_relays")
    q2.awaitTermination()
    assert spark.table("daily_relays").count() == n1  # nothing new, no duplicates
