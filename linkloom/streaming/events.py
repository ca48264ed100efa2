"""Event queries that run on a batch or, unchanged, on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _micros() -> Column:
    """Microseconds of the event time, whatever the session's zone."""
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")


def hourly(events: DataFrame) -> DataFrame:
    """Counts and sums by user, type and hour; on a stream, set a watermark before."""
    hour = F.floor(_micros() / 3_600_000_000).cast("long")
    return events.groupBy("user_id", "event_type", hour.alias("hour")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: int) -> DataFrame:
    """``(user_id, sid, n)``: events of a user no more than ``gap`` seconds apart are one session."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    away = (_micros() - F.lag(_micros()).over(w)) / 1_000_000
    e = events.withColumn("new", F.when(away <= gap, 0).otherwise(1))
    return e.withColumn("sid", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("user_id", "sid").agg(F.count("*").alias("n"))


def source(spark: SparkSession, folder: str, files: str = "*.parquet", late: str = "1 hour") -> DataFrame:
    """A stream of events from the Parquet files of a folder; ``late``: how far behind the latest event one may come."""
    schema = spark.read.option("pathGlobFilter", files).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", files).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def unique(stream: DataFrame) -> DataFrame:
    """Each event once, remembered as long as the watermark says."""
    return stream.dropDuplicatesWithinWatermark(["event_id"])


def watch(stream: DataFrame) -> DataFrame:
    """Counts and sums by type in windows of an hour of event time."""
    return stream.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
