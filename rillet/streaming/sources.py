"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """A directory of files read as a stream, oldest files first."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def with_event_time(df: DataFrame, ts: str = "ts", bound: str = "0 seconds") -> DataFrame:
    """Cast the event-time column to TIMESTAMP (watermarks reject TIMESTAMP_NTZ)
    and attach a watermark that trails the max event time by ``bound``."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, bound)


def with_processing_time(df: DataFrame, name: str = "proc_ts") -> DataFrame:
    """Attach the processing time (the micro-batch's current timestamp) for
    processing-time windows."""
    return df.withColumn(name, F.current_timestamp())
