"""Record types of the event model as Spark schemas."""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)

SENSOR_READING = StructType([
    StructField("id", StringType()),
    StructField("ts_sec", LongType()),          # epoch seconds
    StructField("temperature", DoubleType()),
])
SENSOR_DDL = "id STRING, ts_sec BIGINT, temperature DOUBLE"

USER_BEHAVIOR = StructType([
    StructField("user_id", LongType()),
    StructField("item_id", LongType()),
    StructField("category_id", IntegerType()),
    StructField("behavior", StringType()),
    StructField("ts_sec", LongType()),          # epoch seconds
])
USER_BEHAVIOR_DDL = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, ts_sec BIGINT"

ACCESS_LOG_EVENT = StructType([
    StructField("ip", StringType()),
    StructField("user_id", StringType()),
    StructField("ts", TimestampNTZType()),      # wall-clock time, read as UTC
    StructField("method", StringType()),
    StructField("url", StringType()),
])

ITEM_VIEW_COUNT = StructType([
    StructField("item_id", LongType()),
    StructField("window_end", TimestampType()),
    StructField("cnt", LongType()),
])

PAGE_VIEW_COUNT = StructType([
    StructField("url", StringType()),
    StructField("window_end", TimestampType()),
    StructField("cnt", LongType()),
])

# Output of the keyed-upsert and latest-by-key sinks.
SENSOR_TEMP = StructType([
    StructField("id", StringType()),
    StructField("temperature", DoubleType()),
])
