"""Small hand-checked inputs (sensor readings and text lines)."""

from pyspark.sql import functions as F

from rillet.sources.files import parse_sensor_csv

# Invented readings; expectations in test_fixtures.py are worked out by hand.
SENSOR_LINES = [
    "probe_2,1700000004,21.5",
    "probe_9,1700000006,48.25",
    "probe_2,1700000011,19.0",
    "probe_20,1700000012,30.5",
    "probe_2,1700000013,33.75",
    "probe_9,1700000029,44.0",
    "probe_2,1700000031,26.75",
    "probe_4,1700000033,12.0",
]

TEXT_LINES = ["red blue", "blue green blue", "one", "two red", ""]


def sensor_lines(spark):
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(SENSOR_LINES)],
                                 "arr bigint, value string")


def sensor(spark):
    """Parsed readings with arrival index ``arr`` (1..8) and event time ``ts``."""
    return (parse_sensor_csv(sensor_lines(spark))
            .withColumn("ts", F.timestamp_seconds("ts_sec").cast("timestamp_ntz")))


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
