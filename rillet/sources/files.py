"""File sources: text lines, CSV tables and the three line parsers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.schemas import SENSOR_READING, USER_BEHAVIOR

ACCESS_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"
# One dialect for all CSV that the library writes and reads back: fields are
# quoted where they need it, a quote inside is doubled, spaces are kept, an
# empty string is written as "" and null as \\N (an empty field reads as null,
# and so does a text that is exactly \\N).
CSV_OPTIONS = {"header": "false", "quote": '"', "escape": '"', "emptyValue": '""', "nullValue": "\\N",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def from_collection(spark: SparkSession, rows, schema) -> DataFrame:
    """A bounded stream from an in-memory collection (records or plain values)."""
    return spark.createDataFrame(rows, schema)


def read_text(spark: SparkSession, path: str, streaming: bool = False,
              max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per line (``value``), batch or stream."""
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)
    return spark.read.text(path)


def read_csv_table(spark: SparkSession, path: str, schema, view: str | None = None,
                   streaming: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """A headerless CSV file with a fixed schema, optionally registered as a view.

    Reads what :func:`sink_csv` writes; a field without quotes is exactly the
    text between commas.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(schema).options(**{**CSV_OPTIONS, "emptyValue": "", "multiLine": "true",
                                              "mode": "FAILFAST"})
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write headerless CSV that :func:`read_csv_table` reads back as it was."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def _split_fields(value_col: str, sep: str):
    return F.split(F.col(value_col), sep, -1)


def parse_sensor_csv(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``id,ts_sec,temperature`` lines -> SensorReading.  Extra fields are ignored;
    a malformed number fails the query under ANSI mode, like the unguarded parse."""
    f = _split_fields(value_col, ",")
    keep = [c for c in lines.columns if c != value_col]
    return lines.select(*keep,
                        f[0].alias("id"),
                        f[1].cast("bigint").alias("ts_sec"),
                        f[2].cast("double").alias("temperature"))


def parse_behavior_csv(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``user,item,category,behavior,ts_sec`` lines -> UserBehavior."""
    f = _split_fields(value_col, ",")
    keep = [c for c in lines.columns if c != value_col]
    return lines.select(*keep,
                        f[0].cast("bigint").alias("user_id"),
                        f[1].cast("bigint").alias("item_id"),
                        f[2].cast("int").alias("category_id"),
                        f[3].alias("behavior"),
                        f[4].cast("bigint").alias("ts_sec"))


def parse_access_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Space-separated access log: fields 0 ip, 1 user, 3 time, 5 method, 6 url.

    The time field is parsed as a UTC wall-clock time (``TIMESTAMP_NTZ``); a line
    that ends before the url has a null url.
    """
    f = _split_fields(value_col, " ")
    keep = [c for c in lines.columns if c != value_col]
    return lines.select(*keep,
                        f[0].alias("ip"),
                        f[1].alias("user_id"),
                        F.to_timestamp_ntz(f[3], F.lit(ACCESS_TIME_FORMAT)).alias("ts"),
                        f[5].alias("method"),
                        F.get(f, F.lit(6)).alias("url"))


def sensor_lines(sensor: DataFrame, keep=("arr",)) -> DataFrame:
    """Render SensorReading rows as ``id,ts_sec,temperature`` text lines."""
    return sensor.select(*keep, F.concat_ws(",", "id", F.col("ts_sec").cast("string"),
                                            F.col("temperature").cast("string")).alias("value"))


def behavior_lines(behavior: DataFrame) -> DataFrame:
    return behavior.select("arr", F.concat_ws(",", *[F.col(c).cast("string") for c in
                                                    ("user_id", "item_id", "category_id",
                                                     "behavior", "ts_sec")]).alias("value"))


SENSOR_SCHEMA = SENSOR_READING
BEHAVIOR_SCHEMA = USER_BEHAVIOR
