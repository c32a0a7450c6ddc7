"""Kafka record codec: CSV text in the record value.

``format("kafka")`` needs the connector package on the classpath; the codec
itself works on any ``(key binary, value binary)`` DataFrame, batch or stream,
so it is testable without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.schemas import SENSOR_DDL
from rillet.sources.files import CSV_OPTIONS


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, group_id: str | None = None,
                 starting_offsets: str = "latest") -> DataFrame:
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return r.load()


def kafka_csv_decode(records: DataFrame, ddl: str = SENSOR_DDL, keep=("key",)) -> DataFrame:
    """Decode ``value`` (CSV text) into typed columns with ``from_csv``."""
    parsed = F.from_csv(F.col("value").cast("string"), ddl, {**CSV_OPTIONS, "emptyValue": "", "mode": "FAILFAST"})
    keep_cols = [c for c in keep if c in records.columns]
    return records.select(*keep_cols, parsed.alias("r")).select(*keep_cols, "r.*")


def kafka_csv_encode(df: DataFrame, columns, key: str | None = None) -> DataFrame:
    """Encode columns as one CSV value per row, ready for ``write.format('kafka')``.

    Fields are quoted where they need it; :func:`kafka_csv_decode` reads back
    commas, quotes, surrounding spaces, empty strings and nulls."""
    value = F.to_csv(F.struct(*columns), CSV_OPTIONS).cast("binary").alias("value")
    if key:
        return df.select(F.col(key).cast("string").cast("binary").alias("key"), value)
    return df.select(value)


def kafka_sink(df: DataFrame, bootstrap: str, topic: str, checkpoint: str):
    return (df.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .start())
