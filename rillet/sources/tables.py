"""Adapters from the parquet tables onto the event record types.

Each adapter is a projection (plus, for the access log, one equi-join with a
dimension table), so Catalyst prunes columns and pushes filters into the
parquet scan of whatever query uses it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.operators.scan import DEFAULT_ARRIVAL_CHUNK, chunk_by, running_count


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor_from_events(events: DataFrame) -> DataFrame:
    """SensorReading view: ``id = 'sensor_' || user_id``, temperature = value.

    ``arr`` (the event id) is the arrival order; ``ts`` is the event time.
    """
    return events.select(
        F.col("event_id").alias("arr"),
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        F.col("ts"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts_sec"),
        F.col("value").alias("temperature"),
    )


def sensor_id_equals(value: str) -> Column:
    """Predicate on the *events* table equivalent to ``id = value`` on the
    sensor view, written against the stored column so parquet can use it.

    ``'sensor_' || CAST(user_id AS STRING)`` equals ``value`` exactly when
    the suffix is the canonical decimal text of ``user_id`` (no leading
    zeros); anything else matches no row.
    """
    import re

    m = re.fullmatch(r"sensor_(-?(?:0|[1-9][0-9]*))", value)
    if m and -(1 << 63) <= int(m.group(1)) < (1 << 63):
        return F.col("user_id") == F.lit(int(m.group(1)))
    return F.lit(False)


def behavior_from_events(events: DataFrame) -> DataFrame:
    """UserBehavior view: item id from ``props.k``, behaviour = event type."""
    item = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.col("event_id").alias("arr"),
        F.col("user_id"),
        item.alias("item_id"),
        (item / 10).cast("int").alias("category_id"),
        F.col("event_type").alias("behavior"),
        F.col("ts"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts_sec"),
    )


def access_log_from_events(events: DataFrame, pages: DataFrame) -> DataFrame:
    """ApacheLogEvent view: each event requests the page whose place in page_id
    order is ``pmod(props.k, #pages)``.

    Pages are numbered densely whatever their ids are (a chunked scan over ids,
    so no task sees them all); an event without ``k`` keeps a null url.  The
    left join is left to Catalyst/AQE: it is broadcast only when the pruned
    ``(place, url)`` side is measured under the broadcast threshold, and
    otherwise a sort-merge join with AQE skew splitting.
    """
    listed = pages.where(F.col("page_id").isNotNull()).select("page_id", "url")
    n_pages = listed.count()
    numbered = running_count(listed, [], ["page_id", "url"], chunk_by("page_id", DEFAULT_ARRIVAL_CHUNK), "nth")
    k = F.get_json_object("props", "$.k").cast("bigint")
    place = F.pmod(k, F.lit(n_pages)) if n_pages else F.lit(None).cast("bigint")  # no pages, no urls
    ev = events.select(
        "event_id", "ts", "user_id", "event_type",
        place.alias("place"))
    joined = ev.join(numbered.select((F.col("nth") - 1).alias("place"), "url"), "place", "left")
    uid = F.col("user_id")
    return joined.select(
        F.col("event_id").alias("arr"),
        F.concat_ws(".", F.lit("10"), (uid / 65536).cast("bigint") % 256,
                    (uid / 256).cast("bigint") % 256, uid % 256).alias("ip"),
        uid.cast("string").alias("user_id"),
        F.col("ts"),
        F.when(F.col("event_type").isin("view", "click"), "GET").otherwise("POST").alias("method"),
        F.col("url"),
    )


def access_log_lines(log: DataFrame) -> DataFrame:
    """Render access-log rows as space-separated log lines (``value`` column)."""
    return log.select(
        "arr",
        F.concat_ws(" ", "ip", "user_id", F.lit("-"),
                    F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"),
                    "method", "url").alias("value"))
