"""Streaming versions of the analysis jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillet.streaming.sinks import count_first_seen_batch, late_split_batch, rank_windows_batch
from rillet.streaming.sources import with_event_time, with_processing_time


def item_counts_stream(behavior: DataFrame, behavior_value: str = "view", size: str = "1 hour",
                       slide: str = "5 minutes", bound: str = "0 seconds") -> DataFrame:
    """Append-mode sliding counts per item; a window is emitted once the
    watermark (max event time - bound) passes its end."""
    views = with_event_time(behavior, "ts", bound).where(F.col("behavior") == behavior_value)
    return (views.groupBy("item_id", F.window("ts", size, slide).alias("w"))
                 .agg(F.count(F.lit(1)).alias("cnt"))
                 .select("item_id", F.col("w.end").alias("window_end"), "cnt"))


def start_hot_items(behavior: DataFrame, out_path: str, checkpoint: str, n: int = 5,
                    trigger: dict | None = None, **kw) -> StreamingQuery:
    counts = item_counts_stream(behavior, **kw)
    w = (counts.writeStream.outputMode("append")
               .foreachBatch(rank_windows_batch(n, "item_id", out_path))
               .option("checkpointLocation", checkpoint))
    w = w.trigger(**trigger) if trigger else w.trigger(availableNow=True)
    return w.start()


def pv_count_stream(behavior: DataFrame, behavior_value: str = "view", size: str = "1 hour",
                    salts: int = 10, bound: str = "0 seconds") -> DataFrame:
    """Salted two-stage count chained as two streaming aggregations: the second
    groups by the event time of the first window (``window_time``)."""
    views = with_event_time(behavior, "ts", bound).where(F.col("behavior") == behavior_value)
    per_salt = (views.groupBy(F.pmod(F.xxhash64("arr"), F.lit(salts)).alias("salt"),
                              F.window("ts", size).alias("w"))
                     .agg(F.count(F.lit(1)).alias("cnt")))
    return (per_salt.groupBy(F.window(F.window_time("w"), size).alias("w2"))
                    .agg(F.sum("cnt").alias("cnt"))
                    .select(F.lit("pv").alias("label"), F.col("w2.end").alias("window_end"), "cnt"))


def uv_stream(behavior: DataFrame, behavior_value: str = "view", size: str = "1 hour",
              bound: str = "0 seconds", rsd: float = 0.01) -> DataFrame:
    """Distinct visitors per window on an unbounded stream (HyperLogLog++ state)."""
    views = with_event_time(behavior, "ts", bound).where(F.col("behavior") == behavior_value)
    return (views.groupBy(F.window("ts", size).alias("w"))
                 .agg(F.approx_count_distinct("user_id", rsd).alias("cnt"))
                 .select(F.lit("uv").alias("label"), F.col("w.end").alias("window_end"), "cnt"))


def uv_exact_stream(behavior: DataFrame, behavior_value: str = "view", size: str = "1 hour",
                    bound: str = "0 seconds") -> DataFrame:
    """Exact distinct visitors per window on an unbounded stream.

    The state of the first stage is one row per (window, visitor), spread by both
    and dropped when the watermark passes the window; the second counts what
    is new, summed up before its shuffle."""
    views = with_event_time(behavior, "ts", bound).where(F.col("behavior") == behavior_value)
    first = views.select(F.window("ts", size).alias("w"), "user_id").dropDuplicates(["w", "user_id"])
    return (first.groupBy(F.window(F.window_time("w"), size).alias("w2"))
                 .agg(F.count("user_id").alias("cnt"))
                 .select(F.lit("uv").alias("label"), F.col("w2.end").alias("window_end"), "cnt"))


def word_count_stream(lines: DataFrame, value: str = "value", sep: str = " ") -> DataFrame:
    """Streaming word count for update mode: one updated count per word per batch."""
    from rillet.functions.text import java_split
    return (lines.select(F.explode(java_split(value, sep)).alias("word"))
                 .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


def hot_items_by_timer(behavior: DataFrame, n: int = 5, behavior_value: str = "view",
                       size: str = "1 hour", slide: str = "5 minutes",
                       bound: str = "0 seconds") -> DataFrame:
    """Hot items as one streaming query: windowed count -> keyed-by-window-end
    list state -> event-time timer ranks and emits (a pure query, usable with
    any sink)."""
    from rillet.streaming.stateful import TopNOnTimer

    views = with_event_time(behavior, "ts", bound).where(F.col("behavior") == behavior_value)
    counts = (views.groupBy("item_id", F.window("ts", size, slide).alias("w"))
                   .agg(F.count(F.lit(1)).alias("cnt"))
                   .select("item_id", F.col("w.end").alias("window_end"), "cnt",
                           F.window_time("w").alias("wt")))
    return counts.groupBy("window_end").transformWithStateInPandas(
        statefulProcessor=TopNOnTimer(n), outputStructType="item_id bigint, window_end timestamp, "
        "cnt bigint, rn int", outputMode="Append", timeMode="EventTime")


def uv_first_seen(behavior: DataFrame, behavior_value: str = "view", size: str = "1 hour",
                  bound: str = "0 seconds") -> DataFrame:
    """(window_end, arr, offset) when a visitor's offset is first seen in its window.

    State is kept per (window, bucket of offsets), so a busy hour is spread;
    :func:`rillet.streaming.sinks.count_first_seen_batch` numbers the rows."""
    from rillet.operators.distinct import user_offset
    from rillet.streaming.stateful import FIRST_SEEN_BUCKET, FirstSeenOffsets

    views = with_event_time(behavior, "ts", bound).where(F.col("behavior") == behavior_value)
    offset = user_offset(views, "user_id")
    keyed = views.select(F.window("ts", size).end.alias("window_end"), "ts", "arr", offset.alias("offset"),
                         F.floor(offset / FIRST_SEEN_BUCKET).alias("bucket"))
    return keyed.groupBy("window_end", "bucket").transformWithStateInPandas(
        statefulProcessor=FirstSeenOffsets(), outputStructType="window_end timestamp, arr bigint, offset bigint",
        outputMode="Append", timeMode="EventTime")


def start_uv_first_seen(behavior: DataFrame, out_path: str, checkpoint: str, **kw) -> StreamingQuery:
    """The visitor count after every first sighting: ('uv', window_end, arr, cnt)."""
    fn = count_first_seen_batch(out_path, checkpoint + "/totals")
    return (uv_first_seen(behavior, **kw).writeStream.foreachBatch(fn)
            .option("checkpointLocation", checkpoint + "/query").trigger(availableNow=True).start())


def hot_pages_by_timer(log: DataFrame, n: int = 3, size: str = "10 minutes", slide: str = "5 seconds",
                       bound: str = "1 second", lateness: str = "1 minute") -> DataFrame:
    """Hot pages as one streaming query: static assets dropped, sliding counts per
    url, the top ``n`` of a window emitted by an event-time timer.

    The watermark trails by bound + lateness, so rows that are late but accepted
    count before their windows fire.  Rows behind it would be dropped by Spark;
    :func:`start_hot_pages_split` writes them out first.
    """
    from rillet.operators.routing import filter_static_assets
    from rillet.operators.windows import duration_us
    from rillet.streaming.stateful import TopNOnTimer

    delay = f"{(duration_us(bound) + duration_us(lateness)) // 1000} milliseconds"
    pages = with_event_time(filter_static_assets(log.select("url", "ts")), "ts", delay)
    counts = (pages.groupBy("url", F.window("ts", size, slide).alias("w"))
                   .agg(F.count(F.lit(1)).alias("cnt"))
                   .select("url", F.col("w.end").alias("window_end"), "cnt", F.window_time("w").alias("wt")))
    return counts.groupBy("window_end").transformWithStateInPandas(
        statefulProcessor=TopNOnTimer(n, "url", key_type="string"),
        outputStructType="url string, window_end timestamp, cnt bigint, rn int",
        outputMode="Append", timeMode="EventTime")


def start_hot_pages_split(log: DataFrame, kept_path: str, late_path: str, checkpoint: str, size: str = "10 minutes",
                          slide: str = "5 seconds", bound: str = "1 second",
                          lateness: str = "1 minute") -> StreamingQuery:
    """The late output of the hot-pages job: rows whose last sliding window is past go
    to ``late_path``, the others to ``kept_path``, which :func:`hot_pages_by_timer`
    reads as a stream of files."""
    fn = late_split_batch("ts", size, bound, lateness, kept_path, late_path, checkpoint + "/state", slide)
    return (log.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint + "/query")
            .trigger(availableNow=True).start())


def pv_processing_time(behavior: DataFrame, behavior_value: str = "view", size: str = "15 seconds") -> DataFrame:
    """Views per processing-time window, for update or complete mode: a row counts in
    the window of the moment at which its micro-batch is handled."""
    views = with_processing_time(behavior.where(F.col("behavior") == behavior_value))
    return (views.groupBy(F.window("proc_ts", size).alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
                 .select(F.lit("pv").alias("label"), F.col("w.end").alias("window_end"), "cnt"))


def min_by_window_stream(sensor: DataFrame, size: str = "5 seconds", bound: str = "2 seconds",
                         lateness: str = "1 minute") -> DataFrame:
    """Tumbling ``minBy(temperature)`` per id with allowed lateness, for update mode.

    The watermark trails the max event time by bound + lateness, so a window
    stays open for late rows that long; in update mode each micro-batch that
    changes a window re-emits it (the streaming counterpart of the batch
    :func:`rillet.operators.late.lateness_firings_min_by`).  Rows behind the
    watermark are dropped by Spark; route them first with
    :func:`rillet.streaming.sinks.late_split_batch` to keep them.
    """
    from rillet.operators.windows import duration_us

    delay_ms = (duration_us(bound) + duration_us(lateness)) // 1000
    s = with_event_time(sensor, "ts", f"{delay_ms} milliseconds")
    rec = F.struct("temperature", "arr", "ts_sec")
    return (s.groupBy("id", F.window("ts", size).alias("w")).agg(F.min(rec).alias("m"))
             .select("id", F.col("w.end").alias("window_end"), "m.temperature", "m.ts_sec", "m.arr"))
