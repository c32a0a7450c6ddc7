"""Per-row watermarks, late-row split and allowed-lateness refiring (batch).

Streaming engines emit watermarks periodically, so which rows count as late
depends on timing.  Here the watermark seen by a row is defined
deterministically: the maximum event time of all rows that arrived before
it, minus the out-of-orderness bound.  With that definition:

* a row is *on time* if its window has not fired (wm < end - 1us);
* *late but accepted* if the window fired but is kept (wm < end - 1us + lateness);
  the window then fires again with the row added;
* *late* otherwise; such rows go to a separate output instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.operators.bounds import even_chunks
from rillet.operators.ranking import top_n
from rillet.operators.scan import DEFAULT_ARRIVAL_CHUNK, DEFAULT_TIME_CHUNK_US, chunk_by, keyed_scan
from rillet.operators.windows import duration_us

ON_TIME, ACCEPTED, LATE = "on_time", "late_accepted", "late"


def arrival_chunk(df: DataFrame, arrival: str) -> Column:
    """Chunks of the arrival order for the prefix scans.

    A timestamp arrival column is cut into chunks of ten seconds; a microsecond
    epoch column (name ending in ``_us``) likewise; any other numeric arrival
    sequence into runs of 2^20.  Each chunk is one task's window, sorted with
    spilling; ten seconds of 100 TB over 30 days are 400 MB on average and a burst
    more, which :func:`even_arrival_chunks` cuts further.  Totals, one row per
    chunk, meet in one task.
    """
    dtype = dict(df.dtypes)[arrival]
    if dtype.startswith("timestamp"):
        return chunk_by(F.unix_micros(F.col(arrival).cast("timestamp")), DEFAULT_TIME_CHUNK_US)
    if arrival.endswith("_us"):
        return chunk_by(arrival, DEFAULT_TIME_CHUNK_US)
    return chunk_by(arrival, DEFAULT_ARRIVAL_CHUNK)


def even_arrival_chunks(df: DataFrame, arrival: list, name: str = "_even") -> DataFrame:
    """Add ``name``: the chunks of :func:`arrival_chunk`, crowded ones cut at sampled quantiles."""
    return even_chunks(df, arrival_chunk(df, arrival[0]), arrival, name=name)


def running_watermark(df: DataFrame, ts: str, arrival: list, bound: str,
                      chunk: Column | None = None, name: str = "wm_us") -> DataFrame:
    """Watermark (epoch microseconds) in force when each row arrives:
    max event time over earlier arrivals minus ``bound``; null for the first.

    Global prefix max done by chunks of arrival order: in-chunk running max,
    plus the max of all earlier chunks.  The chunks' totals meet in one task: a row for
    ten seconds, or one for 2^20 rows, so a million of them stand for 10^12 rows.  Without
    ``chunk`` a burst is cut at quantiles of a sample, which runs a job.
    """
    bound_us = duration_us(bound)
    d = df.withColumn("_ts_us", F.unix_micros(F.col(ts).cast("timestamp")))
    if chunk is None:
        d = even_arrival_chunks(d, arrival, "_wm_chunk")
        chunk = F.col("_wm_chunk")
    d = keyed_scan(d, [], [F.col(a) for a in arrival], chunk,
                   running={"_maxb": ("max", F.col("_ts_us"))}, exclusive=True)
    return d.withColumn(name, F.col("_maxb") - F.lit(bound_us)).drop("_maxb", "_ts_us", "_wm_chunk")


def classify_lateness(df: DataFrame, ts: str, arrival: list, size: str, bound: str,
                      lateness: str = "0 seconds", chunk: Column | None = None,
                      status: str = "status", slide: str | None = None) -> DataFrame:
    """Tag rows on_time / late_accepted / late for windows of ``size``, tumbling or
    moving by ``slide``.  A row of sliding windows is judged by the last one that
    holds it: it is late only when that one is past."""
    d = running_watermark(df, ts, arrival, bound, chunk)
    d = d.withColumn("_end_us", last_window_end(ts, size, slide))
    return d.withColumn(status, status_of(F.col("_end_us"), F.col("wm_us"), duration_us(lateness)))


def last_window_end(ts: str, size: str, slide: str | None = None) -> Column:
    """End (epoch microseconds) of the last window that holds a row."""
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide else size_us
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / slide_us) * slide_us + size_us


def status_of(end_us: Column, wm_us: Column, late_us: int) -> Column:
    """What a window that ends at ``end_us`` does with a row that meets the watermark ``wm_us``."""
    last = end_us - 1
    return (F.when(wm_us.isNull() | (wm_us < last), F.lit(ON_TIME))
             .when(wm_us < last + late_us, F.lit(ACCEPTED))
             .otherwise(F.lit(LATE)))


def late_split(df: DataFrame, ts: str, arrival: list, size: str, bound: str,
               lateness: str = "0 seconds", chunk: Column | None = None, slide: str | None = None,
               path: str | None = None):
    """(kept, late): rows the window operator takes, and the side output.

    With ``path`` all rows are tagged and written once, a folder per status, and
    both outputs read what was written: one pass over ``df``, however many outputs
    are used.  Without it each output that is used repeats the tagging.
    """
    tagged = classify_lateness(df, ts, arrival, size, bound, lateness, chunk, slide=slide)
    if path is not None:
        tagged.write.partitionBy("status").parquet(path)
        tagged = df.sparkSession.read.schema(tagged.schema).parquet(path)
    kept = tagged.where(F.col("status") != LATE)
    late = tagged.where(F.col("status") == LATE)
    return kept, late


def lateness_firings_min_by(df: DataFrame, key: str, ts: str, arrival: list, value: str,
                            size: str, bound: str, lateness: str,
                            chunk: Column | None = None) -> DataFrame:
    """Every firing of a tumbling ``minBy(value)`` window with allowed lateness.

    ``fire_seq`` 0 is the firing when the watermark passes the window end and
    holds all on-time rows; each accepted late row refires the window
    (``fire_seq`` 1, 2, ...) with itself added.  ``cnt`` is the number of rows
    in the window at that firing; ``min_value`` / ``min_arr`` describe the
    minimum record (earliest arrival on ties).
    """
    even = df.withColumn("_even", chunk) if chunk is not None else even_arrival_chunks(df, arrival)
    tagged = classify_lateness(even, ts, arrival, size, bound, lateness, F.col("_even"))
    like = df.schema[ts].dataType.simpleString()
    arr0 = arrival[-1]
    rec = F.struct(F.col(value).alias("v"), F.col(arr0).alias("a"))
    on_time = F.col("status") == ON_TIME
    # The watermark only grows along arrival order, so every on-time row of a
    # window arrives before its first accepted late row: one running scan over
    # the kept rows gives the initial firing, at the last on-time row, and each
    # refire (on-time rows + the accepted rows so far).
    kept = tagged.where(F.col("status") != LATE)
    run = keyed_scan(kept, [key, "_end_us"], [F.col(a) for a in arrival], F.col("_even"),
                     running={"n": ("count", F.lit(1)),
                              "n_on": ("sum", on_time.cast("bigint")),
                              "m": ("min", rec)},
                     overall={"all_on": ("sum", on_time.cast("bigint"))})
    fires = run.where(~on_time | (F.col("n_on") == F.col("all_on")))
    seq = F.when(on_time, 0).otherwise(F.col("n") - F.col("n_on") - F.when(F.col("n_on") == 0, 1).otherwise(0))
    out = fires.select(key, "_end_us", seq.cast("bigint").alias("fire_seq"), F.col("n").alias("cnt"), "m")
    end_ts = F.timestamp_micros(F.col("_end_us"))
    if like == "timestamp_ntz":
        end_ts = end_ts.cast("timestamp_ntz")
    return out.select(key, end_ts.alias("window_end"), "fire_seq", "cnt",
                      F.col("m.v").alias("min_value"), F.col("m.a").alias("min_arr"))


def window_takings(tagged: DataFrame, key: str, ts: str, size: str, slide: str, lateness: str) -> DataFrame:
    """(key, end_us, n_on, n_late): rows that each sliding window of a key takes on time and late.

    ``tagged``: rows with ``wm_us``, the watermark that each meets.  Every window that
    holds a row judges it by itself: one that is past by more than ``lateness`` does
    not take it.  Rows are counted by the span of windows that take them before
    they are laid out window by window.
    """
    size_us, slide_us, late_us = duration_us(size), duration_us(slide), duration_us(lateness)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    last = last_window_end(ts, size, slide)
    wm = F.coalesce(F.col("wm_us"), F.lit(-(1 << 62)))

    def first_above(least: Column) -> Column:
        """The least window end above ``least``; beyond ``last`` if there is none."""
        return last - F.floor((last - least - 1) / slide_us) * slide_us

    first = F.greatest(first_above(us), first_above(wm + 1 - late_us))
    spans = (tagged.select(key, last.alias("_last"), first.alias("_first"), first_above(wm + 1).alias("_on"))
             .where(F.col("_first") <= F.col("_last"))
             .withColumn("_on", F.least(F.greatest("_on", "_first"), F.col("_last") + slide_us))
             .groupBy(key, "_first", "_on", "_last").agg(F.count(F.lit(1)).alias("_n")))
    ends = spans.withColumn("end_us", F.explode(F.sequence("_first", "_last", F.lit(slide_us))))
    on = F.when(F.col("end_us") >= F.col("_on"), F.col("_n")).otherwise(0)
    return ends.groupBy(key, "end_us").agg(F.sum(on).alias("n_on"), F.sum(F.col("_n") - on).alias("n_late"))


def refired_top_n(df: DataFrame, key: str, ts: str, arrival: list, size: str, slide: str, bound: str, lateness: str,
                  n: int, chunk: Column | None = None) -> DataFrame:
    """The top ``n`` keys of every sliding window as it first fires and as it stands at last.

    Columns: window_end, firing (``first``: the rows on time; ``last``: those taken late
    as well), key, cnt, rn.  A window without rows on time has no first ranking.
    """
    tagged = running_watermark(df, ts, arrival, bound, chunk)
    counts = window_takings(tagged, key, ts, size, slide, lateness)
    both = counts.select(key, "end_us", F.explode(F.array(
        F.struct(F.lit("first").alias("firing"), F.col("n_on").alias("cnt")),
        F.struct(F.lit("last").alias("firing"), (F.col("n_on") + F.col("n_late")).alias("cnt")))).alias("f"))
    both = both.select(key, "end_us", "f.*").where(F.col("cnt") > 0)
    ranked = top_n(both, ["end_us", "firing"], [F.desc("cnt"), F.asc(key)], n)
    end = F.timestamp_micros("end_us").cast(df.schema[ts].dataType)
    return ranked.select(end.alias("window_end"), "firing", key, "cnt", "rn")
