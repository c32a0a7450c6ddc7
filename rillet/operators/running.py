"""Keyed running operators: one output row per input row.

All of them are chunked prefix scans (:mod:`rillet.operators.scan`), so a
hot key is processed by many tasks.  ``order`` is the arrival column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.functions.numeric import fixed_digits
from rillet.functions.text import java_split
from rillet.operators.scan import DEFAULT_ARRIVAL_CHUNK, chunk_by, keyed_scan


def _chunk(order: str, chunk: Column | None) -> Column:
    return chunk if chunk is not None else chunk_by(order, DEFAULT_ARRIVAL_CHUNK)


def word_count(lines: DataFrame, value: str = "value", sep: str = " ") -> DataFrame:
    """Batch word count: split like Java, group, count (partial aggregation map-side)."""
    return (lines.select(F.explode(java_split(value, sep)).alias("word"))
                 .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


def running_word_count(lines: DataFrame, order: str, value: str = "value", sep: str = " ",
                       chunk: Column | None = None, fan: int | None = 1024) -> DataFrame:
    """``keyBy(word).sum(1)``: for every token, the count of that word so far.

    A frequent word occurs in every chunk, so chunk totals are combined in two
    levels of ``fan``."""
    tokens = lines.select(F.col(order), F.posexplode(java_split(value, sep)).alias("pos", "word"))
    return keyed_scan(tokens, ["word"], [F.col(order), F.col("pos")], _chunk(order, chunk),
                      running={"cnt": ("count", F.lit(1))}, fan=fan)


def rolling_max_by(df: DataFrame, key: str, order: str, value: str, fields,
                   chunk: Column | None = None) -> DataFrame:
    """``maxBy(value)``: for each row, the record holding the running maximum of
    ``value`` for its key; on ties the earliest record is kept."""
    rec = F.struct(F.col(value).alias("_v"), (-F.col(order)).alias("_neg"),
                   *[F.col(f).alias(f) for f in fields])
    used = df.select(*dict.fromkeys([key, order, value, *fields]))
    out = keyed_scan(used, [key], [F.col(order)], _chunk(order, chunk), running={"_best": ("max", rec)})
    return out.select(key, order, *[F.col(f"_best.{f}").alias(f"max_{f}") for f in fields])


def rolling_reduce(df: DataFrame, key: str, order: str, ts: str, value: str,
                   chunk: Column | None = None) -> DataFrame:
    """``reduce((cur, new) -> (id, new.ts, max(cur.v, new.v)))``."""
    used = df.select(*dict.fromkeys([key, order, ts, value]))
    out = keyed_scan(used, [key], [F.col(order)], _chunk(order, chunk), running={"_max": ("max", F.col(value))})
    return out.select(key, order, ts, F.col("_max").alias(f"max_{value}"))


def keyed_running_count(df: DataFrame, key: str, order: str,
                        chunk: Column | None = None) -> DataFrame:
    """Value-state counter per key, emitted after each increment."""
    return keyed_scan(df.select(key, order), [key], [F.col(order)], _chunk(order, chunk),
                      running={"cnt": ("count", F.lit(1))})


def global_running_count(df: DataFrame, order: str, chunk: Column | None = None) -> DataFrame:
    """Running count over the whole stream in arrival order: per-chunk counts,
    prefix sums over chunks, in-chunk row numbers (no single-partition window)."""
    return keyed_scan(df.select(order), [], [F.col(order)], _chunk(order, chunk),
                      running={"cnt": ("count", F.lit(1))})


def temp_jump_alert(df: DataFrame, key: str, order: str, value: str, threshold: float = 10.0,
                    chunk: Column | None = None) -> DataFrame:
    """Emit (key, last, current) when |current - last| >= threshold; the first
    reading of a key never fires and every reading becomes the new last."""
    out = keyed_scan(df.select(key, order, value), [key], [F.col(order)], _chunk(order, chunk),
                     lags={"last_value": F.col(value)})
    return (out.where(F.col("last_value").isNotNull() &
                      (F.abs(F.col(value) - F.col("last_value")) >= F.lit(threshold)))
               .select(key, order, "last_value", F.col(value).alias("cur_value")))


def group_count_avg(df: DataFrame, key: str, value: str) -> DataFrame:
    """``select key, count(key), avg(value) group by key``."""
    return df.groupBy(key).agg(F.count(key).alias("cnt"), F.avg(value).alias("avg_value"))


def retract_changelog(df: DataFrame, key: str, order: str, value: str,
                      chunk: Column | None = None, digits: int | None = None) -> DataFrame:
    """The grouped count/avg as a retract stream.

    For every input row: ``(true, key, cnt, avg)`` with the new result, and
    unless it is the key's first row, ``(false, key, cnt', avg')`` retracting
    the previous result.  ``cnt`` is ``count(key)``; the mean is over non-null
    values, null before the first.  The previous result comes from the same
    scan: its running sum and counts without the row itself.
    """
    run = keyed_scan(df.select(key, order, value), [key], [F.col(order)], _chunk(order, chunk),
                     running={"_rn": ("count", F.lit(1)), "_n": ("count", F.col(key)),
                              "_m": ("count", F.col(value)), "_s": ("sum", F.col(value)),
                              "_n0": ("count", F.col(key), True), "_m0": ("count", F.col(value), True),
                              "_s0": ("sum", F.col(value), True)})

    def result(add: bool, n: str, m: str, s: str) -> Column:
        avg = F.when(F.col(m) > 0, F.col(s) / F.col(m))
        avg = avg if digits is None else fixed_digits(avg, digits)
        return F.struct(F.lit(add).alias("is_add"), F.col(n).alias("cnt"), avg.alias("avg_value"))

    # both rows of a change come from one pass: explode (retraction, addition)
    # instead of a union that would instantiate the pipeline twice
    added = F.array(result(True, "_n", "_m", "_s"))
    both = F.array(result(False, "_n0", "_m0", "_s0"), result(True, "_n", "_m", "_s"))
    return (run.select(key, order, F.explode(F.when(F.col("_rn") > 1, both).otherwise(added)).alias("_c"))
               .select("_c.is_add", key, order, "_c.cnt", "_c.avg_value"))
