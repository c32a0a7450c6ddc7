"""Tumbling, sliding, session and count windows.

Window ends are exclusive and epoch-aligned.  Output columns are flattened to
``window_start`` / ``window_end`` so results can be joined and compared.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.operators.bounds import even_chunks
from rillet.operators.scan import DEFAULT_ARRIVAL_CHUNK, _shared_shuffle, _surrogate_keys, chunk_by, keyed_scan

# Time chunk of sessions, per key: a key with a third of 100 TB over a month has less than
# a gigabyte in a minute, and a fuller minute is cut at sampled bounds; a sparse key has no
# more totals than rows.
SESSION_CHUNK_US = 60_000_000

# Panes of a time chunk that lie together; 4,096 panes that share no window are half a million
# windows of 10 min / 5 s.
CHUNK_PANES = 1 << 12

# Windows that a task lays out, about, where they are sorted: some 300 MB with keys of 50 bytes.
TASK_WINDOWS = 1 << 21
# Tasks of a shuffle at most; beyond them a task lays out more windows, and its sort may spill.
MOST_TASKS = 1 << 14

_UNITS_US = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000,
             "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def duration_us(text: str) -> int:
    """'15 seconds' -> microseconds."""
    n, unit = text.split()
    unit = unit.lower().rstrip("s")
    return int(float(n) * _UNITS_US[unit])


def _ts_type(df: DataFrame, ts: str) -> str:
    return df.schema[ts].dataType.simpleString()


def _from_us(us: Column, like: str) -> Column:
    t = F.timestamp_micros(us)
    return t.cast("timestamp_ntz") if like == "timestamp_ntz" else t


def tumble(df: DataFrame, keys, ts: str, size: str, aggs) -> DataFrame:
    """``groupBy(keys, window(ts, size)).agg(aggs)``; partial aggregation runs map-side."""
    return _flatten(df.groupBy(*keys, F.window(ts, size).alias("w")).agg(*aggs), keys)


def _flatten(res: DataFrame, keys) -> DataFrame:
    out_cols = [c for c in res.columns if c not in keys and c != "w"]
    return res.select(*keys, F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), *out_cols)


def hop(df: DataFrame, keys, ts: str, size: str, slide: str, aggs) -> DataFrame:
    """Sliding window: each row is expanded into size/slide windows, then aggregated."""
    return _flatten(df.groupBy(*keys, F.window(ts, size, slide).alias("w")).agg(*aggs), keys)


def sliding_tasks(df: DataFrame, keys, ts: str, size: str, slide: str) -> int:
    """Tasks that lay out about ``TASK_WINDOWS`` windows of :func:`sliding_counts` each, or fewer.

    A key has no more windows than its panes have one by one, nor than twice a size's for every stretch
    of that size in which it has rows.  A job counts the panes and the stretches by sketches, which are
    all that is shuffled, so the number follows the windows and not the rows.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    panes, stretches = df.where(F.col(ts).isNotNull()).select(
        *(F.approx_count_distinct(F.xxhash64(*keys, F.floor(us / width)))
          for width in (math.gcd(size_us, slide_us), size_us))).first()
    return min(-(-min(panes, 2 * stretches) * -(-size_us // slide_us) // TASK_WINDOWS), MOST_TASKS)


def sliding_counts(df: DataFrame, keys, ts: str, size: str, slide: str, name: str = "cnt") -> DataFrame:
    """(keys..., _end, name): rows per key and sliding window that has any, ends in epoch us.
    See :func:`chunk_counts`."""
    return chunk_counts(df, keys, ts, size, slide, name).select(*keys, "_end", name)


def chunk_counts(df: DataFrame, keys, ts: str, size: str, slide: str, name: str = "cnt",
                 tasks: int = 0) -> DataFrame:
    """(_chunk, _cut, keys..., _end, name): rows per key and sliding window that has any, ends in
    epoch us; rows of a (_chunk, _cut) lie in one partition.

    1. rows are counted per (key, pane), pane = gcd(size, slide), with map-side partial
       aggregation;
    2. time is cut into chunks of eight sizes, and a pane goes to the one or two chunks of the
       windows that hold it: this is the only shuffle of the panes.  All keys of a chunk lie
       together, unless it has more than ``CHUNK_PANES`` panes: those are cut by the key's hash;
    3. in a chunk, a pane adds its count at its key's first window and takes it off after the last; the
       running sum over these changes is the count of all windows up to the next change.

    Windows are laid out only where they come out, so a row costs the same to shuffle however many
    windows hold it.  A chunk's keys come out one after the other over the same stretch of time, so
    their windows repeat, which keeps what is written of them small, and a task that goes on to rank
    windows has nearly always all of a window's keys.  A key has no more panes in a chunk than fit nine
    sizes, so the cut by keys is even however hot a key is.  The panes of a chunk are counted on the
    shuffle of the first step, and only the few wide chunks are broadcast.
    The partition count is explicit (the configured one, or ``tasks`` if more): AQE would size the
    partitions by the panes and lay out all windows in a few tasks.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    pane_us = math.gcd(size_us, slide_us)
    chunk_us = 8 * -(-size_us // slide_us) * slide_us
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    panes = (df.groupBy(*keys, (F.floor(us / pane_us) * pane_us).alias("_pane"))
               .agg(F.count(F.lit(1)).alias("_n")))
    # Window ends e (multiples of slide) with e - size <= pane and pane + pane_us <= e.
    first = F.ceil((F.col("_pane") + pane_us) / slide_us) * slide_us
    last = F.floor((F.col("_pane") + size_us) / slide_us) * slide_us
    placed = panes.select(*keys, "_n", first.alias("_first"), last.alias("_last")).select(
        "*", F.explode(F.sequence(F.floor(F.col("_first") / chunk_us), F.floor(F.col("_last") / chunk_us))).alias("_chunk"))
    # a count of panes that reads their counts, which nothing prunes: both readers share one shuffle
    wide = (placed.groupBy("_chunk").agg(F.sum(F.least("_n", F.lit(1))).alias("_panes"))
                  .where(F.col("_panes") > CHUNK_PANES)
                  .select("_chunk", F.ceil(F.col("_panes") / CHUNK_PANES).alias("_cuts")))
    cut = F.pmod(F.xxhash64(*keys), F.coalesce("_cuts", F.lit(1)))
    placed = placed.join(F.broadcast(wide), "_chunk", "left").withColumn("_cut", cut).drop("_cuts")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartition(max(parts, tasks), "_chunk", "_cut")
    start = F.col("_chunk") * chunk_us
    changes = placed.select("_chunk", "_cut", *keys, F.inline(F.array(
        F.struct(F.greatest("_first", start).alias("_at"), F.col("_n").alias("_d")),
        F.struct((F.least("_last", start + chunk_us - slide_us) + slide_us).alias("_at"), (-F.col("_n")).alias("_d")))))
    # the running sum takes in all changes at one place, and only the last of them has a later next one
    w = Window.partitionBy("_chunk", "_cut", *keys).orderBy("_at")
    runs = changes.select("_chunk", "_cut", *keys, "_at", F.lead("_at").over(w).alias("_next"), F.sum("_d").over(w).alias(name))
    return (runs.where((F.col("_next") > F.col("_at")) & (F.col(name) > 0))
                .select("_chunk", "_cut", *keys,
                        F.explode(F.sequence("_at", F.col("_next") - slide_us, F.lit(slide_us))).alias("_end"), name))


def hop_count_panes(df: DataFrame, keys, ts: str, size: str, slide: str,
                    name: str = "cnt") -> DataFrame:
    """Sliding count by panes and running sums (see :func:`sliding_counts`).

    Same result as :func:`hop` with a count, without expanding rows or pane counts.
    """
    size_us = duration_us(size)
    like = _ts_type(df, ts)
    counts = sliding_counts(df, keys, ts, size, slide, name)
    return counts.select(*keys, _from_us(F.col("_end") - size_us, like).alias("window_start"),
                         _from_us(F.col("_end"), like).alias("window_end"), name)


def session_builtin(df: DataFrame, keys, ts: str, gap: str, aggs) -> DataFrame:
    """``session_window`` grouping (all rows of a key meet in one task)."""
    return _flatten(df.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(*aggs), keys)


def session(df: DataFrame, keys, ts: str, gap: str, aggs,
            chunk_us: int | None = None) -> DataFrame:
    """Event-time session windows (gap-based) that scale with a hot key.

    A row opens a session when the previous row of its key (event-time
    order) is more than ``gap`` earlier; its session starts at the latest
    opening at or before it.  One pass over (key, time chunk):

    * in each chunk, a window gives the in-chunk lag and the running latest
      opening, not counting the chunk's first row;
    * per (key, chunk) we keep first/last timestamp and latest opening;
    * one window per key over those (at most #chunks rows) tells whether
      each chunk's first row opens (gap to the previous chunk's last row) and
      the latest opening in earlier chunks;
    * joined back, session start = the greatest of the three, and the
      aggregate is a partial aggregation over (key, session start).

    Session end = last event + gap.  Rows without event time belong to no
    session, as with the built-in ``session_window``.
    """
    gap_us = duration_us(gap)
    like = _ts_type(df, ts)
    us = "_ts_us"
    d = df.withColumn(us, F.unix_micros(F.col(ts).cast("timestamp"))).where(F.col(us).isNotNull())
    # rows of one microsecond may lie in several chunks, in any order: none of them is a gap apart
    apart = [c for c, t in d.dtypes if "map<" not in t and "variant" not in t]
    d = even_chunks(d.withColumn("_tie", F.xxhash64(*apart)), chunk_by(us, chunk_us or SESSION_CHUNK_US),
                    [us, "_tie"], keys, name="_chunk").drop("_tie")
    d, sur = _surrogate_keys(d, list(keys))
    gkeys = sur if sur is not None else list(keys)
    part = [*gkeys, "_chunk"]
    d = _shared_shuffle(d, part)
    w = Window.partitionBy(*part).orderBy(us)
    gap_open = F.col(us) - F.lag(us).over(w) > gap_us
    d = d.withColumn("_open", F.when((F.row_number().over(w) > 1) & gap_open, F.col(us)))
    d = d.withColumn("_run", F.max("_open").over(w.rowsBetween(Window.unboundedPreceding, 0)))

    tot = d.groupBy(*part).agg(F.min(us).alias("_first"), F.max(us).alias("_last"),
                               F.max("_open").alias("_mopen"))
    wk = Window.partitionBy(*[F.col(k) for k in gkeys]).orderBy("_chunk")
    prev_last = F.lag("_last").over(wk)
    tot = tot.withColumn("_fopen", F.when(prev_last.isNull() | (F.col("_first") - prev_last > gap_us),
                                          F.col("_first")))
    tot = tot.withColumn("_before", F.max(F.greatest("_mopen", "_fopen")).over(
        wk.rowsBetween(Window.unboundedPreceding, -1)))
    if sur is not None:
        # same columns as the window partitioning: the join reuses its shuffle
        j = d.join(tot.select(*gkeys, "_chunk", "_fopen", "_before"), part, "inner")
    else:
        offs = tot.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                          F.col("_chunk").alias("_kc"), "_fopen", "_before")
        cond = [d[k].eqNullSafe(offs[f"_k{i}"]) for i, k in enumerate(keys)] + [d["_chunk"] == offs["_kc"]]
        j = d.join(offs, reduce(lambda a, b: a & b, cond), "inner")
    j = j.withColumn("_start", F.greatest("_run", "_fopen", "_before"))
    res = j.groupBy(*keys, "_start").agg(*aggs, F.max(us).alias("_lastev"))
    out_cols = [c for c in res.columns if c not in keys and c not in ("_start", "_lastev")]
    return res.select(*keys, _from_us(F.col("_start"), like).alias("window_start"),
                      _from_us(F.col("_lastev") + gap_us, like).alias("window_end"), *out_cols)


def count_window(df: DataFrame, keys, order: str, value: str, size: int, slide: int,
                 chunk: Column | None = None, seq: str = "seq", name: str = "avg_value") -> DataFrame:
    """``countWindow(size, slide)`` with a mean: per key, at every ``slide``-th
    row, the mean of the last ``min(size, n)`` values.

    Each row's per-key sequence number comes from a chunked running count; the
    row is then copied to the (at most ceil(size/slide)) firings it belongs
    to, and each firing is a plain partial aggregation over (key, firing).  A
    firing exists only if its last row exists, i.e. max(seq) == firing.
    """
    if chunk is None:
        chunk = chunk_by(order, DEFAULT_ARRIVAL_CHUNK)
    d = keyed_scan(df.select(*dict.fromkeys([*keys, order, value])), keys, [F.col(order)], chunk, running={"_rn": ("count", F.lit(1))})
    first = F.ceil(F.col("_rn") / slide) * slide
    last = F.col("_rn") + (size - 1)
    d = d.select(*keys, value, "_rn",
                 F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"), F.lit(slide).cast("bigint")))
                 .alias(seq))
    return (d.groupBy(*keys, seq)
              .agg((F.sum(value).cast("double") / F.count(value)).alias(name), F.max("_rn").alias("_last"))
              .where(F.col("_last") == F.col(seq)).drop("_last"))
