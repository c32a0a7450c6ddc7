"""Chunked prefix scans: keyed running aggregates and lags without hot groups.

``Window.partitionBy(key).orderBy(arrival)`` sends every row of a key to one
task, so a key holding a third of the data would stall one executor.  Here the
arrival order is cut into chunks; the window runs per (key, chunk), each
(key, chunk) contributes one total, and the totals of earlier chunks are
prefix-combined per key (a window over at most #chunks rows per key) and
joined back.  Only associative aggregates (count, sum, max, min) and lags are
supported, which is all the running operators need.

Plan shape: one scan and one shuffle of the input by (key, chunk), which the
totals branch reads again (a reused exchange); a small shuffle of the totals by
key; and a join that AQE broadcasts when the offsets are small.  With ``fan``
the totals of a key are themselves combined in two levels, so a key with very
many chunks is not one task's work either.

Rows whose order column is null come first, as in a plain window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "_chunk"
# Rows of arrival order per chunk.  At sf0.1 everything is one chunk; at
# 100 TB a hot key is spread over ~#rows / 2^20 chunks.
DEFAULT_ARRIVAL_CHUNK = 1 << 20
# Chunk of time-ordered scans (ten seconds, in microseconds): a busy minute is six tasks'
# work, and a year has some three million totals.
DEFAULT_TIME_CHUNK_US = 10_000_000

# Chunk of the rows whose order column is null.
NO_CHUNK = -(1 << 62)

_AGG = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}
_COMBINE = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}


def chunk_by(c, width: int) -> Column:
    """Chunk id of a numeric or timestamp ordering column."""
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col / F.lit(width)).cast("bigint")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _zero_of(dtype: T.DataType) -> Column | None:
    """A non-null value of the key's type (stands in for null next to a flag)."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_seconds(F.lit(0)).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.to_date(F.lit("1970-01-01"))
    return None


def _surrogate_keys(df: DataFrame, keys: list[str]):
    """Replace each key by (value-or-zero, is-null): both never null, so the
    window partitioning and the join back use the same plain columns and the
    join reuses the window's shuffle instead of re-partitioning the data."""
    names = []
    for i, k in enumerate(keys):
        zero = _zero_of(df.schema[k].dataType)
        if zero is None:
            return df, None
        df = df.withColumn(f"_kv{i}", F.coalesce(F.col(k), zero)).withColumn(f"_kn{i}", F.col(k).isNull())
        names += [f"_kv{i}", f"_kn{i}"]
    return df, names


def _shared_shuffle(df: DataFrame, part: list[str]) -> DataFrame:
    """Shuffle ``df`` by ``part`` so that all readers share the exchange.

    The other columns pass through a one-row generator: a reader that needs
    few of them cannot be pruned below the exchange, which would make its plan
    another one and scan and shuffle the source again.
    """
    rest = [c for c in df.columns if c not in part]
    df = df.repartition(*[F.col(c) for c in part]) if part else df
    if not rest:
        return df
    return df.select(*part, F.inline(F.array(F.struct(*rest))))


def _prefix(totals: DataFrame, keys: list[str], chunk: str, fns: dict, lags: list, fan: int | None,
            whole: dict) -> DataFrame:
    """keys, chunk and, per running aggregate, the combination of all earlier chunks'
    totals (``_o_``); per lag, the last value of the latest earlier chunk (``_p_``);
    per overall aggregate, the combination of all chunks' totals (``_a_``)."""
    def all_of(by: list[str]) -> list[Column]:
        w = Window.partitionBy(*by).orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return [_COMBINE[fn](f"_t_{n}").over(w).alias(f"_a_{n}") for n, fn in whole.items()]

    def offsets(t: DataFrame, by: list[str], order: str) -> list[Column]:
        w = Window.partitionBy(*by).orderBy(order)
        prior = w.rowsBetween(Window.unboundedPreceding, -1)
        return ([_COMBINE[fn](f"_t_{n}").over(prior).alias(f"_o_{n}") for n, fn in fns.items()]
                + [F.lag(f"_e_{n}").over(w).alias(f"_p_{n}") for n in lags])

    if fan is None:
        return totals.select(*keys, chunk, *offsets(totals, keys, chunk), *all_of(keys))
    # never null for Catalyst either: a test for null pushed below the shuffle of the rows into one of its readers would
    # make it another shuffle
    wide = totals.withColumn("_span", F.coalesce(F.floor(F.col(chunk) / fan), F.lit(NO_CHUNK)))
    wide = _shared_shuffle(wide, [*keys, "_span"])
    inner = wide.select(*keys, chunk, "_span", *offsets(wide, [*keys, "_span"], chunk))
    spans = wide.groupBy(*keys, "_span").agg(
        *[_COMBINE[fn](f"_t_{n}").alias(f"_t_{n}") for n, fn in {**fns, **whole}.items()],
        *[F.max_by(f"_e_{n}", chunk).alias(f"_e_{n}") for n in lags])
    outer = spans.select(*keys, "_span", *[c.alias(f"_s{i}") for i, c in enumerate(offsets(spans, keys, "_span"))],
                         *all_of(keys))
    both = inner.join(outer, [*keys, "_span"])
    out = []
    for i, n in enumerate([*fns, *lags]):
        if n in fns:
            a, b, fn = F.col(f"_o_{n}"), F.col(f"_s{i}"), fns[n]
            merged = (F.greatest(a, b) if fn == "max" else F.least(a, b) if fn == "min" else
                      F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b))
            out.append(merged.alias(f"_o_{n}"))
        else:
            out.append(F.coalesce(f"_p_{n}", f"_s{i}").alias(f"_p_{n}"))
    return both.select(*keys, chunk, *out, *[f"_a_{n}" for n in whole])


def keyed_scan(df: DataFrame, keys, order, chunk: Column | None = None,
               running: dict | None = None, lags: dict | None = None,
               exclusive: bool = False, fan: int | None = None, overall: dict | None = None) -> DataFrame:
    """Add running aggregates / lags per key in ``order``.

    ``overall``: ``{out: (fn, column)}`` over all rows of the key, from the same totals.

    ``running``: ``{out: (fn, column)}`` with fn in count/sum/max/min, over all
    earlier rows of the key and the row itself (``exclusive``, or a third item
    True for one output, drops the row).
    ``lags``: ``{out: column}``, the value on the previous row of the key.
    ``chunk``: chunk id column; must be non-decreasing in ``order``.
    ``fan``: chunks of a key whose totals one task combines;
    None combines all of a key's chunks at once.
    """
    keys = list(keys)
    order = [_c(o) for o in (order if isinstance(order, (list, tuple)) else [order])]
    running = running or {}
    lags = lags or {}
    overall = overall or {}
    if chunk is None:
        raise ValueError("keyed_scan needs a chunk column")
    # a null order has a chunk of its own, before all others
    df = df.withColumn(CHUNK, F.coalesce(chunk, F.lit(NO_CHUNK)))
    df, sur = _surrogate_keys(df, keys)
    gkeys = sur if sur is not None else keys  # grouping / join columns
    part = [*gkeys, CHUNK]
    if sur is not None:
        # the surrogates travel for the keys, which come back behind the shuffle
        columns = df.columns
        df = _shared_shuffle(df.drop(*keys), part)
        restored = {k: F.when(~F.col(f"_kn{i}"), F.col(f"_kv{i}")).alias(k) for i, k in enumerate(keys)}
        df = df.select(*[restored.get(c, F.col(c)) for c in columns])
    else:
        df = _shared_shuffle(df, part)

    w = Window.partitionBy(*part).orderBy(*order)

    local = df
    for name, (fn, c, *before) in running.items():
        last = -1 if exclusive or any(before) else Window.currentRow
        local = local.withColumn(f"_l_{name}", _AGG[fn](_c(c)).over(w.rowsBetween(Window.unboundedPreceding, last)))
    if lags:
        local = local.withColumn("_first", F.row_number().over(w) == 1)
        for name, c in lags.items():
            local = local.withColumn(f"_lag_{name}", F.lag(_c(c)).over(w))

    tot_exprs = [_AGG[fn](_c(c)).alias(f"_t_{name}") for name, (fn, c, *_) in {**running, **overall}.items()]
    tot_exprs += [F.max_by(F.struct(_c(c).alias("x")), F.struct(*(F.struct(o.isNotNull(), o) for o in order)))
                  .alias(f"_e_{name}") for name, c in lags.items()]
    totals = df.groupBy(*part).agg(*tot_exprs)
    fns = {name: fn for name, (fn, *_) in running.items()}
    whole = {name: fn for name, (fn, _) in overall.items()}
    offsets = _prefix(totals, gkeys, CHUNK, fns, list(lags), fan, whole)

    if sur is not None:
        # plain equi-join on the columns the window is partitioned by
        joined = local.join(offsets, part, "inner")
    else:
        offsets = offsets.select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)],
                                 F.col(CHUNK).alias("_k_chunk"),
                                 *[c for c in offsets.columns if c not in keys and c != CHUNK])
        cond = [local[k].eqNullSafe(offsets[f"_k_{i}"]) for i, k in enumerate(keys)]
        cond.append(local[CHUNK] == offsets["_k_chunk"])
        joined = local.join(offsets, reduce(lambda a, b: a & b, cond), "inner")

    out = joined
    for name, fn in fns.items():
        lo, of = F.col(f"_l_{name}"), F.col(f"_o_{name}")
        if fn == "count":
            val = lo + F.coalesce(of, F.lit(0))
        elif fn == "sum":
            val = F.when(lo.isNull(), of).when(of.isNull(), lo).otherwise(lo + of)
        elif fn == "max":
            val = F.greatest(lo, of)
        else:
            val = F.least(lo, of)
        out = out.withColumn(name, val)
    for name in lags:
        out = out.withColumn(name, F.when(F.col("_first"), F.col(f"_p_{name}.x"))
                             .otherwise(F.col(f"_lag_{name}")))
    for name in whole:
        out = out.withColumn(name, F.col(f"_a_{name}"))
    drop = [c for c in out.columns if c.startswith(("_l_", "_o_", "_lag_", "_p_", "_k_", "_a_"))]
    drop += ["_first"] if lags else []
    return out.drop(*drop, CHUNK, *(sur or []))


def running_count(df: DataFrame, keys, order, chunk: Column | None = None,
                  name: str = "cnt", fan: int | None = None) -> DataFrame:
    """Row number per key in arrival order (1-based), without a per-key task."""
    return keyed_scan(df, keys, order, chunk, running={name: ("count", F.lit(1))}, fan=fan)
