"""Chunk bounds from a sample: crowded chunks of a prefix scan are cut at quantiles of their rows.

The scans of :mod:`rillet.operators.scan` cut time into cells of fixed width.  A burst
fills one cell with many tasks' rows.  Here a hashed sample tells which cells are
crowded and where, in the order of the scan, they are to be cut, so that all chunks
hold about the same number of rows however time is filled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet.session import scratch_path

# Rows of a chunk, about; tables of more than MOST_BOUNDS times as many have larger chunks.
CHUNK_ROWS = 1 << 20
# Bounds of a table, about: with their order columns of fixed width a few megabytes, which are broadcast.
MOST_BOUNDS = 1 << 16
# Sampled rows between two bounds: chunks differ by an eighth or so.
SAMPLES = 64
_PLACE_BITS = 18
# Cell of the rows without one; they come first.
_NO_CELL = -(1 << 43)

_WIDE = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def _fixed_width(df: DataFrame, order: list[str]) -> list[str]:
    """The leading order columns whose values have a bounded size."""
    out = []
    for c in order:
        if isinstance(df.schema[c].dataType, _WIDE):
            break
        out.append(c)
    return out


def even_chunks(df: DataFrame, cell: Column, order: list[str], keys=(), rows: int | None = None,
                name: str = "_even") -> DataFrame:
    """Add ``name``, a chunk id (bigint) that never falls along ``order`` within a key.

    ``cell`` (bigint, below 2^43 in size, never falling along ``order``) gives the chunks where rows are
    sparse.  A cell of a key that holds more than about twice ``rows`` rows is cut at sampled
    quantiles of ``order``.  Rows that agree in all order columns stay together; rows
    without a cell are a cell of their own, before the others.  A table of fewer
    than twice ``rows`` rows has nothing to cut and only its rows are counted.

    Jobs run while the chunks are set up: a count, and over larger tables one pass that
    keeps ``SAMPLES`` rows of every ``rows`` and writes their quantiles to the shared folder.
    """
    rows = rows or CHUNK_ROWS
    own = F.coalesce(cell, F.lit(_NO_CELL)).cast("bigint")
    total = df.count()
    by = _fixed_width(df, list(order))
    if total < 2 * rows or not by:
        return df.withColumn(name, own)
    rows = max(rows, -(-total // MOST_BOUNDS))
    key = F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")
    wide = df.withColumn("_b_key", key).withColumn("_b_cell", own).withColumn("_b_at", F.struct(*by))

    # the hash decides, not a random number: a task that runs again draws the same rows
    drawn = F.xxhash64(*keys, *by).bitwiseAND(F.lit((1 << 62) - 1)) < F.lit(min((SAMPLES << 62) // rows, (1 << 62)))
    sample = (wide.where(drawn).groupBy("_b_key", "_b_cell", "_b_at").agg(F.count(F.lit(1)).alias("_b_n")))
    group = Window.partitionBy("_b_key", "_b_cell")
    so_far = F.sum("_b_n").over(group.orderBy("_b_at").rowsBetween(Window.unboundedPreceding, 0))
    placed = sample.select("*", so_far.alias("_b_sum"), F.sum("_b_n").over(group).alias("_b_all"))
    ends = placed.where((F.col("_b_all") >= 2 * SAMPLES) & (
        F.floor(F.col("_b_sum") / SAMPLES) > F.floor((F.col("_b_sum") - F.col("_b_n")) / SAMPLES)))
    bounds = ends.groupBy("_b_key", "_b_cell").agg(F.sort_array(F.collect_list("_b_at")).alias("_b_bounds"))
    path = scratch_path(df.sparkSession, "chunk-bounds")
    bounds.write.parquet(path)
    bounds = df.sparkSession.read.schema(bounds.schema).parquet(path)
    if bounds.isEmpty():
        return df.withColumn(name, own)

    # how many bounds are at or below the row: a binary search in steps of powers of two
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(_PLACE_BITS))])
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get("_b_bounds", at + step - 1) <= F.col("_b_at"), at + step).otherwise(at))
    place = F.when(F.col("_b_bounds").isNull(), 0).otherwise(place)
    return (wide.join(F.broadcast(bounds), ["_b_key", "_b_cell"], "left")
            .select(*[F.col(c) for c in df.columns], (F.col("_b_cell") * (1 << _PLACE_BITS) + place).alias(name)))
