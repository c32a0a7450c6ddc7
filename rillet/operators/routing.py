"""Projection, filters and stream routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.text import asset_url, java_split, utf16_length


def map_line_length(lines: DataFrame, value: str = "value") -> DataFrame:
    """Each line with its length in UTF-16 units."""
    return lines.select("*", utf16_length(value).alias("len"))


def flatmap_fields(lines: DataFrame, value: str = "value", sep: str = ",") -> DataFrame:
    keep = [c for c in lines.columns if c != value]
    return lines.select(*keep, F.posexplode(java_split(value, sep)).alias("pos", "field"))


def filter_prefix(lines: DataFrame, prefix: str, value: str = "value") -> DataFrame:
    return lines.where(F.col(value).startswith(prefix))


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def filter_static_assets(log: DataFrame, url: str = "url", method: str | None = None) -> DataFrame:
    """Drop static-asset urls; optionally keep one HTTP method only."""
    out = log.where(~asset_url(url))
    return out.where(F.col("method") == method) if method else out


def split_route(df: DataFrame, predicate, high: str = "high", low: str = "low",
                tag: str = "route") -> DataFrame:
    """Tag each row with the name of its sub-stream."""
    return df.withColumn(tag, F.when(predicate, F.lit(high)).otherwise(F.lit(low)))


def select_route(tagged: DataFrame, *names: str, tag: str = "route") -> DataFrame:
    """``select(names)`` of a split stream: each row at most once."""
    return tagged.where(F.col(tag).isin(*names))


def connect_map(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two differently-typed streams merged: columns are unioned by name and
    missing ones are null."""
    return first.unionByName(second, allowMissingColumns=True)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union keeping duplicates."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def tag_partition(df: DataFrame, name: str = "subtask") -> DataFrame:
    """Each row with the index of the task that processes it."""
    return df.withColumn(name, F.spark_partition_id())


def map_partitions_with_setup(df: DataFrame, open_, each, close, schema) -> DataFrame:
    """A map with set-up and tear-down per partition.

    In each task ``open_(index)`` makes a context (a connection, a parsed
    model) once, ``each(context, frame)`` maps the task's rows batch by batch
    (pandas frames), and ``close(context)`` runs when the task ends, also after
    an error.
    """
    def run(batches):
        from pyspark import TaskContext

        context = open_(TaskContext.get().partitionId())
        try:
            for frame in batches:
                yield each(context, frame)
        finally:
            close(context)

    return df.mapInPandas(run, schema)


def redistribute(df: DataFrame, n: int | None = None) -> DataFrame:
    """Round-robin spread over ``n`` partitions, or over as many as the session's
    shuffle setting and adaptive execution choose."""
    return df.repartition(n) if n else df.hint("rebalance")
