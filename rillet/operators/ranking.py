"""Top-N per group and the text report.

``row_number() <= n`` over a partitioned window is planned by Spark as a
partial ``WindowGroupLimit`` before the shuffle, so at most n rows per group
and map task travel, however large a group is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.session import scratch_path


def top_n(df: DataFrame, group, order, n: int, rank: str = "rn") -> DataFrame:
    """Rows ranked 1..n per group by ``order`` (list of sort Columns)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def topn_report(ranked: DataFrame, group: str, rank: str, line: Column,
                header: Column, footer: str = "") -> DataFrame:
    """One text block per group: header line, then the ranked lines in order.

    Groups hold at most n rows after :func:`top_n`, so collecting them is bounded.
    """
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"),
                                                              line.alias("l")))),
                        lambda x: x["l"])
    return (ranked.groupBy(group)
                  .agg(F.first(header).alias("_h"), lines.alias("_lines"))
                  .select(group, F.concat_ws("\n", F.concat(F.array(F.col("_h")), F.col("_lines"),
                                                            F.array(F.lit(footer))))
                          .alias("report")))


def sliding_top_n(df: DataFrame, key: str, ts: str, size: str, slide: str, n: int,
                  name: str = "cnt", rank: str = "rn") -> DataFrame:
    """Top ``n`` keys by count in every sliding window, ties broken by key.

    1. count rows per key and window (:func:`rillet.operators.windows.chunk_counts`): what is
       shuffled are the pane counts, by chunk of time, and a chunk of very many panes is cut by
       keys: a window with very many keys is no single task's work;
    2. rank: every task first keeps its own top ``n`` of each window (a partial
       ``WindowGroupLimit``), so only n rows per window, or per part of a wide chunk's window,
       are shuffled by window end.

    A task sorts all windows that it lays out.  So that they fit its memory however many there are, their
    number is estimated first (a job, see :func:`rillet.operators.windows.sliding_tasks`) and
    more tasks than configured take part if need be, in the last ranking a quarter as many.
    """
    from rillet.operators.windows import _from_us, _ts_type, chunk_counts, sliding_tasks

    like = _ts_type(df, ts)
    tasks = sliding_tasks(df, [key], ts, size, slide)
    counts = chunk_counts(df, [key], ts, size, slide, name, tasks).select(
        "_chunk", "_cut", key, _from_us(F.col("_end"), like).alias("window_end"), name)
    order, last = [F.desc(name), F.asc(key)], -(-tasks // 4)
    if last > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        counts = top_n(counts, ["_chunk", "_cut", "window_end"], order, n, rank).repartition(last, "window_end")
    return top_n(counts, ["window_end"], order, n, rank).select(key, "window_end", name, rank)


def top_n_retract(df: DataFrame, group: str, key: str, count: str, n: int) -> DataFrame:
    """The top ``n`` per group as a retract stream.

    A group's rows arrive in the order of ``key``; a row that enters the top
    takes a rank, and every row from that rank on moves down.  Columns: group,
    cause (the key that arrived), is_add (false: the rank's old row, true: its
    new one), rn, key, count; ties go to the smaller key.

    Rows are range-partitioned by (group, key), so a large group is cut into
    chunks of consecutive keys, as many as it fills partitions.  The top of two
    chunks is the top of their tops: the tops of a group's earlier chunks,
    ``n`` rows each, give the top that a chunk starts from, and every chunk is
    replayed by itself, row after row, with only the top in memory.  No task sees
    a whole group, whatever order its counts are in.
    """
    types = dict(df.dtypes)
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "retract-chunks")
    # Written: the tops and the replay must see the same chunks.
    (df.select(group, key, count).repartitionByRange(parts, group, key)
       .withColumn("_chunk", F.spark_partition_id()).write.parquet(path))
    chunks = spark.read.parquet(path)
    best = [F.desc(count), F.asc(key)]
    tops = top_n(chunks, [group, "_chunk"], best, n).drop("rn")
    # Only groups in several chunks hand tops on: about one a partition.
    last = tops.groupBy(group).agg(F.max("_chunk").alias("_last"), F.min("_chunk").alias("_from")).where("_from < _last")

    def carry(frame: pd.DataFrame) -> pd.DataFrame:
        """The top of all earlier chunks, for each chunk of a group but the first."""
        out, top = [], frame.iloc[:0]
        for chunk, more in frame.groupby("_chunk", sort=True):
            if len(top):
                out.append(top.assign(_chunk=chunk))
            top = pd.concat([top, more]).sort_values([count, key], ascending=[False, True]).head(n)
        return pd.concat(out)[[group, "_chunk", key, count]]

    several = tops.join(last.select(F.col(group).alias("_g")), F.col(group).eqNullSafe(F.col("_g")), "left_semi")
    starts = several.groupBy(group).applyInPandas(
        carry, f"{group} {types[group]}, _chunk int, {key} {types[key]}, {count} {types[count]}")

    def replay(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in the order of chunk, group and key, a chunk's starting top before them: only
        the top is held, whatever a chunk's size."""
        at, top = None, []  # (key, count), the best first
        for df in frames:
            if not len(df):
                continue
            names, chunk = df[group].tolist(), df["_chunk"].to_numpy()
            code = pd.factorize(df[group], use_na_sentinel=False)[0]
            cuts = np.flatnonzero((np.diff(code) != 0) | (np.diff(chunk) != 0)) + 1
            keys, counts, given = df[key].tolist(), df[count].to_numpy(), df["_given"].to_numpy()
            out = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(df)]):
                name = names[a]
                here = int(chunk[a]), None if pd.isna(name) else name
                if here != at:
                    at, top = here, []
                i = a + int(given[a:b].sum())
                top = sorted([*top, *zip(keys[a:i], counts[a:i].tolist())], key=lambda x: (-x[1], x[0]))
                while i < b:
                    if len(top) == n:  # on to the next row above the last of the top
                        ahead = counts[i:b] > top[-1][1]
                        step = int(ahead.argmax())
                        if not ahead[step]:
                            break
                        i += step
                    k, c = keys[i], counts[i].item()
                    rank = sum(m >= c for _, m in top)
                    after = [*top[:rank], (k, c), *top[rank:]][:n]
                    for r in range(rank, len(after)):
                        if r < len(top):
                            out.append((here[1], k, False, r + 1, *top[r]))
                        out.append((here[1], k, True, r + 1, *after[r]))
                    top, i = after, i + 1
            yield pd.DataFrame(out, columns=[group, "cause", "is_add", "rn", key, count])

    rows = chunks.withColumn("_given", F.lit(0)).unionByName(starts.withColumn("_given", F.lit(1)))
    rows = rows.repartition(parts, "_chunk").sortWithinPartitions("_chunk", group, F.desc("_given"), key)
    return rows.mapInPandas(
        replay, f"{group} {types[group]}, cause {types[key]}, is_add boolean, rn int, {key} {types[key]}, "
                f"{count} {types[count]}")
