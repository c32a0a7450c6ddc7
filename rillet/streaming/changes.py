"""Rankings that follow changing counts: a top-N as a retract stream.

A first query keeps the counts (a grouped aggregate in update mode) and writes, for
every micro-batch, the counts that changed; a second one, keyed by window,
holds nothing but the window's best ``n`` rows in order and says what each
change does to the ranking.  As counts only grow, a key that neither is among the
best nor changes cannot move into them, so the index stays that small.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rillet.operators.windows import duration_us
from rillet.session import path_exists
from rillet.streaming.lateness import batch_dir, commit, stage
from rillet.streaming.sources import with_event_time


def write_batch_once(out_path: str):
    """foreachBatch function: a batch's rows under its id, whole or not at all."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        if not path_exists(batch.sparkSession, batch_dir(out_path, batch_id)):
            commit(batch.sparkSession, stage(batch, out_path, batch_id), out_path, batch_id)
    return fn


def start_item_count_changes(behavior: DataFrame, out_path: str, checkpoint: str, behavior_value: str = "view",
                             size: str = "1 hour", slide: str = "5 minutes",
                             bound: str = "0 seconds") -> StreamingQuery:
    """(item_id, window_end, cnt): the counts of sliding windows that each micro-batch changed."""
    views = with_event_time(behavior, "ts", bound).where(F.col("behavior") == behavior_value)
    counts = (views.groupBy("item_id", F.window("ts", size, slide).alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
              .select("item_id", F.col("w.end").alias("window_end"), "cnt"))
    return (counts.writeStream.outputMode("update").foreachBatch(write_batch_once(out_path))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


#: Columns of the changes that :func:`start_item_count_changes` writes.
COUNT_CHANGES = "item_id bigint, window_end timestamp, cnt bigint"


class TopNChanges(StatefulProcessor):
    """Keyed by window end: what changed counts do to the window's top ``n``.

    Changes are taken batch by batch and, in a batch, in the order of the key.
    A row whose rank or count changes is retracted (``is_add`` false, its old form)
    and added again (its new form); one that drops out is only retracted.
    ``seq`` counts the changes of a window that have been told.  A timer drops
    the index when the window can no longer change.
    """

    def __init__(self, n: int = 5, key: str = "item_id", count: str = "cnt", key_type: str = "bigint"):
        self.n, self.key, self.count, self.key_type = n, key, count, key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", f"k {self.key_type}, cnt bigint")
        self.told = handle.getValueState("told", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        there = self.told.exists()
        seq = self.told.get()[0] if there else 0
        top = [tuple(r) for r in self.best.get()] if self.best.exists() else []
        df = pd.concat(list(rows)).sort_values(["batch_id", self.key], kind="stable")
        out = []
        for k, c in zip(df[self.key].tolist(), df[self.count].tolist()):
            if len(top) == self.n and (-c, k) > (-top[-1][1], top[-1][0]):
                continue  # below the last, and not one of the best, whose counts are no larger
            after = sorted([(i, m) for i, m in top if i != k] + [(k, c)], key=lambda x: (-x[1], x[0]))[:self.n]
            if after == top:
                continue
            for rn in range(max(len(top), len(after))):
                old, new = top[rn:rn + 1], after[rn:rn + 1]
                if old != new:
                    out += [(seq, False, rn + 1, *r) for r in old] + [(seq, True, rn + 1, *r) for r in new]
            top, seq = after, seq + 1
        self.best.put(top)
        self.told.update((seq,))
        if not there:
            self.handle.registerTimer(int(pd.Timestamp(key[0]).value // 1_000_000))
        done = pd.DataFrame(out, columns=["seq", "is_add", "rn", self.key, self.count])
        done.insert(0, "window_end", key[0])
        yield done

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.best.clear()
        self.told.clear()
        return iter([])

    def close(self) -> None:
        pass


def top_n_changes(changes: DataFrame, n: int = 5, key: str = "item_id", count: str = "cnt", size: str = "1 hour",
                  bound: str = "0 seconds") -> DataFrame:
    """(window_end, seq, is_add, rn, key, count): the retract stream of every window's top
    ``n``, from a stream of changed counts with ``batch_id``
    (:func:`rillet.streaming.lateness.committed`).

    A batch changes windows that end up to ``size`` after its last event and down
    to ``bound`` before it, which is how far the watermark trails the ends.
    """
    kind = changes.schema[key].dataType.simpleString()
    delay = (duration_us(size) + duration_us(bound)) // 1000 + 1
    rows = changes.withColumn("at", F.col("window_end")).withWatermark("at", f"{delay} milliseconds")
    return rows.groupBy("window_end").transformWithStateInPandas(
        statefulProcessor=TopNChanges(n, key, count, kind),
        outputStructType=f"window_end timestamp, seq bigint, is_add boolean, rn int, {key} {kind}, {count} bigint",
        outputMode="Append", timeMode="EventTime")
