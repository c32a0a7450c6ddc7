"""Allowed lateness on streams: rows tagged once, windows fired and refired by timers.

An engine that sees one row after the other knows the watermark at each of them;
a micro-batch engine knows one per batch, and drops what is behind it.  So the
work is cut in two:

* :func:`tag_batch` gives every row the watermark that it meets (the largest
  event time of all earlier arrivals, those of earlier batches included, less the
  bound) and says whether its window takes it on time, takes it late, or is
  past.  All rows are written in one pass, a folder for each answer, and a batch's
  folder appears in one step, so that a replayed batch is neither seen twice nor
  in part: the late rows are the side output.
* the rows that windows take are read as a stream again.  Its event time is the
  clock, the largest event time so far, which never goes back: nothing is dropped,
  and the engine's own watermark and timers follow the same clock.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructType, TimestampType

from rillet.operators.late import (LATE, ON_TIME, arrival_chunk, last_window_end, running_watermark, status_of,
                                   window_takings)
from rillet.operators.windows import duration_us
from rillet.session import delete_path, list_subdirs, path_exists, rename_path

#: Columns that tagging adds.
STATUS, END, WATERMARK, CLOCK = "status", "end_us", "wm_us", "clock"


def batch_dir(root: str, batch_id: int) -> str:
    return os.path.join(root, f"batch_id={batch_id}")


def stage(df: DataFrame, root: str, batch_id: int, *by: str) -> str:
    """Write a batch's rows, split by the columns ``by``, beside where they shall be; what a
    killed attempt left behind goes first."""
    spark = df.sparkSession
    for d in list_subdirs(spark, root):
        if d.startswith(f"_staging-{batch_id}-"):
            delete_path(spark, os.path.join(root, d))
    path = os.path.join(root, f"_staging-{batch_id}-{uuid.uuid4().hex[:8]}")
    df.write.partitionBy(*by).parquet(path)
    return path


def commit(spark: SparkSession, staged: str, root: str, batch_id: int) -> None:
    """Let a staged batch appear, in one step; one that is there already stays, as a replay
    has the same rows."""
    if path_exists(spark, batch_dir(root, batch_id)):
        delete_path(spark, staged)
    else:
        rename_path(spark, staged, batch_dir(root, batch_id))


def _carried(spark: SparkSession, state_path: str, batch_id: int) -> tuple[int | None, list[int]]:
    """The largest event time (microseconds) before a batch, and the batches that stored one."""
    stored = sorted((int(d.split("=")[1]) for d in list_subdirs(spark, state_path) if d.startswith("batch_id=")),
                    reverse=True)
    stored = [b for b in stored if b < batch_id]
    row = spark.read.parquet(batch_dir(state_path, stored[0])).first() if stored else None
    return (None if row is None else row.max_us), stored


def tag_batch(ts: str, arrival: list[str], size: str, bound: str, lateness: str, out_path: str, state_path: str,
              slide: str | None = None, derive: Callable[[DataFrame], DataFrame] | None = None,
              derived_path: str | None = None) -> Callable:
    """foreachBatch function: one pass that tags every row and splits the batch by tag.

    Written columns: the batch's own, ``end_us`` (end of the last window that
    holds the row), ``wm_us`` (the watermark that it meets), ``clock`` (largest event
    time so far) and ``status``, which is also the folder: ``on_time``,
    ``late_accepted`` or ``late``.  The tags equal those of
    :func:`rillet.operators.late.classify_lateness` over all arrivals at once, as the
    rows of a batch are scanned in the order of ``arrival`` and the largest event
    time is handed on from batch to batch (one stored row each; those that no
    replay needs are removed).  ``derive`` makes a further table of the written rows
    that are not late (counts, say), which appears at ``derived_path`` under the same
    batch id.  Nothing of a batch appears before its state is stored, and a batch
    that is there already is left alone.
    """
    bound_us, late_us = duration_us(bound), duration_us(lateness)

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if path_exists(spark, batch_dir(out_path, batch_id)):
            return
        before, stored = _carried(spark, state_path, batch_id)
        # a batch is as large as its trigger lets it be: fixed chunks, and it is read once
        d = running_watermark(batch, ts, arrival, "0 seconds", arrival_chunk(batch, arrival[0]), name="_before")
        us = F.unix_micros(F.col(ts).cast("timestamp"))
        # greatest() passes over nulls
        d = d.withColumn("_before", F.greatest("_before", F.lit(before).cast("bigint")))
        d = d.withColumns({WATERMARK: F.col("_before") - bound_us, END: last_window_end(ts, size, slide),
                           CLOCK: F.timestamp_micros(F.coalesce(F.greatest("_before", us), F.lit(0)))})
        d = d.withColumn(STATUS, status_of(F.col(END), F.col(WATERMARK), late_us)).drop("_before")
        seen = Observation()  # the new largest event time, from the pass that writes
        staged = stage(d.observe(seen, F.max(us).alias("most")), out_path, batch_id, STATUS)
        most = max((v for v in (before, seen.get["most"]) if v is not None), default=None)
        if most is not None:
            (spark.createDataFrame([(most,)], "max_us bigint").write.mode("overwrite")
             .parquet(batch_dir(state_path, batch_id)))
        if derive is not None:
            rows = spark.read.schema(d.schema).parquet(staged)
            commit(spark, stage(derive(rows.where(F.col(STATUS) != LATE)), derived_path, batch_id), derived_path,
                   batch_id)
        commit(spark, staged, out_path, batch_id)
        for old in stored[1:]:
            delete_path(spark, batch_dir(state_path, old))
    return fn


def committed(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """The committed batches under ``root`` as a stream, with ``batch_id``.

    A micro-batch takes all batches that are there, each whole: their rows are
    then in the order that the operators below rely on.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
    return spark.readStream.schema(fields.add("batch_id", LongType())).parquet(root)


def tagged_schema(rows: StructType) -> StructType:
    """Columns of the tagged rows of :func:`tag_batch`."""
    return (StructType(list(rows.fields)).add(WATERMARK, LongType()).add(END, LongType()).add(CLOCK, TimestampType())
            .add(STATUS, StringType()))


def _by_clock(stream: DataFrame, bound: str) -> DataFrame:
    # One more millisecond, as a row that equals the watermark counts as behind it.
    return stream.withWatermark(CLOCK, f"{duration_us(bound) // 1000 + 1} milliseconds")


def _end_ms(end_us: int) -> int:
    return -(-end_us // 1000)


class MinByFirings(StatefulProcessor):
    """Keyed by (key, window end): ``minBy(value)`` with allowed lateness.

    A timer at the window end fires the window with all its on-time rows
    (``fire_seq`` 0); a row that is taken late refires it at once, and fires it first
    if the timer has not come to it; a timer at the end of the lateness drops the
    state.  On-time rows are only summed up, frame by frame, in no order; the late
    ones are put in the order of arrival.  A null value is the least, as in batch.
    """

    def __init__(self, lateness: str, key: str = "id", arrival: tuple = ("arrival_us", "arr"),
                 value: str = "temperature"):
        self.late_ms = -(-duration_us(lateness) // 1000)
        self.key, self.arrival, self.value = key, list(arrival), value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.acc = handle.getValueState("acc", "n bigint, n_on bigint, fired boolean, v double, a bigint")

    @staticmethod
    def _less(v: float | None, a: int, than: tuple) -> bool:
        """Whether (v, a) comes before the least record so far (null first)."""
        w, b = than
        if b is None:
            return True
        if v is None or w is None:
            return (v is not None, a) < (w is not None, b) if v is not w else a < b
        return (v, a) < (w, b)

    def _least(self, df: pd.DataFrame) -> tuple[float | None, int]:
        df = df[[self.value, self.arrival[-1]]].sort_values(list((self.value, self.arrival[-1])), na_position="first")
        v, a = df.iloc[0]
        return None if pd.isna(v) else float(v), int(a)

    def _firing(self, key, seq: int, n: int, least: tuple) -> tuple:
        return key[0], pd.Timestamp(key[1], unit="us"), seq, n, *least

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[self.key, "window_end", "fire_seq", "cnt", "min_value", "min_arr"])
        return out.astype({"min_value": "float64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        there = self.acc.exists()
        n, n_on, fired, v, a = self.acc.get() if there else (0, 0, False, None, None)
        least, late = (v, a), []
        for df in rows:
            on_time = df[df[STATUS] == ON_TIME]
            late.append(df[df[STATUS] != ON_TIME])
            if len(on_time):
                n, n_on = n + len(on_time), n_on + len(on_time)
                found = self._least(on_time)
                least = found if self._less(*found, least) else least
        late = pd.concat(late).sort_values(self.arrival)
        out = []
        if len(late) and not fired and n_on:
            out.append(self._firing(key, 0, n_on, least))
        for v, a in zip(late[self.value].tolist(), late[self.arrival[-1]].tolist()):
            n, fired = n + 1, True
            v = None if pd.isna(v) else v
            least = (v, a) if self._less(v, a, least) else least
            out.append(self._firing(key, n - n_on - (n_on == 0), n, least))
        self.acc.update((n, n_on, fired, *least))
        if not there:
            self.handle.registerTimer(_end_ms(key[1]))
            if self.late_ms:
                self.handle.registerTimer(_end_ms(key[1]) + self.late_ms)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        if self.acc.exists():
            n, n_on, fired, *least = self.acc.get()
            if not fired and n_on:
                out.append(self._firing(key, 0, n, tuple(least)))
                self.acc.update((n, n_on, True, *least))
            if expiredTimerInfo.getExpiryTimeInMs() >= _end_ms(key[1]) + self.late_ms:
                self.acc.clear()
        yield self._frame(out)

    def close(self) -> None:
        pass


def min_by_firings(kept: DataFrame, bound: str, lateness: str, key: str = "id",
                   arrival: tuple = ("arrival_us", "arr"), value: str = "temperature") -> DataFrame:
    """Every firing of the tumbling ``minBy(value)`` window over the tagged rows of
    :func:`tag_batch`: the rows of :func:`rillet.operators.late.lateness_firings_min_by`."""
    rows = _by_clock(kept.where(F.col(STATUS) != LATE), bound)
    kind = kept.schema[key].dataType.simpleString()
    return rows.groupBy(key, END).transformWithStateInPandas(
        statefulProcessor=MinByFirings(lateness, key, arrival, value),
        outputStructType=f"{key} {kind}, window_end timestamp, fire_seq bigint, cnt bigint, min_value double, "
                         "min_arr bigint", outputMode="Append", timeMode="EventTime")


class RefiredTopN(StatefulProcessor):
    """Keyed by window end: the best ``n`` keys of a window that fires and refires.

    A map by key holds the window's counts, so that a later count replaces the one
    before; the best ``n`` are kept beside it, and as counts only grow, only keys
    whose count changes can move into them: nothing is looked through.  A timer at
    the window end emits the ranking of the on-time rows; counts that are taken late
    emit it anew; a timer at the end of the lateness drops the state.
    """

    def __init__(self, lateness: str, n: int, key: str, key_type: str = "string"):
        self.late_ms = -(-duration_us(lateness) // 1000)
        self.n, self.key, self.key_type = n, key, key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", f"k {self.key_type}", "cnt bigint")
        self.best = handle.getListState("best", f"k {self.key_type}, cnt bigint")
        self.firings = handle.getValueState("firings", "n int")

    def _add(self, best: list[tuple], more: pd.Series) -> list[tuple]:
        top = dict(best)
        for k, n in more.items():
            old = self.counts.getValue((k,))
            top[k] = int(n) + (old[0] if old else 0)
            self.counts.updateValue((k,), (top[k],))
        return sorted(top.items(), key=lambda x: (-x[1], x[0]))[:self.n]

    def _ranking(self, key, seq: int, best: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({"window_end": pd.Timestamp(key[0], unit="us"), "firing": seq,
                             self.key: [k for k, _ in best], "cnt": [c for _, c in best],
                             "rn": range(1, len(best) + 1)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        there = self.firings.exists()
        fired = self.firings.get()[0] if there else 0
        best = list(self.best.get()) if self.best.exists() else []
        df = pd.concat(list(rows)).groupby(self.key)[["n_on", "n_late"]].sum()
        best = self._add(best, df["n_on"][df["n_on"] > 0])
        late = df["n_late"][df["n_late"] > 0]
        if len(late):
            if not fired and best:
                yield self._ranking(key, 0, best)
                fired = 1
            best = self._add(best, late)
            yield self._ranking(key, fired, best)
            fired += 1
        self.best.put(best)
        self.firings.update((fired,))
        if not there:
            self.handle.registerTimer(_end_ms(key[0]))
            if self.late_ms:
                self.handle.registerTimer(_end_ms(key[0]) + self.late_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.firings.exists():
            if not self.firings.get()[0]:
                yield self._ranking(key, 0, list(self.best.get()))
                self.firings.update((1,))
            if expiredTimerInfo.getExpiryTimeInMs() >= _end_ms(key[0]) + self.late_ms:
                self.counts.clear()
                self.best.clear()
                self.firings.clear()

    def close(self) -> None:
        pass


def refired_top_n(counts: DataFrame, bound: str, lateness: str, n: int, key: str) -> DataFrame:
    """(window_end, firing, key, cnt, rn): the ranking of each window at each of its
    firings, from a stream of :func:`rillet.operators.late.window_takings` with ``clock``.
    Firing 0 ranks the on-time rows, the last one all that the window took."""
    kind = counts.schema[key].dataType.simpleString()
    rows = _by_clock(counts, bound)
    return rows.groupBy(END).transformWithStateInPandas(
        statefulProcessor=RefiredTopN(lateness, n, key, kind),
        outputStructType=f"window_end timestamp, firing int, {key} {kind}, cnt bigint, rn int",
        outputMode="Append", timeMode="EventTime")


def start_tagging(rows: DataFrame, out_path: str, checkpoint: str, ts: str, arrival: list[str], size: str, bound: str,
                  lateness: str, **more) -> StreamingQuery:
    """Run :func:`tag_batch` over a stream until its input is used up."""
    fn = tag_batch(ts, arrival, size, bound, lateness, out_path, checkpoint + "/state", **more)
    return (rows.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint + "/query")
            .trigger(availableNow=True).start())


def start_page_takings(log: DataFrame, rows_path: str, counts_path: str, checkpoint: str, size: str, slide: str,
                       bound: str, lateness: str, arrival: list[str]) -> StreamingQuery:
    """The first half of the hot-pages job: static assets dropped, rows tagged once (the
    folder ``status=late`` is the side output), and per url and window the rows
    taken on time and late, which :func:`refired_top_n` reads."""
    from rillet.operators.routing import filter_static_assets

    pages = filter_static_assets(log, "url").where(F.col("url").isNotNull())

    def takings(kept: DataFrame) -> DataFrame:
        clock = kept.agg(F.max(F.unix_micros(CLOCK))).first()[0]  # the batch's: no later row is behind it
        return window_takings(kept, "url", "ts", size, slide, lateness).withColumn(
            CLOCK, F.timestamp_micros(F.lit(clock).cast("bigint")))

    return start_tagging(pages, rows_path, checkpoint, "ts", arrival, size, bound, lateness, slide=slide,
                         derive=takings, derived_path=counts_path)


#: Columns of the counts that :func:`start_page_takings` writes.
TAKINGS = f"url string, {END} bigint, n_on bigint, n_late bigint, {CLOCK} timestamp"
