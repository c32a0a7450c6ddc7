"""Windows with triggers: when a window tells what it holds, and whether it then forgets it.

A window is a key's rows of one span of event time, an aggregate
(:class:`rillet.functions.aggregates.UserAggregate`) says what it holds, and a
:class:`Trigger` when it fires.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from rillet.functions.aggregates import UserAggregate
from rillet.operators.windows import duration_us


@dataclass(frozen=True)
class Trigger:
    """``every``: fire at every so many rows; ``purge``: forget the rows that a firing told;
    ``at_end``: fire once more when the watermark passes the window's end, if there are
    rows that no firing told."""

    every: int | None = None
    purge: bool = False
    at_end: bool = True


#: Fire at each row and forget it.
FIRE_AND_PURGE = Trigger(every=1, purge=True, at_end=False)
#: Fire when the window is over.
AT_END = Trigger()


class TriggeredWindow(StatefulProcessor):
    """Keyed by (key, window end): an aggregate's accumulator, its rows and a timer at the end."""

    def __init__(self, aggregate: UserAggregate, trigger: Trigger, key: str, order: str):
        self.aggregate, self.trigger, self.key, self.order = aggregate, trigger, key, order
        self.columns = ["firing", *StructType.fromDDL(aggregate.returns).names]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", "_rows bigint, _untold bigint, _firings bigint, "
                                          + self.aggregate.state)

    def _out(self, key, firings: list[tuple]) -> pd.DataFrame:
        columns = zip(*firings) if firings else [()] * len(self.columns)
        out = pd.DataFrame({c: pd.Series(list(v), dtype=object) for c, v in zip(self.columns, columns)})
        out.insert(0, "window_end", pd.Series([key[1]] * len(out), dtype="datetime64[us]"))
        out.insert(0, self.key, pd.Series([key[0]] * len(out), dtype=object))
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        there = self.state.exists()
        n, untold, firing, *acc = self.state.get() if there else (0, 0, 0, *self.aggregate.create())
        df = pd.concat(list(rows)).sort_values(self.order, kind="stable")[list(self.aggregate.inputs)]
        every = self.trigger.every
        cuts = [i + 1 for i in range(len(df)) if every and (n + i + 1) % every == 0]
        out, begin, acc = [], 0, tuple(acc)
        for cut in [*cuts, len(df)]:
            if cut > begin:
                acc = self.aggregate.add(acc, df.iloc[begin:cut])
            untold += cut - begin
            if every and untold and (n + cut) % every == 0:
                out.append((firing, *self.aggregate.result(acc)))
                firing, untold = firing + 1, 0
                acc = self.aggregate.create() if self.trigger.purge else acc
            begin = cut
        self.state.update((n + len(df), untold, firing, *acc))
        if not there:
            self.handle.registerTimer(int(pd.Timestamp(key[1]).value // 1_000_000))
        yield self._out(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        if self.state.exists():
            _, untold, firing, *acc = self.state.get()
            if self.trigger.at_end and untold:
                out.append((firing, *self.aggregate.result(tuple(acc))))
            self.state.clear()
        yield self._out(key, out)

    def close(self) -> None:
        pass


def triggered_windows(rows: DataFrame, key: str, ts: str, order: str, size: str, bound: str, aggregate: UserAggregate,
                      trigger: Trigger = AT_END) -> DataFrame:
    """(key, window_end, firing, the aggregate's columns): what tumbling windows tell, each
    firing numbered from 0.

    A window takes rows until the watermark (largest event time less ``bound``) has
    passed its end for sure; rows of a batch are taken in the order of ``order``.
    The engine's watermark is that of the window ends, so that a row behind it in
    time whose window is still open is not dropped.
    """
    kind = rows.schema[key].dataType.simpleString()
    delay = (duration_us(size) + duration_us(bound)) // 1000 + 1
    placed = rows.withColumn("window_end", F.window(F.col(ts).cast("timestamp"), size).end)
    placed = placed.select(key, order, *[c for c in aggregate.inputs if c not in (key, order)], "window_end",
                           F.col("window_end").alias("_at")).withWatermark("_at", f"{delay} milliseconds")
    return placed.groupBy(key, "window_end").transformWithStateInPandas(
        statefulProcessor=TriggeredWindow(aggregate, trigger, key, order),
        outputStructType=f"{key} {kind}, window_end timestamp, firing bigint, {aggregate.returns}",
        outputMode="Append", timeMode="EventTime")
