"""Keyed stateful processors for ``transformWithStateInPandas``.

Each processor sorts a key's rows of the micro-batch by arrival (rows of one
key carry no order guarantee inside a batch), combines them with the state
carried from earlier batches, emits one pandas frame, and updates the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


# Offsets that share one bitmap of state.
FIRST_SEEN_BUCKET = 1 << 15


def _frame(rows: Iterator[pd.DataFrame], order: str) -> pd.DataFrame:
    parts = list(rows)
    df = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
    return df.sort_values(order, kind="stable").reset_index(drop=True)


class RunningCount(StatefulProcessor):
    """Count per key, emitted after every increment (value state)."""

    def __init__(self, key: str = "id", order: str = "arr"):
        self.key, self.order = key, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _frame(rows, self.order)
        start = self.count.get()[0] if self.count.exists() else 0
        cnt = start + np.arange(1, len(df) + 1, dtype="int64")
        self.count.update((int(cnt[-1]),))
        yield pd.DataFrame({self.key: df[self.key], self.order: df[self.order], "cnt": cnt})

    def close(self) -> None:
        pass


class TempJumpAlert(StatefulProcessor):
    """Emit (key, arr, last, current) when |current - last| >= threshold."""

    def __init__(self, threshold: float = 10.0, key: str = "id", order: str = "arr",
                 value: str = "temperature"):
        self.threshold, self.key, self.order, self.value = threshold, key, order, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "v double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _frame(rows, self.order)
        vals = df[self.value].to_numpy(dtype="float64")
        prev = np.empty_like(vals)
        prev[1:] = vals[:-1]
        prev[0] = self.last.get()[0] if self.last.exists() else np.nan
        fire = ~np.isnan(prev) & (np.abs(vals - prev) >= self.threshold)
        self.last.update((float(vals[-1]),))
        yield pd.DataFrame({self.key: df[self.key][fire], self.order: df[self.order][fire],
                            "last_value": prev[fire], "cur_value": vals[fire]})

    def close(self) -> None:
        pass


class CountWindowAvg(StatefulProcessor):
    """``countWindow(size, slide)`` mean: list state keeps the last size-1 values."""

    def __init__(self, size: int = 10, slide: int = 2, key: str = "id", order: str = "arr",
                 value: str = "temperature"):
        self.size, self.slide = size, slide
        self.key, self.order, self.value = key, order, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n bigint")
        self.tail = handle.getListState("tail", "v double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _frame(rows, self.order)
        seen = self.seen.get()[0] if self.seen.exists() else 0
        tail = [t[0] for t in self.tail.get()] if self.tail.exists() else []
        vals = np.concatenate([np.asarray(tail, dtype="float64"), df[self.value].to_numpy("float64")])
        offset = len(tail)
        # firings: global sequence numbers n = seen+1 .. seen+len that are multiples of slide
        idx = np.arange(len(df))
        n = seen + idx + 1
        fire = idx[n % self.slide == 0]
        hi = offset + fire + 1
        lo = np.maximum(0, hi - self.size)
        # windows hold at most `size` values: sum them directly (no running-sum cancellation)
        sums = np.array([vals[a:b].sum() for a, b in zip(lo, hi)], dtype="float64")
        out_seq = (seen + fire + 1).astype("int64")
        out_avg = sums / (hi - lo) if len(fire) else np.empty(0, dtype="float64")
        new_seen = seen + len(df)
        keep = vals[-(self.size - 1):] if self.size > 1 else vals[:0]
        self.seen.update((int(new_seen),))
        self.tail.clear()
        if len(keep):
            self.tail.put([(float(v),) for v in keep])
        yield pd.DataFrame({self.key: [key[0]] * len(out_seq), "seq": pd.Series(out_seq, dtype="int64"),
                            "avg_value": pd.Series(out_avg, dtype="float64")})

    def close(self) -> None:
        pass


class RollingMaxBy(StatefulProcessor):
    """``maxBy(value)``: for each row the record of its key's largest value so far;
    the earliest stays on ties, null values never win.

    ``fields`` gives the record's columns and their types.  The state holds each
    in its own type (times as whole microseconds), so a record that waits for a
    later batch comes back digit for digit.
    """

    def __init__(self, fields: dict[str, str], key: str = "id", order: str = "arr", value: str = "temperature"):
        self.fields, self.key, self.order, self.value = dict(fields), key, order, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        kinds = {f: "bigint" if t.startswith("timestamp") else t for f, t in self.fields.items()}
        self.best = handle.getValueState("best", ", ".join(["_v double", *(f"{f} {t}" for f, t in kinds.items())]))

    def _stored(self, row: dict) -> tuple:
        out = []
        for f, t in self.fields.items():
            x = row[f]
            if pd.isna(x):
                out.append(None)
            elif t.startswith("timestamp"):
                out.append(pd.Timestamp(x).value // 1000)
            else:
                out.append(x.item() if hasattr(x, "item") else x)
        return tuple(out)

    def _record(self, stored: tuple) -> list:
        return [pd.Timestamp(x, unit="us") if t.startswith("timestamp") and x is not None else x
                for t, x in zip(self.fields.values(), stored)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _frame(rows, self.order)
        names = list(self.fields)
        v, *stored = self.best.get() if self.best.exists() else (None,)
        vals = df[self.value].to_numpy("float64")
        vals = np.where(np.isnan(vals), -np.inf, vals)
        before = -np.inf if v is None else v
        top = np.maximum(np.maximum.accumulate(vals), before)
        # A row takes over where it exceeds all before it.
        takes = vals > np.concatenate(([before], top[:-1]))
        holder = np.maximum.accumulate(np.where(takes, np.arange(len(vals)), -1))
        # Column by column, as objects: no value is converted on the way.
        old = self._record(stored) if v is not None else [None] * len(names)
        out = pd.DataFrame({self.key: df[self.key], self.order: df[self.order]})
        for f, o in zip(names, old):
            pool = np.empty(len(df) + 1, dtype=object)
            pool[:-1] = [None if pd.isna(x) else x for x in df[f].tolist()]
            pool[-1] = o
            out[f"max_{f}"] = pool[holder]  # -1: the record that was there
        if holder[-1] >= 0:
            self.best.update((float(top[-1]), *self._stored(df.iloc[holder[-1]][names].to_dict())))
        yield out

    def close(self) -> None:
        pass


class RollingReduce(StatefulProcessor):
    """``reduce((cur, new) -> (id, new.ts, max(cur.v, new.v)))`` per row."""

    def __init__(self, key: str = "id", order: str = "arr", ts: str = "ts_sec", value: str = "temperature"):
        self.key, self.order, self.ts, self.value = key, order, ts, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.most = handle.getValueState("most", "v double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _frame(rows, self.order)
        before = self.most.get()[0] if self.most.exists() else np.nan
        vals = df[self.value].to_numpy("float64")
        top = np.fmax.accumulate(np.concatenate(([before], vals)))[1:]
        if not np.isnan(top[-1]):
            self.most.update((float(top[-1]),))
        yield pd.DataFrame({self.key: df[self.key], self.order: df[self.order], self.ts: df[self.ts],
                            f"max_{self.value}": top})

    def close(self) -> None:
        pass


class RetractChangelog(StatefulProcessor):
    """Grouped count/avg as a retract stream: (false, old) then (true, new).

    The mean is over non-null values, null before a key's first."""

    def __init__(self, key: str = "id", order: str = "arr", value: str = "temperature"):
        self.key, self.order, self.value = key, order, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "n bigint, m bigint, s double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _frame(rows, self.order)
        n0, m0, s0 = self.acc.get() if self.acc.exists() else (0, 0, 0.0)
        vals = df[self.value].to_numpy("float64")
        there = ~np.isnan(vals)
        rows_seen = n0 + np.arange(len(vals) + 1, dtype="int64")  # before each row, and after the last
        m = m0 + np.concatenate(([0], np.cumsum(there)))
        total = s0 + np.concatenate(([0.0], np.cumsum(np.where(there, vals, 0.0))))
        avg = np.where(m > 0, total / np.maximum(m, 1), np.nan)
        cnt = np.zeros_like(rows_seen) if key[0] is None else rows_seen  # count(key)
        arr = df[self.order].to_numpy("int64")
        adds = pd.DataFrame({"is_add": True, self.key: key[0], self.order: arr, "cnt": cnt[1:], "avg_value": avg[1:]})
        keep = rows_seen[:-1] > 0
        rets = pd.DataFrame({"is_add": False, self.key: key[0], self.order: arr[keep], "cnt": cnt[:-1][keep],
                             "avg_value": avg[:-1][keep]})
        self.acc.update((int(rows_seen[-1]), int(m[-1]), float(total[-1])))
        out = pd.concat([rets, adds], ignore_index=True)
        out["avg_value"] = out["avg_value"].astype(object).where(out["avg_value"].notna(), None)
        yield out

    def close(self) -> None:
        pass


OUTPUTS = {
    RunningCount: "id string, arr bigint, cnt bigint",
    TempJumpAlert: "id string, arr bigint, last_value double, cur_value double",
    CountWindowAvg: "id string, seq bigint, avg_value double",
    RollingReduce: "id string, arr bigint, ts_sec bigint, max_temperature double",
    RetractChangelog: "is_add boolean, id string, arr bigint, cnt bigint, avg_value double",
}


def apply_processor(stream: DataFrame, processor: StatefulProcessor, key: str = "id",
                    output_schema: str | None = None) -> DataFrame:
    """``groupBy(key).transformWithStateInPandas(processor)`` in append mode.

    Time mode ``None``: rows are handled as they arrive, late or not, like
    the per-record keyed functions they replace.
    """
    schema = output_schema or OUTPUTS[type(processor)]
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="None")


def _ms(ts) -> int:
    return int(pd.Timestamp(ts).value // 1_000_000)


class TopNOnTimer(StatefulProcessor):
    """Top-N per window end, fired by an event-time timer.

    Keyed by window end: of the windowed counts that arrive only the best ``n``
    so far are kept (list state of n rows, however many keys a window has) and
    a timer is set at the window end; when the watermark passes it, they are
    emitted in order (count desc, key asc) and the state is cleared.  Runs with
    time mode ``EventTime`` after an append-mode windowed aggregate, which
    gives each key's count once, whose ``window_time`` column carries the
    watermark.
    """

    def __init__(self, n: int = 5, key: str = "item_id", count: str = "cnt", key_type: str = "bigint"):
        self.n, self.key, self.count, self.key_type = n, key, count, key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getListState("items", f"{self.key} {self.key_type}, {self.count} bigint")

    def _best(self, df: pd.DataFrame) -> pd.DataFrame:
        return df.sort_values([self.count, self.key], ascending=[False, True]).head(self.n)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame(list(self.items.get()) if self.items.exists() else [], columns=[self.key, self.count])
        for df in rows:
            best = self._best(pd.concat([best, df[[self.key, self.count]]]) if len(best) else df)
        self.items.put([(k, int(c)) for k, c in zip(best[self.key].tolist(), best[self.count])])
        self.handle.registerTimer(_ms(key[0]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        top = self._best(pd.DataFrame(list(self.items.get()), columns=[self.key, self.count]))
        self.items.clear()
        yield pd.DataFrame({self.key: top[self.key].to_numpy(), "window_end": key[0],
                            self.count: top[self.count].astype("int64").to_numpy(),
                            "rn": np.arange(1, len(top) + 1, dtype="int32")})

    def close(self) -> None:
        pass


class FirstSeenOffsets(StatefulProcessor):
    """Keyed by (window, bucket of offsets): emit a row the first time an offset is
    seen.  A bucket's state is one bitmap of 64-bit words, so a busy window is
    many keys' work, and a batch is one vectorised step; a timer drops the
    state once the watermark passes the window end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bits = handle.getValueState("bits", "bits binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(self.bits.get()[0], dtype=np.uint8).copy() if self.bits.exists() else np.zeros(
            FIRST_SEEN_BUCKET // 8, dtype=np.uint8)
        df = _frame(rows, "arr").drop_duplicates("offset", keep="first")
        place = (df["offset"] % FIRST_SEEN_BUCKET).to_numpy()
        fresh = (bits[place >> 3] >> (place & 7) & 1) == 0
        np.bitwise_or.at(bits, place[fresh] >> 3, (1 << (place[fresh] & 7)).astype(np.uint8))
        self.bits.update((bits.tobytes(),))
        self.handle.registerTimer(_ms(key[0]))
        new = df[fresh]
        yield pd.DataFrame({"window_end": key[0], "arr": new["arr"].astype("int64").to_numpy(),
                            "offset": new["offset"].astype("int64").to_numpy()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.bits.clear()
        return iter([])

    def close(self) -> None:
        pass


