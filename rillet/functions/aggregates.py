"""User aggregates with an accumulator: create, add, merge, result.

A :class:`UserAggregate` says what an accumulator is (named, typed columns), how
a batch of rows goes into one, how two become one, and what comes out.
:func:`aggregate_by` runs it in two phases, as Spark runs its own aggregates:
every task folds its rows into one accumulator per key, on Arrow batches, and
sends accumulators only; after one shuffle by key they are merged.  A key with a
third of all rows so costs each task one accumulator, and a task that meets
very many keys sends what it has and starts anew.

Both phases hand over all groups of a batch at once (``fold``, ``combine``,
``results``).  By default these go group by group through the methods above; an
aggregate for tables with very many keys defines them on whole columns.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Accumulators that a task holds at most, about, before it sends them.
HELD = 100_000

# Columnar method: the methods of one group that it stands for.
_ONE_GROUP = {"fold": {"create", "add"}, "combine": {"merge"}, "results": {"result"}}


class UserAggregate(ABC):
    """An aggregate over some columns of a group's rows.

    ``inputs``: names of the columns that :meth:`add` reads; ``state`` and ``returns``:
    columns of the accumulator and of the result, as DDL.  Accumulators are
    tuples in the order of ``state``.  :meth:`merge` must not depend on the order in
    which accumulators meet.

    ``group`` in the columnar methods numbers the rows' groups from 0 to ``count - 1``,
    each of which has a row; a frame of accumulators has the columns of ``state``, and frames that
    come out are read by the place of their columns.  A class that redefines a method of one group alone gets back the columnar form that goes through it.
    """

    inputs: tuple[str, ...]
    state: str
    returns: str

    def __init_subclass__(cls, **kwargs):
        super().__init_subclass__(**kwargs)
        for columnar, single in _ONE_GROUP.items():
            if columnar not in vars(cls) and not single.isdisjoint(vars(cls)):
                setattr(cls, columnar, vars(UserAggregate)[columnar])

    @abstractmethod
    def create(self) -> tuple:
        """The accumulator of no rows."""

    @abstractmethod
    def add(self, acc: tuple, rows: pd.DataFrame) -> tuple:
        """``acc`` with the rows of a batch (columns ``inputs``) added."""

    @abstractmethod
    def merge(self, a: tuple, b: tuple) -> tuple:
        """The accumulator of the rows of both."""

    @abstractmethod
    def result(self, acc: tuple) -> tuple:
        """The columns ``returns`` of an accumulator."""

    def fold(self, rows: pd.DataFrame, group: np.ndarray, count: int) -> pd.DataFrame:
        """The accumulators of all groups of a batch of rows, in the groups' order."""
        return _frame([self.add(self.create(), part) for _, part in rows.groupby(group)])

    def combine(self, accs: pd.DataFrame, group: np.ndarray, count: int) -> pd.DataFrame:
        """The accumulators of each group as one, in the groups' order."""
        out: list = [None] * count
        for g, acc in zip(group.tolist(), _cells(accs)):
            out[g] = acc if out[g] is None else self.merge(out[g], acc)
        return _frame(out)

    def results(self, accs: pd.DataFrame) -> pd.DataFrame:
        """The columns ``returns`` of every accumulator."""
        return _frame([self.result(acc) for acc in _cells(accs)])


def _plain(x):
    """NaN and NaT are null."""
    return None if pd.isna(x) else x


def _names(ddl: str) -> list[str]:
    return StructType.fromDDL(ddl).names


def _cells(df: pd.DataFrame) -> Iterator[tuple]:
    return (tuple(map(_plain, row)) for row in zip(*(df[c].tolist() for c in df.columns)))


def _frame(rows: list[tuple], names=None) -> pd.DataFrame:
    columns = [pd.Series(list(v), dtype=object) for v in zip(*rows)]
    return pd.DataFrame(dict(zip(names or range(len(columns)), columns)))


def _sums(values: np.ndarray, group: np.ndarray, count: int) -> np.ndarray:
    out = np.zeros(count, values.dtype)
    np.add.at(out, group, values)
    return out


def aggregate_by(df: DataFrame, keys: list[str], aggregate: UserAggregate, held: int = HELD) -> DataFrame:
    """``keys`` and the result's columns, a row per group; null keys are a group, and NaN is null.

    The first phase is a ``mapInPandas`` below the shuffle, the second one above
    it, over accumulators that are sorted by key, so both hold little: about ``held``
    accumulators and a batch, and a batch.
    """
    kinds = dict(df.dtypes)
    key_ddl = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    whole = [k for k in keys if kinds[k] in ("tinyint", "smallint", "int", "bigint")]
    inputs, states, returns = list(aggregate.inputs), _names(aggregate.state), _names(aggregate.returns)

    def named(heads: dict, frame: pd.DataFrame, names: list[str]) -> pd.DataFrame:
        columns = (frame.iloc[:, i].array for i in range(frame.shape[1])) if len(frame) else [[]] * len(names)
        return pd.DataFrame({**{k: v.array for k, v in heads.items()}, **dict(zip(names, columns))})

    def by_group(df: pd.DataFrame, columns: list[str], to_accs: Callable) -> tuple[pd.DataFrame, np.ndarray]:
        """A row per key with its accumulator, and the number of that row for each row of ``df``."""
        group = df.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
        at = np.unique(group, return_index=True)[1]
        # whole numbers among nulls come as floats and would turn those of other batches into floats
        heads = {k: df[k].iloc[at].astype("Int64") if k in whole else df[k].iloc[at] for k in keys}
        return named(heads, to_accs(df[columns], group, len(at)), states), group

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []
        limit = held
        for df in frames:
            if len(df):
                parts.append(by_group(df, inputs, aggregate.fold)[0])
            if sum(map(len, parts)) >= limit:
                accs = by_group(pd.concat(parts, ignore_index=True), states, aggregate.combine)[0]
                if len(accs) >= held:
                    yield accs
                    parts, limit = [], held
                else:  # few keys: they stay until as many again have come
                    parts, limit = [accs], len(accs) + held
        if parts:
            yield by_group(pd.concat(parts, ignore_index=True), states, aggregate.combine)[0]

    def output(accs: pd.DataFrame) -> pd.DataFrame:
        return named({k: accs[k] for k in keys}, aggregate.results(accs[states]), returns)

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # the last key may go on in the next frame
        for df in frames:
            if len(df):
                df = df if last is None else pd.concat([last, df], ignore_index=True)
                accs, group = by_group(df, states, aggregate.combine)
                is_last = np.arange(len(accs)) == group[-1]
                last = accs[is_last]
                yield output(accs[~is_last])
        if last is not None:
            yield output(last)

    rows = df.select(*dict.fromkeys([*keys, *inputs]))
    accs = rows.mapInPandas(partial, f"{key_ddl}, {aggregate.state}")
    by_key = accs.repartition(*(F.col(k) for k in keys)).sortWithinPartitions(*keys)
    return by_key.mapInPandas(merged, f"{key_ddl}, {aggregate.returns}")


class Mean(UserAggregate):
    """Mean of the values that are not null; null if there are none."""

    state, returns = "total double, n bigint", "mean double"

    def __init__(self, value: str):
        self.inputs = (value,)

    def create(self) -> tuple:
        return 0.0, 0

    def add(self, acc: tuple, rows: pd.DataFrame) -> tuple:
        values = rows[self.inputs[0]].dropna()
        return acc[0] + float(values.sum()), acc[1] + len(values)

    def merge(self, a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], a[1] + b[1]

    def result(self, acc: tuple) -> tuple:
        return (acc[0] / acc[1] if acc[1] else None,)

    def fold(self, rows: pd.DataFrame, group: np.ndarray, count: int) -> pd.DataFrame:
        values = rows[self.inputs[0]].to_numpy("float64", na_value=np.nan)
        there = ~np.isnan(values)
        return pd.DataFrame({"total": _sums(values[there], group[there], count),
                             "n": _sums(there.astype("int64"), group, count)})

    def combine(self, accs: pd.DataFrame, group: np.ndarray, count: int) -> pd.DataFrame:
        return pd.DataFrame({c: _sums(accs[c].to_numpy(), group, count) for c in accs.columns})

    def results(self, accs: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"mean": accs["total"] / accs["n"].where(accs["n"] > 0)})


class Course(UserAggregate):
    """How a value went: rows, first and last arrival with their values, lowest and
    highest value.  Null values count as rows and take no other part; values without an
    arrival are neither first nor last."""

    # without a first value, both arrivals are 0: null ones would come back as floats
    state = ("n bigint, first_at bigint, first_value double, last_at bigint, last_value double, "
             "lowest double, highest double")
    returns = ("n bigint, first_at bigint, last_at bigint, rise double, spread double")

    _STATE = ("n", "first_at", "first_value", "last_at", "last_value", "lowest", "highest")

    def __init__(self, order: str, value: str):
        self.inputs = (order, value)

    def create(self) -> tuple:
        return 0, 0, None, 0, None, None, None

    def _one(self, *accs: tuple) -> pd.DataFrame:
        return _frame(list(accs), self._STATE).astype(
            {c: float for c in ("first_value", "last_value", "lowest", "highest")})

    def add(self, acc: tuple, rows: pd.DataFrame) -> tuple:
        return self.merge(acc, next(_cells(Course.fold(self, rows, np.zeros(len(rows), "int64"), 1)))) if len(rows) else acc

    def merge(self, a: tuple, b: tuple) -> tuple:
        return next(_cells(Course.combine(self, self._one(a, b), np.zeros(2, "int64"), 1)))

    def result(self, acc: tuple) -> tuple:
        return next(_cells(Course.results(self, self._one(acc))))

    def fold(self, rows: pd.DataFrame, group: np.ndarray, count: int) -> pd.DataFrame:
        order, value = self.inputs
        v = rows[value].to_numpy("float64", na_value=np.nan)
        dated = rows[order].notna().to_numpy() & ~np.isnan(v)
        at, placed = rows[order].where(dated, 0).to_numpy("int64"), np.where(dated, v, np.nan)
        each = (np.ones(len(rows), "int64"), at, placed, at, placed, v, v)
        return self.combine(pd.DataFrame(dict(zip(self._STATE, each))), group, count)

    def combine(self, accs: pd.DataFrame, group: np.ndarray, count: int) -> pd.DataFrame:
        def end(at: str, value: str, place: int) -> tuple[np.ndarray, np.ndarray]:
            """The first (``place`` 0) or last (-1) arrival of each group, and its value."""
            times, values = accs[at].to_numpy("int64"), accs[value].to_numpy("float64")
            there = np.flatnonzero(~np.isnan(values))
            # of equal arrivals the smaller value comes first
            rows = there[np.lexsort((values[there], times[there], group[there]))]
            ends = np.flatnonzero(np.diff(group[rows], prepend=-1) if place == 0 else np.diff(group[rows], append=-1))
            out = np.zeros(count, "int64"), np.full(count, np.nan)
            out[0][group[rows[ends]]], out[1][group[rows[ends]]] = times[rows[ends]], values[rows[ends]]
            return out

        low, high = np.full(count, np.nan), np.full(count, np.nan)
        np.fmin.at(low, group, accs["lowest"].to_numpy("float64"))
        np.fmax.at(high, group, accs["highest"].to_numpy("float64"))
        n = _sums(accs["n"].to_numpy("int64"), group, count)
        columns = (n, *end("first_at", "first_value", 0), *end("last_at", "last_value", -1), low, high)
        return pd.DataFrame(dict(zip(self._STATE, columns)))

    def results(self, accs: pd.DataFrame) -> pd.DataFrame:
        there = accs["first_value"].notna()
        return pd.DataFrame({
            "n": accs["n"], "first_at": accs["first_at"].astype("Int64").where(there),
            "last_at": accs["last_at"].astype("Int64").where(there),
            "rise": accs["last_value"] - accs["first_value"], "spread": accs["highest"] - accs["lowest"]})
