"""Two streams in one keyed operator: the rows of either side change what the other's give."""

from __future__ import annotations

from abc import abstractmethod
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Column that says which stream a row is from (state frames lose names that begin with ``_``).
SIDE = "side_of_stream"


class CoProcessor(StatefulProcessor):
    """A keyed operator over two streams.  A key's rows of a micro-batch come to :meth:`rows`
    in the order of ``order``, at equal places the second stream's first."""

    def __init__(self, order: str):
        self.order = order

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = pd.concat(list(rows), ignore_index=True)
        df = df.sort_values([self.order, SIDE], ascending=[True, False], kind="stable", ignore_index=True)
        yield self.rows(key, df, (df[SIDE] == 1).to_numpy())

    @abstractmethod
    def rows(self, key, df: pd.DataFrame, second: np.ndarray) -> pd.DataFrame:
        """Output for some rows; ``second`` marks those of the second stream."""

    def close(self) -> None:
        pass


def co_process(first: DataFrame, second: DataFrame, key: str, processor: CoProcessor, output_schema: str) -> DataFrame:
    """Both streams, keyed by ``key``, in one operator with one state.

    Rows are tagged with their side and share one shuffle; a column that only one
    side has is null on the other.
    """
    both = first.withColumn(SIDE, F.lit(0)).unionByName(second.withColumn(SIDE, F.lit(1)), allowMissingColumns=True)
    return both.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output_schema, outputMode="Append", timeMode="None")


class LimitGate(CoProcessor):
    """The second stream sets a key's limit; rows of the first pass, with the limit in
    force, where their value reaches it.  Before a key has a limit nothing passes; a
    null limit closes the gate again, and null values never pass."""

    def __init__(self, key: str = "id", order: str = "arr", value: str = "temperature", limit: str = "limit"):
        super().__init__(order)
        self.key, self.value, self.limit = key, value, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "v double")

    def rows(self, key, df: pd.DataFrame, second: np.ndarray) -> pd.DataFrame:
        before = self.last.get()[0] if self.last.exists() else None
        limits = np.concatenate(([np.nan if before is None else before], df[self.limit].to_numpy("float64")))
        at = np.maximum.accumulate(np.where(second, np.arange(1, len(df) + 1), 0))  # 0: the one handed on
        force = limits[at]
        if second.any():
            self.last.update((None if np.isnan(force[-1]) else float(force[-1]),))
        value = df[self.value].to_numpy("float64")
        passes = ~second & (value >= force)  # false where either is null
        return pd.DataFrame({self.key: key[0], self.order: df[self.order][passes], self.value: value[passes],
                             self.limit: force[passes]})
