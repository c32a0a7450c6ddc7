"""User-function surfaces: table function, aggregate function.

The native forms are the ones the jobs use; they stay in the JVM and
aggregate partially before any shuffle.  The Python UDTF is offered only as
SQL-level compatibility (``LATERAL split_udtf(id)``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.text import java_split


def split_pieces(df: DataFrame, c: str, sep: str = "_", word: str = "word",
                 length: str = "length") -> DataFrame:
    """Table function ``split(c)`` joined laterally: one row per piece with its length."""
    return (df.select("*", F.explode(java_split(c, sep)).alias(word))
              .withColumn(length, F.length(word)))


def avg_temp(c) -> Column:
    """Aggregate (sum, count) -> mean; partial-aggregates like the built-in avg."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast("double") / F.count(c)


def register_avg_temp(spark: SparkSession) -> None:
    """Register ``avg_temp(values)`` for SQL: the mean of a collected group, as a
    Python grouped-aggregate function.  It sees a whole group at once, so it is
    for groups of moderate size; SQL over large groups uses :func:`avg_temp_sql`."""
    @F.pandas_udf("double")
    def avg_temp_udaf(v: pd.Series) -> float:
        return float(v.mean())

    spark.udf.register("avg_temp", avg_temp_udaf)


def avg_temp_sql(expr: str) -> str:
    """The native aggregate as SQL text; partial-aggregates before the shuffle."""
    return f"(CAST(sum({expr}) AS DOUBLE) / count({expr}))"


def register_split_udtf(spark: SparkSession, sep: str = "_") -> None:
    """Register a Python UDTF ``split_udtf`` for ``LATERAL`` use in SQL."""
    import re

    from pyspark.sql.functions import udtf

    pattern = re.compile(sep)

    @udtf(returnType="word: string, length: int")
    class SplitUdtf:
        def eval(self, s: str):
            if s is None:
                return
            parts = pattern.split(s)
            if s != "":
                while parts and parts[-1] == "":
                    parts.pop()
            for p in parts:
                yield p, len(p)

    spark.udtf.register("split_udtf", SplitUdtf)
