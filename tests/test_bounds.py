"""Crowded chunks are cut at sampled quantiles and change no result."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillet.operators import bounds, late
from rillet.operators.bounds import even_chunks
from rillet.operators.scan import chunk_by, keyed_scan
from rillet.operators.windows import session, session_builtin

CELL = 10_000_000
ROWS = 4000


def burst(spark, n=120_000):
    """Nine of ten rows arrive within one second, a tenth of those in one microsecond; some have no time."""
    i = F.col("id")
    hashed = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    us = (F.when(i % 1000 == 7, None).when(i % 10 == 0, i * 30_000)
          .when(i % 10 == 1, 500_000_000).otherwise(500_000_000 + hashed))
    return spark.range(n).select(
        i.alias("arr"), us.cast("bigint").alias("arrival_us"), (i % 5).alias("other"),
        F.when(i % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (i % 50).cast("string"))).alias("key"),
        F.timestamp_micros(F.coalesce(us, i) - F.pmod(i * 7919, F.lit(40_000_000))).alias("ts"),
        ((i * 37) % 101).cast("double").alias("v"))


def _rows(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def _sizes(df):
    return [r[0] for r in df.groupBy("_even").count().select("count").collect()]


def test_a_burst_is_many_chunks_of_like_size(spark):
    df = burst(spark)
    got = even_chunks(df, chunk_by("arrival_us", CELL), ["arrival_us", "arr"], rows=ROWS)
    assert got.columns == [*df.columns, "_even"] and got.count() == df.count()
    fixed = df.groupBy(chunk_by("arrival_us", CELL)).count().agg(F.max("count")).first()[0]
    assert fixed > 0.8 * 120_000
    assert max(_sizes(got)) < 2.5 * ROWS
    # chunks never fall along the order, ties and missing times included
    w = Window.orderBy("arrival_us", "arr")
    fall = got.select((F.lag("_even").over(w) > F.col("_even")).alias("f")).where("f")
    assert fall.isEmpty()


def test_a_hot_key_is_cut_by_its_own_quantiles(spark):
    df = burst(spark)
    got = even_chunks(df, F.lit(0), ["arrival_us", "arr"], ["key"], rows=ROWS)
    assert got.groupBy("key", "_even").count().agg(F.max("count")).first()[0] < 2.5 * ROWS
    assert got.where("key <> 'hot'").groupBy("key").agg(F.countDistinct("_even").alias("n")).where("n > 1").isEmpty()
    run = keyed_scan(got, ["key"], ["arrival_us", "arr"], F.col("_even"), running={"n": ("count", F.lit(1))},
                     lags={"p": F.col("v")})
    w = Window.partitionBy("key").orderBy("arrival_us", "arr")
    plain = df.select("arr", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("p"))
    assert _rows(run, ["arr", "n", "p"]) == _rows(plain, ["arr", "n", "p"])


def test_equal_rows_stay_together_and_small_tables_stay_whole(spark):
    df = burst(spark).withColumn("one", F.lit(1).cast("bigint"))
    got = even_chunks(df, F.lit(0), ["one"], rows=ROWS)
    assert got.select("_even").distinct().count() == 1
    few = even_chunks(df.limit(100), chunk_by("arrival_us", CELL), ["arrival_us"], rows=ROWS)
    assert few.count() == 100
    none = even_chunks(df.limit(0), chunk_by("arrival_us", CELL), ["arrival_us"], rows=ROWS)
    assert none.count() == 0
    # texts have no bounded size, so they are no bounds
    by_text = even_chunks(df, F.lit(0), ["key", "arr"], rows=ROWS)
    assert by_text.select("_even").distinct().count() == 1


@pytest.fixture()
def small_chunks(monkeypatch):
    monkeypatch.setattr(bounds, "CHUNK_ROWS", ROWS)


def test_watermarks_of_a_burst(spark, small_chunks):
    df = burst(spark)
    got = late.running_watermark(df, "ts", ["arrival_us", "arr"], "2 seconds")
    plain = late.running_watermark(df, "ts", ["arrival_us", "arr"], "2 seconds", chunk=F.lit(0))
    assert got.columns == plain.columns
    assert _rows(got, ["arr", "wm_us"]) == _rows(plain, ["arr", "wm_us"])


def test_firings_of_a_burst(spark, small_chunks):
    df = burst(spark)
    args = ("key", "ts", ["arrival_us", "arr"], "v", "5 seconds", "2 seconds", "10 seconds")
    got = late.lateness_firings_min_by(df, *args)
    plain = late.lateness_firings_min_by(df, *args, chunk=F.lit(0))
    cols = ["key", "window_end", "fire_seq", "cnt", "min_value", "min_arr"]
    assert _rows(got, cols) == _rows(plain, cols)


def test_sessions_of_a_burst(spark, small_chunks):
    df = burst(spark).where("arrival_us is not null").withColumn("ts", F.timestamp_micros("arrival_us"))
    agg = [F.count(F.lit(1)).alias("cnt"), F.max("v").alias("v")]
    got = session(df, ["key"], "ts", "1700 milliseconds", agg)
    plain = session_builtin(df, ["key"], "ts", "1700001 microseconds", agg)
    cols = ["key", "window_start", "cnt", "v"]
    assert _rows(got, cols) == _rows(plain, cols)
