"""Equivalences the scale-oriented formulations must keep.

Chunked prefix scans are compared with plain per-key windows at chunk widths
small enough that every key spans many chunks.
"""

import re
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillet.functions.text import java_split
from rillet.operators import late, running
from rillet.operators.scan import chunk_by, keyed_scan
from rillet.operators.windows import count_window, duration_us, hop, hop_count_panes, session
from rillet.plans import catalog, jobs
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def sensor(spark):
    return catalog._sensor(spark, SF0001).cache()


def _set(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("width", [1, 7, 100, 1 << 20])
def test_keyed_scan_matches_plain_window(sensor, width):
    w = Window.partitionBy("id").orderBy("arr")
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = sensor.select("id", "arr",
                          F.count(F.lit(1)).over(frame).alias("c"),
                          F.max("temperature").over(frame).alias("m"),
                          F.min("temperature").over(frame).alias("n"),
                          F.lag("temperature").over(w).alias("p"))
    got = keyed_scan(sensor, ["id"], ["arr"], chunk_by("arr", width),
                     running={"c": ("count", F.lit(1)), "m": ("max", F.col("temperature")),
                              "n": ("min", F.col("temperature"))},
                     lags={"p": F.col("temperature")})
    cols = ["id", "arr", "c", "m", "n", "p"]
    assert _set(got, cols) == _set(plain, cols)


@pytest.mark.parametrize("width", [3, 50])
def test_exclusive_sum_and_global_scan(sensor, width):
    w = Window.orderBy("arr").rowsBetween(Window.unboundedPreceding, -1)
    plain = sensor.select("arr", F.sum("arr").over(w).alias("s"))
    got = keyed_scan(sensor, [], ["arr"], chunk_by("arr", width),
                     running={"s": ("sum", F.col("arr"))}, exclusive=True)
    assert _set(got, ["arr", "s"]) == _set(plain, ["arr", "s"])


@pytest.mark.parametrize("width", [5, 1 << 20])
def test_count_window_matches_frame(sensor, width):
    w = Window.partitionBy("id").orderBy("arr")
    plain = (sensor.select("id", F.row_number().over(w).alias("seq"),
                           F.avg("temperature").over(w.rowsBetween(-4, 0)).alias("a"))
             .where("seq % 3 = 0"))
    got = count_window(sensor, ["id"], "arr", "temperature", 5, 3, chunk=chunk_by("arr", width))
    a = [(i, s, round(v, 9)) for i, s, v in _set(got, ["id", "seq", "avg_value"])]
    b = [(i, s, round(v, 9)) for i, s, v in _set(plain, ["id", "seq", "a"])]
    assert a == b


def test_session_chunked_matches_builtin_off_boundary(sensor):
    # No two readings of a key are exactly gap apart here, so Spark's
    # strict-gap session_window and the inclusive-gap sessions agree.
    agg = [F.count(F.lit(1)).alias("cnt")]
    ours = session(sensor, ["id"], "ts", "2 hours", agg, chunk_us=600_000_000)
    builtin = (sensor.groupBy("id", F.session_window("ts", "2 hours").alias("w")).agg(*agg)
               .select("id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cnt"))
    cols = ["id", "window_start", "window_end", "cnt"]
    assert _set(ours, cols) == _set(builtin, cols)


def test_panes_equal_plain_hop(spark):
    beh = catalog._behavior(spark, SF0001).where("behavior = 'view'")
    a = hop(beh, ["item_id"], "ts", "1 hour", "5 minutes", [F.count(F.lit(1)).alias("cnt")])
    b = hop_count_panes(beh, ["item_id"], "ts", "1 hour", "5 minutes")
    cols = ["item_id", "window_start", "window_end", "cnt"]
    assert _set(a, cols) == _set(b, cols)


@pytest.mark.parametrize("size,slide", [("10 minutes", "5 seconds"), ("7 seconds", "3 seconds"), ("4 seconds", "4 seconds")])
def test_sliding_counts_across_chunks(spark, size, slide):
    """Chunk borders, times before 1970, repeated rows, null keys and null times."""
    rows = [(None if i % 11 == 0 else f"k{i % 4}", None if i % 13 == 0 else (i * i * 37) % 20_000 / 4 - 2000) for i in range(900)]
    rows += [("hot", 3.0)] * 400 + [("edge", t) for t in (-0.25, 0.0, 0.25, 4799.75, 4800.0, 4800.25)]
    df = spark.createDataFrame(rows, "k string, s double").select(
        "k", F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint")).cast("timestamp_ntz").alias("ts"))
    got = hop_count_panes(df.repartition(3), ["k"], "ts", size, slide)
    assert got.schema["window_end"].dataType == df.schema["ts"].dataType
    width, step = duration_us(size), duration_us(slide)
    want = Counter((k, end - width, end) for k, s in rows if s is not None for us in [round(s * 1_000_000)]
                   for end in range((us // step + 1) * step, us + width + 1, step))
    got = {(r.k, r.a, r.b): r.cnt for r in got.select("k", "cnt", *(
        F.unix_micros(F.col(c).cast("timestamp")).alias(a) for c, a in (("window_start", "a"), ("window_end", "b")))).collect()}
    assert got == want


def test_sliding_counts_shuffle_panes_not_windows(spark):
    """The windows are laid out above the last shuffle of the count."""
    beh = catalog._behavior(spark, SF0001).where("behavior = 'view'")
    out = hop_count_panes(beh, ["item_id"], "ts", "1 hour", "5 minutes")
    lines = out._jdf.queryExecution().sparkPlan().toString().splitlines()
    laid = [i for i, line in enumerate(lines) if "Generate explode(sequence(" in line and "_end" in line]
    shuffles = [i for i, line in enumerate(lines) if "Exchange" in line or "Repartition" in line]
    grouped = [i for i, line in enumerate(lines) if "HashAggregate" in line]
    assert laid and shuffles and laid[0] < min(shuffles) and laid[0] < min(grouped)


def test_sliding_counts_come_out_chunk_by_chunk(spark):
    """A task finishes a chunk of time before the next, all keys of it, so that window times repeat close by."""
    beh = catalog._behavior(spark, SF0001)
    out = hop_count_panes(beh, ["item_id"], "ts", "1 hour", "5 minutes")
    width = 8 * duration_us("1 hour")
    at = out.select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"),
                    F.floor(F.unix_micros(F.col("window_end").cast("timestamp")) / width).alias("c")).collect()
    at = sorted((r.p, r.i, r.c) for r in at)
    runs = [a[::2] for a, b in zip(at, [None, *at]) if b is None or a[::2] != b[::2]]
    assert len(runs) == len({c for _, c in runs}) > 20


def test_sliding_counts_count_the_panes_once(spark, monkeypatch):
    """The panes of a chunk are counted on the shuffle that the counts come from."""
    from rillet.operators import windows
    monkeypatch.setattr(windows, "CHUNK_PANES", 7, raising=False)
    out = hop_count_panes(catalog._behavior(spark, SF0001), ["item_id"], "ts", "1 hour", "5 minutes")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1


@pytest.mark.parametrize("most", [1, 7, 40])
def test_sliding_counts_cut_wide_chunks(spark, monkeypatch, most):
    """Chunks of too many panes are cut by keys: same counts, same top, and other tasks take part."""
    from rillet.operators import windows
    from rillet.operators.ranking import sliding_top_n, top_n
    rows = [(None if i % 17 == 0 else f"k{i * 7 % 23}", None if i % 29 == 0 else i * i * 37 % 9000) for i in range(800)]
    rows += [("hot", 4800)] * 300 + [("edge", s) for s in (4799, 4800, 4805)] * 2
    df = spark.createDataFrame(rows, "k string, s int").select("k", F.timestamp_seconds("s").alias("ts"))
    size, slide, cols = "10 minutes", "1 minute", ["k", "window_end", "cnt"]
    monkeypatch.setattr(windows, "CHUNK_PANES", most)
    plain = hop(df, ["k"], "ts", size, slide, [F.count(F.lit(1)).alias("cnt")])
    got = hop_count_panes(df, ["k"], "ts", size, slide)
    as_rows = lambda d, c: Counter(tuple(r) for r in d.select(*c).collect())
    assert as_rows(got, cols) == as_rows(plain, cols)
    want = top_n(plain, ["window_end"], [F.desc("cnt"), F.asc("k")], 3)
    assert as_rows(sliding_top_n(df, "k", "ts", size, slide, 3), [*cols, "rn"]) == as_rows(want, [*cols, "rn"])
    tasks = got.select("window_end", F.spark_partition_id().alias("p")).groupBy("window_end").agg(F.countDistinct("p").alias("n"))
    assert tasks.agg(F.max("n")).first()[0] > 1


def test_salted_equals_unsalted(spark):
    beh = catalog._behavior(spark, SF0001)
    cols = ["label", "window_end", "cnt"]
    assert _set(jobs.pv_count_salted(beh), cols) == _set(jobs.pv_count(beh), cols)


def test_bitmap_equals_exact_without_collisions(spark):
    beh = catalog._behavior(spark, SF0001)
    cols = ["label", "window_end", "cnt"]
    assert _set(jobs.unique_visitors(beh, how="bitmap"), cols) == _set(jobs.unique_visitors(beh, how="exact"), cols)


def test_late_plus_kept_is_input(spark, sensor):
    s = catalog._arrival(sensor)
    kept, lost = late.late_split(s, "ts", ["arrival_us", "arr"], "5 seconds", "2 seconds", "1 minute",
                                 chunk=chunk_by("arrival_us", 600_000_000))
    assert kept.count() + lost.count() == sensor.count()
    assert lost.count() > 0


def test_watermark_chunked_equals_single_chunk(spark, sensor):
    s = catalog._arrival(sensor)
    a = late.running_watermark(s, "ts", ["arrival_us", "arr"], "2 seconds",
                               chunk=chunk_by("arrival_us", 60_000_000))
    b = late.running_watermark(s, "ts", ["arrival_us", "arr"], "2 seconds", chunk=F.lit(0))
    assert _set(a, ["arr", "wm_us"]) == _set(b, ["arr", "wm_us"])


def test_running_word_count_chunks(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", F.col("text").alias("value"))
    a = running.running_word_count(docs, "doc_id", chunk=chunk_by("doc_id", 3))
    b = running.running_word_count(docs, "doc_id", chunk=F.lit(0))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_running_word_count_of_repeated_and_null_orders(spark):
    """Lines of one order interleave by place; empty and null lines have their tokens or none."""
    words = ["a", "b", "", "a a", "b a", "c"]
    rows = [(None if i % 9 == 0 else i // 2 if i % 5 else i, None if i % 17 == 0 else " ".join(words[(i * j) % 6] for j in range(i % 8)))
            for i in range(200)]
    for some in (rows, [(i, v) for i, (_, v) in enumerate(rows)]):
        lines = spark.createDataFrame(some, "id bigint, value string").repartition(3)
        tokens = lines.select("id", F.posexplode(java_split("value", " ")).alias("pos", "word"))
        w = Window.partitionBy("word").orderBy("id", "pos").rowsBetween(Window.unboundedPreceding, 0)
        want = tokens.select("id", "pos", "word", F.count(F.lit(1)).over(w).alias("cnt"))
        for chunk in (chunk_by("id", 4), F.lit(0)):
            got = running.running_word_count(lines, "id", chunk=chunk)
            assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("fan", [None, 4])
def test_scan_shuffles_its_rows_once_and_keys_once(spark, fan):
    lines = spark.createDataFrame([(i, f"x x y{i % 7}") for i in range(40)], "id bigint, value string")
    out = running.running_word_count(lines, "id", chunk=chunk_by("id", 2), fan=fan)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    by_rows = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(_kv0" in line and "_chunk" in line
               and "REPARTITION_BY_COL" in line and "ReusedExchange" not in line]
    assert len(by_rows) == 1
    sent = plan[by_rows[0] + 1].split("Project [")[1].split(", ")
    assert not any(c.startswith("word#") or c.endswith("AS word") for c in sent) and any("_kv0#" in c for c in sent)


def test_hot_key_is_split_and_exact(spark):
    """90% of the rows on one key: the chunked scan spreads that key over many
    (key, chunk) groups and still equals the single-partition window."""
    n = 5000
    df = spark.range(n).select(
        F.col("id").alias("arr"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
         .otherwise(F.lit("hot")).alias("key"),
        ((F.col("id") * 37) % 101).cast("double").alias("v"))
    width = 256
    got = keyed_scan(df, ["key"], ["arr"], chunk_by("arr", width),
                     running={"c": ("count", F.lit(1)), "m": ("max", F.col("v"))},
                     lags={"p": F.col("v")})
    w = Window.partitionBy("key").orderBy("arr")
    plain = df.select("key", "arr", F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"),
                      F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
                      F.lag("v").over(w).alias("p"))
    cols = ["key", "arr", "c", "m", "p"]
    assert _set(got, cols) == _set(plain, cols)


def test_uv_approx_close_to_exact(spark):
    beh = catalog._behavior(spark, "/root/testdata/sf0.01")
    exact = {r.window_end: r.cnt for r in jobs.unique_visitors(beh, how="exact").collect()}
    approx = {r.window_end: r.cnt for r in jobs.unique_visitors(beh, how="approx").collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= max(1, 0.05 * v) for k, v in exact.items())


@pytest.mark.parametrize("fan", [None, 3, 64])
def test_scan_of_one_hot_key_over_thousands_of_chunks(spark, fan):
    n = 6000
    df = spark.range(n).select(F.col("id").alias("arr"), F.lit("hot").alias("key"),
                               ((F.col("id") * 37) % 101).cast("double").alias("v")).repartition(5)
    got = keyed_scan(df, ["key"], ["arr"], chunk_by("arr", 2), fan=fan,
                     running={"c": ("count", F.lit(1)), "s": ("sum", F.col("v")), "m": ("max", F.col("v")),
                              "l": ("min", F.col("v")), "s0": ("sum", F.col("v"), True)}, lags={"p": F.col("v")})
    w = Window.partitionBy("key").orderBy("arr")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("key", "arr", F.count(F.lit(1)).over(upto).alias("c"), F.sum("v").over(upto).alias("s"),
                      F.max("v").over(upto).alias("m"), F.min("v").over(upto).alias("l"), F.lag("v").over(w).alias("p"),
                      F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("s0"))
    cols = ["key", "arr", "c", "s", "m", "l", "p", "s0"]
    assert _set(got, cols) == _set(plain, cols)


def test_scan_reads_its_source_once(spark):
    from tests.conftest import SF001
    out = running.keyed_running_count(catalog._sensor(spark, SF001), "id", "arr")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_scans_keep_rows_without_order_or_key(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", None, 2.0), (None, 4, 3.0), ("a", 9, None)],
                               "id string, arr bigint, temperature double")
    assert running.keyed_running_count(df, "id", "arr").count() == 4
    assert running.global_running_count(df, "arr").count() == 4
    assert running.rolling_reduce(df.withColumn("ts_sec", F.lit(0)), "id", "arr", "ts_sec", "temperature").count() == 4
    got = {(r.id, r.arr): r.max_temperature for r in
           running.rolling_max_by(df, "id", "arr", "temperature", ["temperature"]).collect()}
    assert len(got) == 4 and got["a", 9] == 2.0
    changes = running.retract_changelog(df, "id", "arr", "temperature")
    assert changes.where("is_add").count() == 4 and changes.where("not is_add").count() == 2


def test_retract_mean_skips_nulls(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, None), ("a", 3, 20.0), ("b", 4, None)],
                               "id string, arr bigint, temperature double")
    got = sorted(running.retract_changelog(df, "id", "arr", "temperature").collect(), key=lambda r: (r.arr, r.is_add))
    assert [(r.arr, r.is_add, r.cnt, r.avg_value) for r in got] == [
        (1, True, 1, 10.0), (2, False, 1, 10.0), (2, True, 2, 10.0), (3, False, 2, 10.0), (3, True, 3, 15.0),
        (4, True, 1, None)]
    last = running.group_count_avg(df, "id", "temperature").where("id = 'a'").first()
    assert (last.cnt, last.avg_value) == (3, 15.0)


def test_means_are_not_rounded_first(spark):
    from rillet.functions.udfs import avg_temp, avg_temp_sql, register_avg_temp
    df = spark.createDataFrame([("a", 0.00004), ("a", 0.00003), ("a", None)], "id string, v double")
    assert abs(df.groupBy("id").agg(avg_temp("v").alias("m")).first().m - 3.5e-5) < 1e-18
    register_avg_temp(spark)
    for mean in ("avg_temp(v)", avg_temp_sql("v")):
        got = spark.sql(f"SELECT {mean} AS m FROM {{t}} GROUP BY id", t=df).first().m
        assert abs(got - 3.5e-5) < 1e-18


def test_fixed_digits_of_any_number(spark):
    import math

    from rillet.functions.numeric import fixed_digits
    values = [1e14, -1e300, float("inf"), float("nan"), 0.5e-6, -1.2345675, 2.0000005, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.g for r in df.select(fixed_digits(F.col("v")).alias("g")).collect()]
    assert got[:3] == values[:3] and math.isnan(got[3]) and got[7] is None
    assert got[4] == 1e-6 and abs(got[5] + 1.234567) < 1e-12 and abs(got[6] - 2.000001) < 1e-9


def test_access_log_keeps_every_event(spark):
    import datetime as dt

    from rillet.sources.files import parse_access_log
    from rillet.sources.tables import access_log_from_events, access_log_lines
    ts = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([(i, ts, 7, "view", f'{{"k": {i}}}' if i else "{}") for i in range(7)],
                                   "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string")
    pages = spark.createDataFrame([(0, "/a"), (2, "/c"), (3, "/d"), (None, "/x"), (2, "/b")], "page_id bigint, url string")
    log = access_log_from_events(events, pages)
    got = {r.arr: r.url for r in log.collect()}
    order = ["/a", "/b", "/c", "/d"]
    assert got == {0: None, **{i: order[i % 4] for i in range(1, 7)}}
    assert {r.arr: r.url for r in parse_access_log(access_log_lines(log)).collect()} == got


def test_windows_hold_several_rows(spark):
    """The registered queries exercise their operators: groups of many rows, refirings, dropped assets."""
    from tests.conftest import SF001
    q = {name: catalog.QUERIES[name](spark, SF001) for name in
         ("tumble_count", "tumble_count_full", "tumble_count_avg", "session_count", "allowed_lateness",
          "filter_static_assets", "late_split", "hot_pages_late")}
    assert q["tumble_count"].where("cnt > 1").count() > 1000
    assert q["tumble_count_full"].where("size > 2").count() > 500
    assert q["tumble_count_avg"].where("cnt > 1").count() > 1000
    assert q["session_count"].where("cnt > 1").count() > 1000
    assert q["allowed_lateness"].where("fire_seq >= 1 and cnt > 1").count() > 10
    assert 2000 < q["filter_static_assets"].count() < 8000
    assert q["late_split"].select("status").distinct().count() == 3
    assert q["hot_pages_late"].count() > 100


def test_top_n_thins_before_the_window_shuffle(spark):
    from rillet.operators.ranking import sliding_top_n
    out = sliding_top_n(catalog._behavior(spark, SF0001), "item_id", "ts", "1 hour", "5 minutes", 5)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    final, partial = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert "Partial" in plan[partial:partial + 400] and "Exchange" in plan[final:partial]


def test_top_n_lays_out_windows_above_the_shuffle_of_panes(spark):
    """Only what a task keeps of each window is shuffled after the windows are laid out."""
    from rillet.operators.ranking import sliding_top_n
    out = sliding_top_n(catalog._behavior(spark, SF0001), "item_id", "ts", "1 hour", "5 minutes", 5)
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    laid = next(i for i, line in enumerate(lines) if "Generate explode(sequence(" in line and "_end" in line)
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line and i < laid]
    above = [i for i, line in enumerate(lines) if "Exchange" in line and i < laid]
    assert len(above) == 1 and min(limits) < above[0] < max(limits)


def test_top_n_of_a_window_comes_from_one_task(spark):
    """All keys of a window lie in one task (unless its chunk is wide), so no more than ``n`` rows of it are shuffled."""
    from rillet.operators.windows import sliding_counts
    counts = sliding_counts(catalog._behavior(spark, SF0001), ["item_id"], "ts", "1 hour", "5 minutes")
    tasks = counts.select("_end", F.spark_partition_id().alias("p")).groupBy("_end").agg(
        F.countDistinct("p").alias("n"), F.count("p").alias("keys"))
    assert tasks.where("keys > 1").count() > 100
    assert tasks.where("n > 1").count() == 0


def test_top_n_takes_more_tasks_for_more_windows(spark, monkeypatch):
    """A task lays out and sorts so many windows, however many there are in all: same top, by more tasks than configured."""
    from rillet.operators import windows
    from rillet.operators.ranking import sliding_top_n, top_n
    rows = [(None if i % 17 == 0 else f"k{i * 7 % 23}", None if i % 29 == 0 else i * i * 37 % 90_000) for i in range(800)]
    rows += [("hot", 4800)] * 300 + [("edge", s) for s in (4799, 4800, 4805)] * 2
    df = spark.createDataFrame(rows, "k string, s int").select("k", F.timestamp_seconds("s").alias("ts"))
    size, slide, cols = "10 minutes", "1 minute", ["k", "window_end", "cnt"]
    plain = hop(df, ["k"], "ts", size, slide, [F.count(F.lit(1)).alias("cnt")])
    monkeypatch.setattr(windows, "TASK_WINDOWS", 50, raising=False)
    monkeypatch.setattr(windows, "CHUNK_PANES", 7)
    got = sliding_top_n(df, "k", "ts", size, slide, 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    dealt = re.search(r"Exchange hashpartitioning\(_chunk#\d+L?, _cut#\d+L?, (\d+)\)", plan)
    assert int(dealt[1]) >= plain.count() / 50 and got.rdd.getNumPartitions() >= plain.count() / 200 > 8
    want = top_n(plain, ["window_end"], [F.desc("cnt"), F.asc("k")], 3)
    as_rows = lambda d: Counter(tuple(r) for r in d.select(*cols, "rn").collect())
    assert as_rows(got) == as_rows(want)


def test_number_of_tasks_follows_windows_not_rows(spark, monkeypatch):
    from rillet.operators import windows
    monkeypatch.setattr(windows, "TASK_WINDOWS", 100)
    at = lambda n, step: spark.range(n).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * step).alias("ts"))
    tasks = lambda df: windows.sliding_tasks(df, ["k"], "ts", "10 minutes", "5 seconds")
    assert tasks(at(5000, 0)) == 2  # one pane, 120 windows
    assert 5 <= tasks(at(3000, 1)) <= 12  # 3,000 rows of 600 panes, 720 windows
    assert 100 <= tasks(at(100, 6000)) <= 140  # 100 panes that share no window
    assert tasks(at(0, 1)) == 0
    assert tasks(at(5, 1).select("k", F.lit(None).cast("timestamp").alias("ts"))) == 0


def test_retract_stream_replays_to_the_ranking(spark):
    """Applying the changes in order leaves each window's final top."""
    changes = catalog.QUERIES["hot_items_retract"](spark, SF0001).collect()
    state = {}
    for r in sorted(changes, key=lambda r: (r.window_end, r.cause, r.rn, r.is_add)):
        if not r.is_add:
            assert state.get((r.window_end, r.rn)) == (r.item_id, r.cnt)
        else:
            state[r.window_end, r.rn] = (r.item_id, r.cnt)
    want = {(r.window_end, r.rn): (r.item_id, r.cnt) for r in catalog.QUERIES["hot_items_topn"](spark, SF0001).collect()}
    assert state == want


def test_csv_round_trips(spark, tmp_path):
    from rillet.sources.files import read_csv_table, sink_csv
    from rillet.sources.kafka import kafka_csv_decode, kafka_csv_encode
    rows = [("a,b", 1.0), ('say "x"', None), (" s ", 2.5), ("", 3.0), (None, 4.0), ("'", -1.0), ("a\\b", 0.0),
            ('"', 1.0), ("\u00e9", 2.0), (",", None)]
    df = spark.createDataFrame(rows, "id string, temperature double")
    sink_csv(df, str(tmp_path / "t"))
    assert sorted(map(repr, read_csv_table(spark, str(tmp_path / "t"), df.schema).collect())) == sorted(
        map(repr, df.collect()))
    back = kafka_csv_decode(kafka_csv_encode(df, ["id", "temperature"], key="id"), "id string, temperature double")
    assert sorted(repr((r.id, r.temperature)) for r in back.collect()) == sorted(map(repr, rows))
    plain = kafka_csv_encode(df.limit(1).select(F.lit("x").alias("id"), F.lit(1.5).alias("temperature")), ["id", "temperature"])
    assert bytes(plain.first().value) == b"x,1.5"


def test_late_rows_of_sliding_windows(spark):
    """A row is late only when the last window that holds it is past."""
    rows = [(1, 0), (2, 100), (3, 1000), (4, 700), (5, 399), (6, 340), (7, 335), (8, 330)]
    df = spark.createDataFrame(rows, "arr bigint, s bigint").select(
        "arr", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    got = {r.arr: r.status for r in late.classify_lateness(
        df, "ts", ["arr"], "10 minutes", "1 second", "1 minute", slide="5 seconds").collect()}
    # The watermark is 999 s from the fourth row on; the last window of second t ends at t - t % 5 + 600.
    assert got == {1: "on_time", 2: "on_time", 3: "on_time", 4: "on_time", 5: "late_accepted", 6: "late_accepted",
                   7: "late", 8: "late"}


def test_partition_setup_closes_after_an_error(spark, tmp_path):
    from rillet.operators.routing import map_partitions_with_setup

    def each(context, frame):
        raise ValueError("no")

    def close(context):
        open(str(tmp_path / f"closed-{context}"), "w").close()

    with pytest.raises(Exception):
        map_partitions_with_setup(spark.range(4, numPartitions=2), lambda i: i, each, close, "id bigint").collect()
    assert list(tmp_path.iterdir())


def test_bitmap_counts_equal_distinct_offsets(spark):
    beh = catalog._behavior(spark, SF0001)
    out = jobs.unique_visitors(beh, how="bitmap")
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    exact = {r.window_end: r.cnt for r in jobs.unique_visitors(beh, how="exact").collect()}
    assert {r.window_end: r.cnt for r in out.collect()} == exact
