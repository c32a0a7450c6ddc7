"""Triggers, two streams in one operator, exact distinct counts and a global count on streams."""

import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rillet.functions.aggregates import Course, Mean
from rillet.plans import catalog, jobs
from rillet.streaming import coprocess, keyed_table, triggers
from rillet.streaming import jobs as sjobs
from rillet.streaming.sinks import global_running_count_batch
from rillet.streaming.sources import file_stream
from tests.conftest import SF0001
from tests.test_lateness_streams import Portions
from tests.test_streaming import _run_to_memory, _set, _write_files, _write_with_sentinels


def test_exact_visitors_stream_equals_batch(spark):
    beh = catalog._behavior(spark, SF0001).select("arr", "user_id", "item_id", "behavior", "ts")
    pdf = beh.toPandas()
    pdf["user_id"] = pdf["user_id"] % 7  # repeated visits
    pdf["ts"] = pdf["ts"].min() + (pdf["ts"] - pdf["ts"].min()) / 30
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    root = _write_with_sentinels(pdf, os.path.join(tempfile.mkdtemp(prefix="run-"), "uvx"), 5)
    stream = file_stream(spark, root, "parquet", schema=beh.schema, max_files_per_trigger=1)
    out = _run_to_memory(sjobs.uv_exact_stream(stream, bound="1 hour"), "uvx")
    got = {(r.window_end.replace(tzinfo=None), r.cnt) for r in out.collect()}
    exp = jobs.unique_visitors(spark.createDataFrame(pdf, beh.schema), how="exact").collect()
    last = pdf["ts"].max() + pd.Timedelta(hours=1)
    assert {x for x in got if x[0] <= last} == {(r.window_end, r.cnt) for r in exp}
    assert max(c for _, c in got) > 3


def _readings(n=400):
    rng = __import__("random").Random(8)
    start = pd.Timestamp("2024-01-01")
    return pd.DataFrame({"id": [f"k{rng.randrange(4)}" for _ in range(n)], "arr": range(n),
                         "ts": [start + pd.Timedelta(seconds=3 * i + rng.randrange(-8, 9)) for i in range(n)],
                         "temperature": [rng.randrange(0, 100) / 4 for _ in range(n)]})


SCHEMA = "id string, arr bigint, ts timestamp, temperature double"


def brute(pdf, aggregate, trigger, size):
    """Row by row, window by window."""
    out = set()
    end = pdf["ts"].dt.floor(f"{size}s") + pd.Timedelta(seconds=size)
    for (key, e), rows in pdf.groupby([pdf["id"], end]):
        acc, untold, firing = aggregate.create(), 0, 0
        for i in range(len(rows)):
            acc, untold = aggregate.add(acc, rows.iloc[i:i + 1]), untold + 1
            if trigger.every and (i + 1) % trigger.every == 0:
                out.add((key, e, firing, *aggregate.result(acc)))
                firing, untold = firing + 1, 0
                acc = aggregate.create() if trigger.purge else acc
        if trigger.at_end and untold:
            out.add((key, e, firing, *aggregate.result(acc)))
    return out


@pytest.mark.parametrize("trigger", [triggers.AT_END, triggers.FIRE_AND_PURGE, triggers.Trigger(every=3),
                                     triggers.Trigger(every=4, purge=True), triggers.Trigger(every=3, at_end=False)])
def test_triggers(spark, trigger):
    pdf = _readings()
    end = pdf.iloc[[-1, -1]].copy()
    end["id"], end["ts"] = "end", end["ts"] + pd.to_timedelta([1, 2], unit="D")
    root = _write_files(pdf, os.path.join(tempfile.mkdtemp(prefix="run-"), "t"), 5)
    for k in range(2):
        path = os.path.join(root, f"zz-{k}.parquet")
        end.iloc[[k]].to_parquet(path, index=False, coerce_timestamps="us")
        os.utime(path, (1_700_000_500 + k, 1_700_000_500 + k))
    aggregate = Course("arr", "temperature") if trigger.every != 1 else Mean("temperature")
    stream = file_stream(spark, root, "parquet", schema=SCHEMA, max_files_per_trigger=1)
    out = _run_to_memory(triggers.triggered_windows(stream, "id", "ts", "arr", "60 seconds", "20 seconds", aggregate,
                                                    trigger), "trig")
    got = {tuple(r) for r in out.where("id <> 'end'").withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz")).collect()}
    assert got == brute(pdf, aggregate, trigger, 60) and len(got) > 20


def test_one_side_decides_what_the_other_gives(spark):
    pdf = _readings(300)
    rng = __import__("random").Random(4)
    limits = pd.DataFrame([(f"k{rng.randrange(4)}", a, None if rng.random() < 0.2 else rng.randrange(0, 100) / 4)
                           for a in range(0, 300, 5)], columns=["id", "arr", "limit"])
    limits["limit"] = limits["limit"].astype("float64")
    base = tempfile.mkdtemp(prefix="run-")
    a = _write_files(pdf, base + "/a", 3)
    b = _write_files(limits, base + "/b", 3)  # the same spans of arrivals, file by file
    first = file_stream(spark, a, "parquet", schema=SCHEMA, max_files_per_trigger=1).select("id", "arr", "temperature")
    second = file_stream(spark, b, "parquet", schema="id string, arr bigint, limit double", max_files_per_trigger=1)
    out = _run_to_memory(coprocess.co_process(first, second, "id", coprocess.LimitGate(),
                                              "id string, arr bigint, temperature double, limit double"), "gate")
    events = [(r.arr, 0, r.id, r.limit) for r in limits.itertuples()]
    events += [(r.arr, 1, r.id, r.temperature) for r in pdf.itertuples()]
    force, want = {}, []
    for arr, side, key, v in sorted(events, key=lambda e: e[:2]):
        if side == 0:
            force[key] = v
        elif key in force and not pd.isna(force[key]) and v >= force[key]:
            want.append((key, arr, v, force[key]))
    assert sorted(tuple(r) for r in out.collect()) == sorted(want) and 20 < len(want) < 280


def test_keyed_table_follows_the_touched_keys(spark):
    rng = __import__("random").Random(6)
    root = tempfile.mkdtemp(prefix="run-kt-")
    fn = keyed_table.keyed_table_batch("k", "arr", root, ["v", "note"], most=40)
    want, arr, written = {}, 0, []
    for b in range(8):
        rows = []
        for _ in range(120 if b < 5 else 3):
            k = None if rng.random() < 0.02 else f"k{rng.randrange(60 * (b + 1)) if b < 5 else 7}"
            arr += 1
            rows.append((k, arr - rng.randrange(40), rng.random(), None if rng.random() < 0.3 else "x"))
        for k, a, v, note in rows:
            best = want.get(k)
            if best is None or (a, v) > best[:2]:
                want[k] = (a, v, note)
        df = spark.createDataFrame(rows, "k string, arr bigint, v double, note string")
        if b == 4:  # an attempt that is killed before its manifest appears
            df.limit(5).withColumn("bucket", F.lit("b")).write.partitionBy("bucket").parquet(f"{root}/rows/version=4")
        fn(df, b)
        fn(df.limit(1).withColumn("arr", F.col("arr") + 10**6), b)  # a replay: nothing changes
        got = {r.k: (r.arr, r.v, r.note) for r in keyed_table.read_keyed_table(spark, root).collect()}
        assert got == want and keyed_table.read_keyed_table(spark, root).count() == len(want)
        written.append(spark.read.parquet(f"{root}/rows/version={b}").count())
    buckets = keyed_table._buckets(spark, root, 7)
    assert len(buckets) > 4 and max(r.n for r in buckets) <= 80 and sum(r.n for r in buckets) == len(want)
    assert max(written[5:]) < len(want) / 3  # few keys, few buckets
    assert keyed_table._manifests(spark, root) == [7, 6]
    before = {r.k for r in keyed_table.read_keyed_table(spark, root, before=7).collect()}
    assert before <= set(want)


def test_global_count_goes_on_after_restarts(spark):
    pdf = _readings(500)[["id", "arr"]]
    parts = Portions(pdf, 5, "arr")
    base = tempfile.mkdtemp(prefix="run-")
    out, totals = base + "/out", base + "/totals"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, partitions in ((2, 8), (1, 3), (2, 5)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            parts.show(n)
            rows = file_stream(spark, parts.root, "parquet", schema="id string, arr bigint", max_files_per_trigger=1)
            fn = global_running_count_batch("arr", out, totals)
            (rows.writeStream.foreachBatch(fn).option("checkpointLocation", base + "/ckpt")
             .trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert _set(spark.read.parquet(out), ["arr", "cnt"]) == [(i, i + 1) for i in sorted(range(500), key=lambda i: repr((i, i + 1)))]
    assert len(os.listdir(totals)) <= 4
    fn(spark.createDataFrame(pdf.iloc[:100], "id string, arr bigint"), 0)  # a replay
    assert spark.read.parquet(out).count() == 500
