"""Allowed lateness, refired rankings and retract rankings on streams: equal to the batch forms."""

import os
import shutil
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rillet.operators import late, ranking, running
from rillet.plans import catalog, jobs
from rillet.session import list_subdirs
from rillet.streaming import changes, lateness
from rillet.streaming.sources import file_stream
from rillet.streaming.stateful import RollingMaxBy, apply_processor
from tests.conftest import SF001, SF0001
from tests.test_streaming import _run_to_memory, _set, _write_files

ARRIVAL = ["arrival_us", "arr"]


class Portions:
    """Files that appear in a folder portion by portion; each run of the streams sees the next."""

    def __init__(self, pdf, n_files, order):
        self.all = _write_files(pdf, os.path.join(tempfile.mkdtemp(prefix="run-"), "all"), n_files, order=order)
        self.root = os.path.join(tempfile.mkdtemp(prefix="run-"), "seen")
        os.makedirs(self.root)
        self.files = sorted(f for f in os.listdir(self.all) if f.endswith(".parquet"))

    def show(self, n):
        for f in self.files[:n]:
            shutil.copy2(os.path.join(self.all, f), self.root)
        self.files = self.files[n:]


def _later(pdf, days, **columns):
    row = pdf.iloc[[-1]].copy()
    row["ts"] = pdf["ts"].max() + pd.Timedelta(days=days)
    for c, v in columns.items():
        row[c] = v
    return row


def _append(df, out, checkpoint):
    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(os.path.join(out, f"b={batch_id}"))
    (df.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def _state_rows(spark, checkpoint, name):
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint).count()


def test_lateness_stream_equals_batch(spark):
    batch = catalog._arrival(catalog._sensor(spark, SF001).select("arr", "id", "ts", "temperature"))
    pdf = batch.toPandas().sort_values(ARRIVAL).reset_index(drop=True)
    step = len(pdf) // 5
    ends = [_later(pdf, 30 * k, id="sentinel", arr=10**9 + k, arrival_us=pdf["arrival_us"].max() + k) for k in (1, 2, 3)]
    parts = Portions(pdf, 5, "arrival_us")
    for k, row in enumerate(ends):  # one file each
        path = os.path.join(parts.all, f"zz-{k}.parquet")
        row.to_parquet(path, index=False, coerce_timestamps="us")
        parts.files.append(os.path.basename(path))
    base = tempfile.mkdtemp(prefix="run-late-")
    tagged, out, ckpt = (os.path.join(base, x) for x in ("tagged", "out", "ckpt"))
    size, bound, lateness_ = catalog.LATE_WINDOW, catalog.LATE_BOUND, catalog.LATENESS
    for n in (2, 3, 1, 1, 1):  # each turn is a restart of both queries
        parts.show(n)
        rows = file_stream(spark, parts.root, "parquet", schema=batch.schema, max_files_per_trigger=1)
        lateness.start_tagging(rows, tagged, base + "/tag", "ts", ARRIVAL, size, bound, lateness_).awaitTermination()
        kept = lateness.committed(spark, tagged, lateness.tagged_schema(batch.schema))
        _append(lateness.min_by_firings(kept, bound, lateness_), out, ckpt)
    assert step > 100 and not [d for d in list_subdirs(spark, tagged) if d.startswith("_staging")]

    # one pass, three folders: the tags are those of the whole table at once
    got = spark.read.parquet(tagged).where("id <> 'sentinel'")
    exp = late.classify_lateness(batch, "ts", ARRIVAL, size, bound, lateness_)
    assert _set(got, ["arr", "status", "wm_us"]) == _set(exp, ["arr", "status", "wm_us"])
    assert {r.status for r in got.select("status").distinct().collect()} == {late.ON_TIME, late.ACCEPTED, late.LATE}

    cols = ["id", "window_end", "fire_seq", "cnt", "min_value", "min_arr"]
    got = spark.read.parquet(out).where("id <> 'sentinel'").withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    exp = late.lateness_firings_min_by(batch, "id", "ts", ARRIVAL, "temperature", size, bound, lateness_)
    assert _set(got, cols) == _set(exp, cols)
    assert exp.where("fire_seq > 0").count() > 50
    assert _state_rows(spark, ckpt, "acc") <= 2  # the last sentinels' windows: all others are purged


def _pages(spark):
    log = catalog._access(spark, SF001).select("arr", "ts", "url")
    pdf = log.toPandas().sort_values("arr").reset_index(drop=True).iloc[:600].copy()
    start = pdf["ts"].iloc[0]
    pdf["url"] = "/p" + (pdf["arr"] * 7 % 11).astype(str)
    back = pd.Series([[0, 0, 0, 8, 40, 75, 400, 900][i * 5 % 8 if i % 3 == 0 else 0] for i in range(len(pdf))])
    pdf["ts"] = start + pd.to_timedelta(pdf["arr"] * 9 - back, unit="s")
    return log.schema, pdf


def test_refired_ranking_stream_equals_batch(spark):
    schema, pdf = _pages(spark)
    batch = spark.createDataFrame(pdf, schema)
    parts = Portions(pdf, 6, "arr")
    for k in (1, 2, 3):
        path = os.path.join(parts.all, f"zz-{k}.parquet")
        _later(pdf, k, url="/end", arr=10**9 + k).to_parquet(path, index=False, coerce_timestamps="us")
        parts.files.append(os.path.basename(path))
    base = tempfile.mkdtemp(prefix="run-pages-")
    tagged, counts, out, ckpt = (os.path.join(base, x) for x in ("tagged", "counts", "out", "ckpt"))
    size, slide, bound, late_ = "10 minutes", "5 seconds", "1 second", "1 minute"
    for n in (1, 2, 3, 1, 1, 1):
        parts.show(n)
        rows = file_stream(spark, parts.root, "parquet", schema=schema, max_files_per_trigger=1)
        lateness.start_page_takings(rows, tagged, counts, base + "/tag", size, slide, bound, late_,
                                    ["arr"]).awaitTermination()
        taken = lateness.committed(spark, counts, lateness.TAKINGS)
        _append(lateness.refired_top_n(taken, bound, late_, 3, "url"), out, ckpt)
    got = spark.read.parquet(out).toPandas()
    got = got[got["url"] != "/end"]
    exp = late.refired_top_n(batch, "url", "ts", ["arr"], size, slide, bound, late_, 3).toPandas()

    def rankings(df, keep):
        return {(r.window_end, r.url, r.cnt, r.rn) for r in df[keep].itertuples()}

    last = got.groupby("window_end")["firing"].transform("max")
    assert rankings(got, got["firing"] == last) == rankings(exp, exp["firing"] == "last")
    first = exp[exp["firing"] == "first"]
    at_first = (got["firing"] == 0) & got["window_end"].isin(first["window_end"])
    assert rankings(got, at_first) == rankings(first, first["rn"] > 0)
    assert (last > 0).any()  # some windows were fired again
    late_rows = spark.read.parquet(tagged).where("status = 'late'")
    tags = late.classify_lateness(batch, "ts", ["arr"], size, bound, late_, slide=slide)
    assert _set(late_rows, ["arr"]) == _set(tags.where("status = 'late'"), ["arr"]) and late_rows.count() > 5
    for name in ("counts", "best", "firings"):
        assert _state_rows(spark, ckpt, name) <= 2 * 120  # the last sentinels' windows only


def test_a_replayed_batch_appears_once(spark):
    rows = spark.createDataFrame([(i, (pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)).to_pydatetime()) for i, s in
                                  enumerate([0, 100, 3, 50, 200, 1])], "arr bigint, ts timestamp")
    base = tempfile.mkdtemp(prefix="run-")
    out, state = base + "/out", base + "/state"
    fn = lateness.tag_batch("ts", ["arr"], "10 seconds", "0 seconds", "60 seconds", out, state)
    os.makedirs(out + "/_staging-0-dead/status=late")  # of an attempt that was killed
    fn(rows.where("arr < 3"), 0)
    fn(rows.where("arr < 3"), 0)
    fn(rows.where("arr >= 3"), 1)
    shutil.rmtree(out + "/batch_id=1")  # killed before the batch appeared
    fn(rows.where("arr >= 3"), 1)
    got = {r.arr: (r.status, r.batch_id) for r in spark.read.parquet(out).collect()}
    assert got == {0: ("on_time", 0), 1: ("on_time", 0), 2: ("late", 0), 3: ("late_accepted", 1), 4: ("on_time", 1),
                   5: ("late", 1)}
    assert sorted(d for d in os.listdir(out) if not d.endswith("crc")) == ["batch_id=0", "batch_id=1"]


def test_top_n_changes_fold_to_the_ranking(spark):
    beh = catalog._behavior(spark, SF0001).select("arr", "item_id", "behavior", "ts")
    pdf = beh.toPandas().sort_values("arr").reset_index(drop=True)
    parts = Portions(pdf, 4, "arr")
    base = tempfile.mkdtemp(prefix="run-topn-")
    counts, out = base + "/counts", base + "/out"
    for n in (1, 2, 1):
        parts.show(n)
        rows = file_stream(spark, parts.root, "parquet", schema=beh.schema, max_files_per_trigger=1)
        changes.start_item_count_changes(rows, counts, base + "/c1", bound="2 days").awaitTermination()
        moved = lateness.committed(spark, counts, changes.COUNT_CHANGES)
        _append(changes.top_n_changes(moved, 5, bound="2 days"), out, base + "/c2")
    got = spark.read.parquet(out).toPandas().sort_values(["window_end", "seq", "is_add", "rn"], kind="stable")
    folded, retracted = {}, 0
    for end, rows_ in got.groupby("window_end"):
        top = {}
        for r in rows_.itertuples():
            if r.is_add:
                assert r.rn not in top
                top[r.rn] = (r.item_id, r.cnt)
            else:
                assert top.pop(r.rn) == (r.item_id, r.cnt)
                retracted += 1
        for rn, (item, cnt) in top.items():
            folded[(end, rn)] = (item, cnt)
    exp = {(r.window_end, r.rn): (r.item_id, r.cnt) for r in jobs.hot_items(beh).collect()}
    assert folded == exp and retracted > 0


def test_top_n_changes_of_growing_counts(spark):
    """One window; counts of a few keys grow over many batches, ranks move both ways."""
    end = pd.Timestamp("2024-01-01 01:00:00").to_pydatetime()
    rng, total, rows = __import__("random").Random(3), {}, []
    for b in range(12):
        for k in rng.sample(range(9), 4):
            total[k] = total.get(k, 0) + rng.randrange(1, 5)
            rows.append((b, k, end, total[k]))
    root = tempfile.mkdtemp(prefix="run-")
    for b in range(12):
        spark.createDataFrame([r[1:] for r in rows if r[0] == b], changes.COUNT_CHANGES).coalesce(1).write.parquet(
            f"{root}/batch_id={b}")
    out = _run_to_memory(changes.top_n_changes(lateness.committed(spark, root, changes.COUNT_CHANGES), 3), "grow")
    top = {}
    for r in sorted(out.collect(), key=lambda r: (r.seq, r.is_add, r.rn)):
        if r.is_add:
            top[r.rn] = (r.item_id, r.cnt)
        else:
            assert top.pop(r.rn) == (r.item_id, r.cnt)
    assert top == dict(enumerate(sorted(total.items(), key=lambda x: (-x[1], x[0]))[:3], 1))


def test_rolling_max_by_keeps_values_over_batches(spark):
    day = pd.Timestamp("2024-01-01 00:00:00.123456")
    pdf = pd.DataFrame({"id": list("abababab"), "arr": range(8),
                        "temperature": [0.12345678901234566, None, 0.1, 1e300, 0.12345678901234564, 2.0, 0.2, None],
                        "ts": [day + pd.Timedelta(microseconds=i) for i in range(8)],
                        "note": ["x", None, "y", "z", "u", "v", "w", "q"], "big": [2**62 + i for i in range(8)]})
    schema = "id string, arr bigint, temperature double, ts timestamp_ntz, note string, big bigint"
    root = _write_files(pdf, os.path.join(tempfile.mkdtemp(prefix="run-"), "m"), 4)
    stream = file_stream(spark, root, "parquet", schema=schema, max_files_per_trigger=1)
    fields = {"temperature": "double", "ts": "timestamp_ntz", "note": "string", "big": "bigint"}
    out = _run_to_memory(apply_processor(
        stream, RollingMaxBy(fields), output_schema="id string, arr bigint, " + ", ".join(
            f"max_{f} {t}" for f, t in fields.items())), "rmtyped")
    exp = running.rolling_max_by(spark.read.schema(schema).parquet(root), "id", "arr", "temperature", list(fields))
    cols = ["id", "arr", *(f"max_{f}" for f in fields)]
    firsts = {("b", 1)}  # no value yet: the batch form has the null record, the stream none
    got, want = ({(r[0], r[1]): r for r in map(tuple, df.select(*cols).collect())} for df in (out, exp))
    assert {k: v for k, v in got.items() if k not in firsts} == {k: v for k, v in want.items() if k not in firsts}
    assert got[("a", 4)][2] == 0.12345678901234566 and got[("a", 4)][3] == day.to_pydatetime()


def brute_retract(counts, n):
    """Row by row in the order of the keys: the top before and after, rank by rank."""
    top, out = [], set()
    for k, c in sorted(counts):
        after = sorted(top + [(k, c)], key=lambda x: (-x[1], x[0]))[:n]
        for rn in range(n):
            old, new = top[rn:rn + 1], after[rn:rn + 1]
            if old != new:
                out |= {(k, False, rn + 1, *r) for r in old} | {(k, True, rn + 1, *r) for r in new}
        top = after
    return out


@pytest.mark.parametrize("order", ["rising", "falling", "ties", "mixed"])
def test_retract_by_carried_prefixes(spark, order):
    rng = __import__("random").Random(5)
    count = {"rising": lambda i: i, "falling": lambda i: 4000 - i, "ties": lambda i: i // 1000,
             "mixed": lambda i: rng.randrange(500)}[order]
    rows = [("hot", i, count(i)) for i in range(4000)]
    rows += [(f"g{i % 40}", i, rng.randrange(9)) for i in range(300)] + [(None, i, i % 5) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, k bigint, c bigint").repartition(5)
    out = ranking.top_n_retract(df, "g", "k", "c", 3)
    got = {}
    for r in out.collect():
        got.setdefault(r.g, set()).add((r.cause, r.is_add, r.rn, r.k, r.c))
    want = {}
    for g, k, c in rows:
        want.setdefault(g, []).append((k, c))
    assert got == {g: brute_retract(v, 3) for g, v in want.items()}
    if order == "rising":  # the hot group's work lies in several tasks
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            out = ranking.top_n_retract(df, "g", "k", "c", 3).where("g = 'hot'")
            assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 2
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
