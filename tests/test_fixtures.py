"""Golden tests on the hand-derived expected values of the small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillet.functions.text import java_split, poly_hash, scaled_hash_code
from rillet.functions.udfs import avg_temp, split_pieces
from rillet.operators import late, routing, running
from rillet.operators.windows import count_window, session, tumble
from tests.fixtures import TEXT_LINES, rows, sensor, sensor_lines


def test_map_line_length(spark):
    out = routing.map_line_length(sensor_lines(spark)).orderBy("arr")
    assert [r.len for r in out.collect()] == [23, 24, 23, 24, 24, 23, 24, 23]


def test_flatmap_fields(spark):
    assert routing.flatmap_fields(sensor_lines(spark)).count() == 24


def test_filter_prefix_keeps_longer_ids(spark):
    out = routing.filter_prefix(sensor_lines(spark), "probe_2")
    assert sorted(r.arr for r in out.collect()) == [1, 3, 4, 5, 7]


def test_rolling_max_by(spark):
    out = running.rolling_max_by(sensor(spark), "id", "arr", "temperature", ["ts_sec", "temperature"])
    s1 = sorted(rows(out.where("id = 'probe_2'"), "arr", "max_ts_sec", "max_temperature"))
    assert [(t % 1000, v) for _, t, v in s1] == [(4, 21.5), (4, 21.5), (13, 33.75), (13, 33.75)]


def test_rolling_reduce(spark):
    out = running.rolling_reduce(sensor(spark), "id", "arr", "ts_sec", "temperature")
    s1 = sorted(rows(out.where("id = 'probe_2'"), "arr", "ts_sec", "max_temperature"))
    assert [(t % 1000, v) for _, t, v in s1] == [(4, 21.5), (11, 21.5), (13, 33.75), (31, 33.75)]


def test_split_route_and_union(spark):
    tagged = routing.split_route(sensor(spark), F.col("temperature") > 30)
    high = routing.select_route(tagged, "high")
    low = routing.select_route(tagged, "low")
    both = routing.select_route(tagged, "high", "low")
    assert sorted(r.arr for r in high.collect()) == [2, 4, 5, 6]
    assert sorted(r.arr for r in low.collect()) == [1, 3, 7, 8]
    assert both.count() == 8
    assert routing.union_all(high, low, both).count() == 16


def test_connect_map(spark):
    tagged = routing.split_route(sensor(spark), F.col("temperature") > 30)
    warn = routing.select_route(tagged, "high").select("id", "temperature",
                                                       F.lit("high temp warning").alias("msg"))
    normal = routing.select_route(tagged, "low").select("id", F.lit("normal").alias("msg"))
    msgs = [r.msg for r in routing.connect_map(warn, normal).collect()]
    assert msgs.count("high temp warning") == 4 and msgs.count("normal") == 4


def test_tumble_count_15s(spark):
    out = tumble(sensor(spark), ["id"], "ts", "15 seconds", [F.count(F.lit(1)).alias("cnt")])
    got = {(r.id, int(r.window_start.replace(tzinfo=dt.timezone.utc).timestamp()) % 1000, r.cnt)
           for r in out.collect()}
    assert got == {("probe_2", 995, 1), ("probe_2", 10, 2), ("probe_2", 25, 1), ("probe_9", 995, 1),
                   ("probe_9", 25, 1), ("probe_20", 10, 1), ("probe_4", 25, 1)}


def _sec(t):
    return int(t.replace(tzinfo=dt.timezone.utc).timestamp()) % 1000


def test_tumble_min_by_5s(spark):
    rec = F.struct("temperature", "arr", "ts_sec")
    out = tumble(sensor(spark), ["id"], "ts", "5 seconds", [F.min(rec).alias("m")])
    got = {(r.id, _sec(r.window_start), r.m.temperature, r.m.ts_sec % 1000) for r in out.collect()}
    assert got == {("probe_2", 0, 21.5, 4), ("probe_2", 10, 19.0, 11), ("probe_2", 30, 26.75, 31),
                   ("probe_9", 5, 48.25, 6), ("probe_9", 25, 44.0, 29), ("probe_20", 10, 30.5, 12),
                   ("probe_4", 30, 12.0, 33)}


def test_tumble_count_avg_10s(spark):
    out = tumble(sensor(spark), ["id"], "ts", "10 seconds",
                 [F.count("id").alias("cnt"), F.avg("temperature").alias("avg")])
    got = {(r.id, _sec(r.window_end), r.cnt, round(r.avg, 4)) for r in out.collect()}
    assert got == {("probe_2", 10, 1, 21.5), ("probe_2", 20, 2, 26.375), ("probe_2", 40, 1, 26.75),
                   ("probe_9", 10, 1, 48.25), ("probe_9", 30, 1, 44.0), ("probe_20", 20, 1, 30.5),
                   ("probe_4", 40, 1, 12.0)}


@pytest.mark.parametrize("chunk_us", [None, 3_000_000])
def test_session_count_15s(spark, chunk_us):
    out = session(sensor(spark), ["id"], "ts", "15 seconds", [F.count(F.lit(1)).alias("cnt")],
                  chunk_us=chunk_us)
    got = {(r.id, _sec(r.window_start), _sec(r.window_end), r.cnt) for r in out.collect()}
    assert got == {("probe_2", 4, 28, 3), ("probe_2", 31, 46, 1), ("probe_9", 6, 21, 1), ("probe_9", 29, 44, 1),
                   ("probe_20", 12, 27, 1), ("probe_4", 33, 48, 1)}


@pytest.mark.parametrize("width", [1 << 20, 2])
def test_count_window_avg(spark, width):
    from rillet.operators.scan import chunk_by
    out = count_window(sensor(spark), ["id"], "arr", "temperature", 10, 2, chunk=chunk_by("arr", width))
    got = sorted((r.id, r.seq, round(r.avg_value, 4)) for r in out.collect())
    assert got == [("probe_2", 2, 20.25), ("probe_2", 4, 25.25), ("probe_9", 2, 46.125)]


def test_keyed_and_global_running_count(spark):
    k = running.keyed_running_count(sensor(spark), "id", "arr")
    assert sorted(rows(k.where("id = 'probe_2'"), "arr", "cnt")) == [(1, 1), (3, 2), (5, 3), (7, 4)]
    g = running.global_running_count(sensor(spark), "arr")
    assert sorted(rows(g, "arr", "cnt")) == [(i, i) for i in range(1, 9)]


def test_temp_jump_alert(spark):
    s = sensor(spark)
    got = rows(running.temp_jump_alert(s, "id", "arr", "temperature", 10.0), "id", "last_value", "cur_value")
    assert got == [("probe_2", 19.0, 33.75)]
    got = rows(running.temp_jump_alert(s, "id", "arr", "temperature", 4.0), "id", "last_value", "cur_value")
    assert sorted(got) == [("probe_2", 19.0, 33.75), ("probe_2", 33.75, 26.75), ("probe_9", 48.25, 44.0)]


def test_group_count_avg_and_udaf(spark):
    out = running.group_count_avg(sensor(spark), "id", "temperature")
    got = {(r.id, r.cnt, round(r.avg_value, 4)) for r in out.collect()}
    assert got == {("probe_2", 4, 25.25), ("probe_9", 2, 46.125), ("probe_20", 1, 30.5), ("probe_4", 1, 12.0)}
    u = sensor(spark).groupBy("id").agg(avg_temp("temperature").alias("a"))
    assert {(r.id, round(r.a, 4)) for r in u.collect()} == {(i, a) for i, _, a in got}


def test_retract_changelog(spark):
    out = running.retract_changelog(sensor(spark), "id", "arr", "temperature", digits=4)
    s1 = sorted(rows(out.where("id = 'probe_2'"), "arr", "is_add", "cnt", "avg_value"),
                key=lambda r: (r[0], r[1]))
    assert s1 == [(1, True, 1, 21.5), (3, False, 1, 21.5), (3, True, 2, 20.25),
                  (5, False, 2, 20.25), (5, True, 3, 24.75), (7, False, 3, 24.75), (7, True, 4, 25.25)]
    flags = [r.is_add for r in out.collect()]
    assert flags.count(True) == 8 and flags.count(False) == 4


def units(text):
    raw = text.encode("utf-16-be")
    return [raw[i] << 8 | raw[i + 1] for i in range(0, len(raw), 2)]


def folded(text, seed, mask):
    h = 0
    for u in units(text):
        h = h * seed + u & mask
    return h


def int32(u):
    return u - (1 << 32) if u >= 1 << 31 else u


def test_udf_hash_code(spark):
    out = sensor(spark).select("id", scaled_hash_code("id", 23).alias("h")).distinct()
    assert {(r.id, r.h) for r in out.collect()} == {
        (i, int32(folded(i, 31, 0xFFFFFFFF) * 23 & 0xFFFFFFFF)) for i in ("probe_2", "probe_9", "probe_20", "probe_4")}


def test_udf_hash_code_sql_function(spark):
    from rillet.functions.text import register_sql_functions
    register_sql_functions(spark, 23)
    for text in ("probe_20", "", "\U0001F600x", "ab\U00010000"):
        got = spark.sql("SELECT hash_code(:t) AS h, poly_offset(:t) AS p", args={"t": text}).first()
        assert got.h == int32(folded(text, 31, 0xFFFFFFFF) * 23 & 0xFFFFFFFF)
        assert got.p == folded(text, 61, (1 << 29) - 1)


def test_strings_are_utf16(spark):
    from rillet.functions.text import java_string_hash
    texts = ["\U0001F600", "a\U0001F600b\uffff", "", "é\n漢"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = routing.map_line_length(df).select("*", java_string_hash("value").alias("h"), poly_hash("value").alias("p"))
    for r in got.collect():
        assert r.len == len(units(r.value))
        assert r.h == int32(folded(r.value, 31, 0xFFFFFFFF)) and r.p == folded(r.value, 61, (1 << 29) - 1)
    assert int32(folded("\U0001F600", 31, 0xFFFFFFFF)) == 1772899


def test_udtf_split(spark):
    out = split_pieces(sensor(spark).select("arr", "id"), "id", "_")
    got = sorted(rows(out, "word", "length"))
    assert len(got) == 16
    assert got.count(("probe", 5)) == 8 and got.count(("2", 1)) == 4 and got.count(("20", 2)) == 1


def test_python_udtf_matches_native(spark):
    from rillet.functions.udfs import register_split_udtf
    register_split_udtf(spark, "_")
    sensor(spark).createOrReplaceTempView("sensor_fx")
    got = spark.sql("SELECT id, word, length FROM sensor_fx, LATERAL split_udtf(id)").collect()
    assert len(got) == 16


def test_sink_latest_by_key(spark):
    out = sensor(spark).groupBy("id").agg(F.max_by("temperature", "arr").alias("t"))
    assert {(r.id, r.t) for r in out.collect()} == {("probe_2", 26.75), ("probe_9", 44.0),
                                                     ("probe_20", 30.5), ("probe_4", 12.0)}


def test_table_select_where(spark):
    out = sensor(spark).select("id", "temperature").where("id = 'probe_9'")
    assert sorted(rows(out, "id", "temperature")) == [("probe_9", 44.0), ("probe_9", 48.25)]


def test_word_count_lines(spark):
    lines = spark.createDataFrame([(v,) for v in TEXT_LINES], "value string")
    got = {r.word: r.cnt for r in running.word_count(lines).collect()}
    assert got == {"red": 2, "blue": 3, "green": 1, "one": 1, "two": 1, "": 1}


@pytest.mark.parametrize("text,expected", [("", [""]), ("a b ", ["a", "b"]), ("a  b", ["a", "", "b"]),
                                           (" ", []), ("a b \n", ["a", "b", "\n"])])
def test_java_split_edges(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(java_split("s", " ").alias("p")).first().p == expected


@pytest.mark.parametrize("url,kept", [("/a.css", False), ("/c.js", False), ("/a.css?x", True),
                                      ("/b.jsx", True), ("/x.png/", True)])
def test_static_asset_filter(spark, url, kept):
    df = spark.createDataFrame([(url, "GET")], "url string, method string")
    assert (routing.filter_static_assets(df).count() == 1) == kept


def test_poly_hash_offsets(spark):
    texts = ["149", "9223372036854775807", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r.h for r in df.select(poly_hash("s").alias("h")).collect()] == [
        folded(t, 61, (1 << 29) - 1) for t in texts]


def test_late_sequence(spark):
    base = 1699999995
    seq = [("sensor_1", 4, 21.0), ("sensor_6", 6, 18.5), ("sensor_1", 12, 22.5), ("sensor_1", 40, 20.0),
           ("sensor_1", 5, 1.0), ("sensor_1", 41, 50.0), ("sensor_9", 90, 1.0), ("sensor_9", 190, 1.0)]
    df = (spark.createDataFrame([(i, s, base + o, t) for i, (s, o, t) in enumerate(seq)],
                                "arr bigint, id string, ts_sec bigint, temperature double")
          .withColumn("ts", F.timestamp_seconds("ts_sec").cast("timestamp_ntz")))
    st = late.classify_lateness(df, "ts", ["arr"], "5 seconds", "2 seconds", "0 seconds")
    row = st.where("arr = 4").first()
    assert row.wm_us == (base + 38) * 1_000_000 and row.status == "late"
    st15 = late.classify_lateness(df, "ts", ["arr"], "15 seconds", "2 seconds", "0 seconds")
    assert st15.where("arr = 4").first().status == "late"
    st_l = late.classify_lateness(df, "ts", ["arr"], "5 seconds", "2 seconds", "1 minute")
    assert st_l.where("arr = 4").first().status == "late_accepted"
    fires = late.lateness_firings_min_by(df, "id", "ts", ["arr"], "temperature",
                                         "5 seconds", "2 seconds", "1 minute")
    w = fires.where("id = 'sensor_1' AND fire_seq = 1").collect()
    # window [5, 10) of sensor_1 held no on-time row; the late row alone fires it
    zero = fires.where("id = 'sensor_1'").collect()
    assert any(r.min_value == 1.0 and r.fire_seq == 0 and r.cnt == 1 for r in zero)
    assert w == []
    kept, lost = late.late_split(df, "ts", ["arr"], "5 seconds", "2 seconds", "1 minute")
    assert kept.count() + lost.count() == df.count()


def test_from_collection(spark):
    from rillet.sources.files import from_collection
    from rillet.schemas import SENSOR_READING
    readings = from_collection(spark, [("probe_2", 1700000004, 21.5), ("probe_9", 1700000006, 48.25),
                                       ("probe_4", 1700000033, 12.0), (None, None, None)],
                               SENSOR_READING)
    ints = from_collection(spark, [(3,), (5,), (8,), (13,)], "value int")
    assert readings.count() == 4 and [r.value for r in ints.collect()] == [3, 5, 8, 13]


def test_text_and_csv_table_round_trip(spark, tmp_path):
    from rillet.sources.files import read_csv_table, read_text
    from rillet.schemas import SENSOR_READING
    from tests.fixtures import SENSOR_LINES
    p = tmp_path / "readings.csv"
    p.write_text("\n".join(SENSOR_LINES) + "\n")
    assert [r.value for r in read_text(spark, str(p)).collect()] == SENSOR_LINES
    t = read_csv_table(spark, str(p), SENSOR_READING, view="inputTable")
    got = spark.sql("SELECT id, count(id) AS cnt, avg(ts_sec) AS a FROM inputTable GROUP BY id").collect()
    assert {r.id: r.cnt for r in got} == {"probe_2": 4, "probe_9": 2, "probe_20": 1, "probe_4": 1}
    assert t.count() == 8


def test_access_log_parse(spark):
    from rillet.sources.files import parse_access_log
    lines = spark.createDataFrame([("10.0.0.1 - - 17/05/2015:10:05:03 +0000 GET /blog/post.html",),
                                   ("10.0.0.2 - - 17/05/2015:10:05:04 +0000 GET /style.css",)], "value string")
    got = parse_access_log(lines).collect()
    assert got[0].ip == "10.0.0.1" and got[0].url == "/blog/post.html" and got[1].method == "GET"
    assert got[0].ts == dt.datetime(2015, 5, 17, 10, 5, 3)


def test_kafka_codec_round_trip(spark):
    from rillet.sources.kafka import kafka_csv_decode, kafka_csv_encode
    enc = kafka_csv_encode(sensor(spark), ["id", "ts_sec", "temperature"], key="id")
    dec = kafka_csv_decode(enc)
    assert sorted(rows(dec, "id", "ts_sec", "temperature")) == sorted(
        rows(sensor(spark), "id", "ts_sec", "temperature"))


@pytest.mark.parametrize("value,matches", [("sensor_6", [6]), ("sensor_06", []), ("sensor_x", []),
                                           ("sensor_0", [0]), ("sensor_-3", [-3])])
def test_sensor_id_predicate_is_exact(spark, value, matches):
    from rillet.sources.tables import sensor_from_events, sensor_id_equals
    ev = spark.createDataFrame([(i, 0, u, "view", 1.0, '{"k": 1}') for i, u in enumerate([0, 6, 60, -3, 6])],
                               "event_id bigint, ts bigint, user_id bigint, event_type string, value double, "
                               "props string").withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz"))
    pushed = sorted(r.arr for r in sensor_from_events(ev.where(sensor_id_equals(value))).collect())
    derived = sorted(r.arr for r in sensor_from_events(ev).where(F.col("id") == value).collect())
    assert pushed == derived
    assert sorted({u for u in [0, 6, 60, -3, 6] if u in matches}) == sorted(set(matches))


def test_hot_pages_method_and_asset_filters(spark):
    from rillet.plans import jobs
    rows = [("10.0.0.1", "u1", dt.datetime(2015, 5, 17, 10, 5, 3), "GET", "/blog/post.html"),
            ("10.0.0.2", "u2", dt.datetime(2015, 5, 17, 10, 5, 4), "GET", "/style.css"),
            ("10.0.0.3", "u3", dt.datetime(2015, 5, 17, 10, 5, 5), "POST", "/blog/post.html"),
            ("10.0.0.4", "u4", dt.datetime(2015, 5, 17, 10, 5, 6), "GET", "/index.html")]
    log = spark.createDataFrame(rows, "ip string, user_id string, ts timestamp_ntz, method string, url string")
    window_end = dt.datetime(2015, 5, 17, 10, 5, 10)
    all_methods = {(r.url, r.cnt, r.rn) for r in jobs.hot_pages(log).where(F.col("window_end") == window_end).collect()}
    assert all_methods == {("/blog/post.html", 2, 1), ("/index.html", 1, 2)}
    gets = {(r.url, r.cnt) for r in jobs.hot_pages(log, method="GET").where(F.col("window_end") == window_end).collect()}
    assert gets == {("/blog/post.html", 1), ("/index.html", 1)}
