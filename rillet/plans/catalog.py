"""Registered queries over the parquet tables, each with an equivalent SQL text.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE_SQL[name]`` is
the same computation in plain SQL (DuckDB dialect) over the tables
registered as views.  Queries without an SQL text are checked by row count
and by brute-force unit tests instead.

Every query reads whole tables.  Derived record types come from the
adapters in :mod:`rillet.sources.tables`:

* sensor readings: ``events`` with id ``'sensor_' || user_id``, temperature = value
* user behaviour: ``events`` with item id ``props.k``
* access log: ``events`` joined to ``pages`` on ``page_id = props.k mod #pages``
* text lines: ``documents.text``
* late data: ``events`` re-sequenced by arrival time ``ts + (event_id*7919 mod 43200) s``
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.aggregates import Course, Mean, aggregate_by
from rillet.functions.numeric import fixed_digits
from rillet.functions.text import java_split_sql, poly_hash, register_sql_functions, scaled_hash_code
from rillet.functions.udfs import avg_temp, avg_temp_sql, split_pieces
from rillet.operators import late, routing, running
from rillet.operators.scan import chunk_by
from rillet.operators.windows import count_window, duration_us, hop, session, tumble
from rillet.plans import jobs
from rillet.session import scratch_path
from rillet.sources import files, kafka, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

AVG_DIGITS = 10
# Averages are taken over the readings as they are; only the result is rounded
# (half up on the binary value), far above what the order of summation changes.

# Parameters of the registered window queries.  Events of the tables lie about
# four minutes apart and a user's some hours, so windows here are wide enough
# to hold several rows; the library's defaults are the analyses' own seconds.
TUMBLE, MIN_BY_WINDOW, TABLE_WINDOW, SESSION_GAP = "1 day", "1 day", "12 hours", "6 hours"
LATE_WINDOW, LATE_BOUND, LATENESS = "2 hours", "10 minutes", "6 hours"
PAGE_BOUND = "1 second"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- adapters

def _events(spark, d):
    return tables.load_table(spark, d, "events")


def _sensor(spark, d):
    return tables.sensor_from_events(_events(spark, d))


def _behavior(spark, d):
    return tables.behavior_from_events(_events(spark, d))


def _sensor_where_id(spark, d, value):
    """Sensor rows with ``id = value``, filtered on the stored column so the
    predicate reaches the parquet scan (``id`` itself is derived)."""
    return tables.sensor_from_events(_events(spark, d).where(tables.sensor_id_equals(value)))


def _access(spark, d):
    return tables.access_log_from_events(_events(spark, d), tables.load_table(spark, d, "pages"))


def _doc_lines(spark, d):
    docs = tables.load_table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "value"))


def _arrival(df):
    """Disordered but fixed arrival time for late-data queries: up to 12 hours."""
    delay_us = F.pmod(F.col("arr") * F.lit(7919), F.lit(43_200)) * F.lit(1_000_000)
    return df.withColumn("arrival_us", F.unix_micros(F.col("ts").cast("timestamp")) + delay_us)


def _r(c):
    return fixed_digits(c, AVG_DIGITS)


SENSOR = ("sensor AS (SELECT event_id AS arr, 'sensor_' || CAST(user_id AS VARCHAR) AS id, ts, "
          "epoch_us(ts) // 1000000 AS ts_sec, value AS temperature FROM events)")
BEHAVIOR = ("behavior AS (SELECT event_id AS arr, user_id, "
            "CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, "
            "CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) // 10 AS INTEGER) AS category_id, "
            "event_type AS behavior, ts, epoch_us(ts) // 1000000 AS ts_sec FROM events)")
ACCESS = ("access AS (SELECT e.event_id AS arr, "
          "'10.' || CAST((e.user_id // 65536) % 256 AS VARCHAR) || '.' || "
          "CAST((e.user_id // 256) % 256 AS VARCHAR) || '.' || CAST(e.user_id % 256 AS VARCHAR) AS ip, "
          "CAST(e.user_id AS VARCHAR) AS user_id, e.ts, "
          "CASE WHEN e.event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END AS method, p.url "
          "FROM events e LEFT JOIN (SELECT url, row_number() OVER (ORDER BY page_id, url) - 1 AS place "
          "FROM pages WHERE page_id IS NOT NULL) p ON p.place = "
          "CAST(json_extract_string(e.props, '$.k') AS BIGINT) % "
          "(SELECT count(*) FROM pages WHERE page_id IS NOT NULL))")
LINES = ("lines AS (SELECT arr, id || ',' || CAST(ts_sec AS VARCHAR) || ',' || "
         "CAST(temperature AS VARCHAR) AS value FROM sensor)")
DOC_LINES = ("doc_lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents)")
POLY = ("list_reduce(list_prepend(0::BIGINT, list_transform(string_split({x}, ''), "
        "lambda c: unicode(c)::BIGINT)), lambda h, c: (h * 61 + c) & 536870911)")
JHASH = ("list_reduce(list_prepend(0::BIGINT, list_transform(string_split({x}, ''), "
         "lambda c: unicode(c)::BIGINT)), lambda h, c: (h * 31 + c) & 4294967295)")


def _jsplit_sql(x: str, sep: str) -> str:
    """Java split on a literal single-character separator, in SQL."""
    esc = "\\" + sep if sep in ".^$|?*+()[]{}\\" else sep
    return (f"CASE WHEN {x} = '' THEN [''] "
            f"WHEN regexp_replace({x}, '(?:{esc})+\\z', '') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(regexp_replace({x}, '(?:{esc})+\\z', ''), '{sep}') END")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------- sources and sinks

@query("src_text", _with(DOC_LINES) + "SELECT value FROM doc_lines")
def q_src_text(spark, d):
    docs = tables.load_table(spark, d, "documents").select("text")
    path = scratch_path(spark, "src_text")
    docs.write.mode("overwrite").text(path)
    return files.read_text(spark, path)


@query("src_csv_table", _with(SENSOR) + "SELECT id, ts_sec, temperature FROM sensor")
def q_src_csv_table(spark, d):
    path = scratch_path(spark, "src_csv_table")
    files.sink_csv(_sensor(spark, d).select("id", "ts_sec", "temperature"), path)
    table = files.read_csv_table(spark, path, files.SENSOR_SCHEMA)
    return spark.sql("SELECT id, ts_sec, temperature FROM {input_table}", input_table=table)


@query("sink_csv", _with(SENSOR) + "SELECT id, temperature FROM sensor WHERE id = 'sensor_6'")
def q_sink_csv(spark, d):
    path = scratch_path(spark, "sink_csv")
    out = _sensor_where_id(spark, d, "sensor_6").select("id", "temperature")
    files.sink_csv(out, path)
    return files.read_csv_table(spark, path, "id STRING, temperature DOUBLE")


@query("parse_sensor_csv", _with(SENSOR) + "SELECT arr, id, ts_sec, temperature FROM sensor")
def q_parse_sensor_csv(spark, d):
    return files.parse_sensor_csv(files.sensor_lines(_sensor(spark, d)))


@query("parse_behavior_csv", _with(BEHAVIOR) +
       "SELECT arr, user_id, item_id, category_id, behavior, ts_sec FROM behavior")
def q_parse_behavior_csv(spark, d):
    return files.parse_behavior_csv(files.behavior_lines(_behavior(spark, d)))


@query("parse_access_log", _with(ACCESS) +
       "SELECT arr, ip, user_id, date_trunc('second', ts) AS ts, method, url FROM access")
def q_parse_access_log(spark, d):
    return files.parse_access_log(tables.access_log_lines(_access(spark, d)))


@query("kafka_csv_decode", _with(SENSOR) + "SELECT id AS key, id, ts_sec, temperature FROM sensor")
def q_kafka_csv_decode(spark, d):
    lines = files.sensor_lines(_sensor(spark, d), keep=("id",))
    records = lines.select(F.col("id").cast("binary").alias("key"),
                           F.col("value").cast("binary").alias("value"))
    out = kafka.kafka_csv_decode(records)
    return out.withColumn("key", F.col("key").cast("string"))


@query("kafka_csv_encode", _with(SENSOR) +
       "SELECT id AS key, id || ',' || CAST(temperature AS VARCHAR) AS value "
       "FROM sensor WHERE id = 'sensor_6'")
def q_kafka_csv_encode(spark, d):
    sensor = _sensor_where_id(spark, d, "sensor_6")
    rec = kafka.kafka_csv_encode(sensor, ["id", "temperature"], key="id")
    return rec.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query("sink_latest_by_key", _with(SENSOR) +
       "SELECT id, arg_max(temperature, arr) AS temperature FROM sensor GROUP BY id")
def q_sink_latest_by_key(spark, d):
    return (_sensor(spark, d).groupBy("id")
            .agg(F.max_by("temperature", "arr").alias("temperature")))


# ------------------------------------------------ projection and routing

@query("map_line_length", _with(SENSOR, LINES) + "SELECT arr, value, length(value) AS len FROM lines")
def q_map_line_length(spark, d):
    return routing.map_line_length(files.sensor_lines(_sensor(spark, d)))


@query("flatmap_fields", _with(SENSOR, LINES) +
       "SELECT arr, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS pos, unnest(parts) AS field "
       "FROM (SELECT arr, " + _jsplit_sql("value", ",") + " AS parts FROM lines)")
def q_flatmap_fields(spark, d):
    return routing.flatmap_fields(files.sensor_lines(_sensor(spark, d)))


@query("filter_prefix", _with(SENSOR, LINES) + "SELECT arr, value FROM lines WHERE starts_with(value, 'sensor_1')")
def q_filter_prefix(spark, d):
    return routing.filter_prefix(files.sensor_lines(_sensor(spark, d)), "sensor_1")


@query("filter_behavior", _with(BEHAVIOR) +
       "SELECT arr, user_id, item_id, ts FROM behavior WHERE behavior = 'view'")
def q_filter_behavior(spark, d):
    return routing.filter_equals(_behavior(spark, d), "behavior", "view").select(
        "arr", "user_id", "item_id", "ts")


@query("filter_static_assets", _with(ACCESS) +
       "SELECT arr, url, method FROM (SELECT arr, method, url || "
       "(['', '.css', '', '.js', '.png', '', '.ico', '.css?v=1'])[1 + arr % 8] AS url FROM access) "
       "WHERE NOT regexp_matches(url, '\\.(css|js|png|ico)$')")
def q_filter_static_assets(spark, d):
    """Urls of every eighth arrival, give or take, end like static assets."""
    ends = F.array(*(F.lit(x) for x in ("", ".css", "", ".js", ".png", "", ".ico", ".css?v=1")))
    log = _access(spark, d)
    log = log.withColumn("url", F.concat("url", F.get(ends, (F.col("arr") % 8).cast("int"))))
    return routing.filter_static_assets(log).select("arr", "url", "method")


@query("table_select_where", _with(SENSOR) + "SELECT id, temperature FROM sensor WHERE id = 'sensor_6'")
def q_table_select_where(spark, d):
    return _sensor_where_id(spark, d, "sensor_6").select("id", "temperature")


@query("sql_select_where", _with(SENSOR) +
       "SELECT arr, id, ts, ts_sec, temperature FROM sensor WHERE id = 'sensor_1'")
def q_sql_select_where(spark, d):
    return spark.sql("SELECT * FROM {sensor} WHERE id = 'sensor_1'", sensor=_sensor_where_id(spark, d, "sensor_1"))


@query("rename_fields", _with(SENSOR) + "SELECT id, ts_sec AS ts, temperature AS temp FROM sensor")
def q_rename_fields(spark, d):
    s = _sensor(spark, d)
    return s.select("id", F.col("ts_sec").alias("ts"), F.col("temperature").alias("temp"))


@query("split_route", _with(SENSOR) +
       "SELECT arr, id, temperature, CASE WHEN temperature > 30 THEN 'high' ELSE 'low' END AS route "
       "FROM sensor")
def q_split_route(spark, d):
    return routing.split_route(_sensor(spark, d), F.col("temperature") > jobs.HIGH_TEMPERATURE).select(
        "arr", "id", "temperature", "route")


@query("connect_map", _with(SENSOR) +
       "SELECT id, temperature, 'high temp warning' AS msg FROM sensor WHERE temperature > 30 "
       "UNION ALL SELECT id, NULL::DOUBLE AS temperature, 'normal' AS msg FROM sensor WHERE NOT temperature > 30")
def q_connect_map(spark, d):
    tagged = routing.split_route(_sensor(spark, d), F.col("temperature") > jobs.HIGH_TEMPERATURE)
    warn = routing.select_route(tagged, "high").select(
        "id", "temperature", F.lit("high temp warning").alias("msg"))
    normal = routing.select_route(tagged, "low").select("id", F.lit("normal").alias("msg"))
    return routing.connect_map(warn, normal)


@query("union_all", _with(SENSOR) +
       "SELECT arr, id, temperature FROM sensor WHERE temperature > 30 "
       "UNION ALL SELECT arr, id, temperature FROM sensor WHERE NOT temperature > 30 "
       "UNION ALL SELECT arr, id, temperature FROM sensor")
def q_union_all(spark, d):
    tagged = routing.split_route(_sensor(spark, d), F.col("temperature") > jobs.HIGH_TEMPERATURE)
    cols = ["arr", "id", "temperature"]
    return routing.union_all(routing.select_route(tagged, "high").select(*cols),
                             routing.select_route(tagged, "low").select(*cols),
                             routing.select_route(tagged, "high", "low").select(*cols))


@query("tag_partition", _with(SENSOR) + "SELECT arr, id, true AS in_range FROM sensor")
def q_tag_partition(spark, d):
    """Which task has a row depends on placement; that its index is one of the
    stage's tasks does not."""
    s = _sensor(spark, d).select("arr", "id")
    tagged = routing.tag_partition(s)
    return tagged.select("arr", "id", F.col("subtask").between(0, s.rdd.getNumPartitions() - 1).alias("in_range"))


@query("partition_setup", _with(SENSOR) + "SELECT arr, id, true AS in_range, true AS counted FROM sensor")
def q_partition_setup(spark, d):
    """Per-partition set-up and tear-down: a context made once per task numbers
    the task's rows."""
    s = _sensor(spark, d).select("arr", "id")
    parts = s.rdd.getNumPartitions()

    def each(context, frame):
        context["rows"] += len(frame)
        frame["in_range"] = 0 <= context["index"] < parts
        frame["counted"] = context["rows"] >= len(frame)
        return frame

    return routing.map_partitions_with_setup(
        s, lambda index: {"index": index, "rows": 0}, each, lambda context: context.clear(),
        "arr bigint, id string, in_range boolean, counted boolean")


@query("redistribute", _with(SENSOR) + "SELECT arr, id, temperature FROM sensor")
def q_redistribute(spark, d):
    return routing.redistribute(_sensor(spark, d).select("arr", "id", "temperature"))


# ------------------------------------------------------ running aggregates

@query("word_count", _with(
    "words AS (SELECT unnest(" + _jsplit_sql("text", " ") + ") AS word FROM documents)") +
    "SELECT word, count(*) AS cnt FROM words GROUP BY word")
def q_word_count(spark, d):
    docs = tables.load_table(spark, d, "documents").select(F.col("text").alias("value"))
    return running.word_count(docs)


@query("running_word_count", _with(
    "toks AS (SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS pos, "
    "unnest(parts) AS word FROM (SELECT doc_id, " + _jsplit_sql("text", " ") + " AS parts FROM documents))") +
    "SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM toks")
def q_running_word_count(spark, d):
    docs = tables.load_table(spark, d, "documents").select("doc_id", F.col("text").alias("value"))
    # most words are rare: the chunks are wide, or there are nearly as many totals as tokens
    return running.running_word_count(docs, "doc_id", chunk=chunk_by("doc_id", 4096))


@query("rolling_max_by", _with(SENSOR) +
       "SELECT a.id, a.arr, b.ts_sec AS max_ts_sec, b.temperature AS max_temperature FROM ("
       "SELECT id, arr, max({'t': temperature, 'n': -arr}) OVER (PARTITION BY id ORDER BY arr "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best FROM sensor) a "
       "JOIN sensor b ON b.arr = -a.best.n")
def q_rolling_max_by(spark, d):
    return running.rolling_max_by(_sensor(spark, d), "id", "arr", "temperature",
                                  ["ts_sec", "temperature"])


@query("rolling_reduce", _with(SENSOR) +
       "SELECT id, arr, ts_sec, max(temperature) OVER (PARTITION BY id ORDER BY arr "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_temperature FROM sensor")
def q_rolling_reduce(spark, d):
    return running.rolling_reduce(_sensor(spark, d), "id", "arr", "ts_sec", "temperature")


@query("keyed_running_count", _with(SENSOR) +
       "SELECT id, arr, count(*) OVER (PARTITION BY id ORDER BY arr "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM sensor")
def q_keyed_running_count(spark, d):
    return running.keyed_running_count(_sensor(spark, d), "id", "arr")


@query("global_running_count", _with(SENSOR) +
       "SELECT arr, count(*) OVER (ORDER BY arr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt "
       "FROM sensor")
def q_global_running_count(spark, d):
    return running.global_running_count(_sensor(spark, d), "arr")


@query("temp_jump_alert", _with(SENSOR) +
       "SELECT id, arr, last_value, temperature AS cur_value FROM (SELECT id, arr, temperature, "
       "lag(temperature) OVER (PARTITION BY id ORDER BY arr) AS last_value FROM sensor) "
       "WHERE last_value IS NOT NULL AND abs(temperature - last_value) >= 10.0")
def q_temp_jump_alert(spark, d):
    return running.temp_jump_alert(_sensor(spark, d), "id", "arr", "temperature", jobs.JUMP_THRESHOLD)


@query("group_count_avg", _with(SENSOR) +
       "SELECT id, count(id) AS cnt, (floor(sum(temperature) / count(temperature) "
       "* 10000000000 + 0.5) / 10000000000) AS avg_value FROM sensor GROUP BY id")
def q_group_count_avg(spark, d):
    out = running.group_count_avg(_sensor(spark, d), "id", "temperature")
    return out.withColumn("avg_value", _r(F.col("avg_value")))


@query("udaf_avg", _with(SENSOR) +
       "SELECT id, (floor(sum(temperature) / count(temperature) "
       "* 10000000000 + 0.5) / 10000000000) AS avg_temp FROM sensor GROUP BY id")
def q_udaf_avg(spark, d):
    return _sensor(spark, d).groupBy("id").agg(_r(avg_temp("temperature")).alias("avg_temp"))


@query("user_mean", ORACLE_SQL["udaf_avg"])
def q_user_mean(spark, d):
    """The mean as a user aggregate with an accumulator, partly summed up before the shuffle."""
    out = aggregate_by(_sensor(spark, d), ["id"], Mean("temperature"))
    return out.select("id", _r(F.col("mean")).alias("avg_temp"))


@query("user_course", _with(SENSOR, "there AS (SELECT * FROM sensor WHERE temperature IS NOT NULL)") +
       "SELECT s.id, s.n, t.first_at, t.last_at, t.rise, t.spread FROM "
       "(SELECT id, count(*) AS n FROM sensor GROUP BY id) s LEFT JOIN (SELECT id, min(arr) AS first_at, "
       "max(arr) AS last_at, arg_max(temperature, arr) - arg_min(temperature, arr) AS rise, "
       "max(temperature) - min(temperature) AS spread FROM there GROUP BY id) t ON t.id IS NOT DISTINCT FROM s.id")
def q_user_course(spark, d):
    """A user aggregate whose accumulator has several parts: first, last, lowest, highest."""
    return aggregate_by(_sensor(spark, d), ["id"], Course("arr", "temperature"))


@query("udaf_avg_sql", ORACLE_SQL["udaf_avg"])
def q_udaf_avg_sql(spark, d):
    """The aggregate function in SQL text, as an expression that Spark aggregates
    partially."""
    mean = avg_temp_sql("temperature")
    return spark.sql(f"SELECT id, floor({mean} * 10000000000 + 0.5) / 10000000000 AS avg_temp FROM {{sensor}} GROUP BY id",
                     sensor=_sensor(spark, d))


@query("retract_changelog", _with(
    SENSOR,
    "run AS (SELECT id, arr, count(id) OVER w AS cnt, "
    "(floor(sum(temperature) OVER w / nullif(count(temperature) OVER w, 0) "
    "* 10000000000 + 0.5) / 10000000000) AS avg_value FROM sensor "
    "WINDOW w AS (PARTITION BY id ORDER BY arr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))") +
    "SELECT true AS is_add, id, arr, cnt, avg_value FROM run UNION ALL "
    "SELECT false AS is_add, id, arr, prev_cnt AS cnt, prev_avg AS avg_value FROM ("
    "SELECT id, arr, lag(cnt) OVER (PARTITION BY id ORDER BY arr) AS prev_cnt, "
    "lag(avg_value) OVER (PARTITION BY id ORDER BY arr) AS prev_avg FROM run) WHERE prev_cnt IS NOT NULL")
def q_retract_changelog(spark, d):
    return running.retract_changelog(_sensor(spark, d), "id", "arr", "temperature", digits=AVG_DIGITS)


# ---------------------------------------------------------------- windows

def _tb(size: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{size}', {ts})"


@query("tumble_count", _with(SENSOR) +
       f"SELECT id, {_tb(TUMBLE)} AS window_start, {_tb(TUMBLE)} + INTERVAL '{TUMBLE}' "
       "AS window_end, count(*) AS cnt FROM sensor GROUP BY ALL")
def q_tumble_count(spark, d):
    return tumble(_sensor(spark, d), ["id"], "ts", TUMBLE, [F.count(F.lit(1)).alias("cnt")])


@query("tumble_count_full", _with(SENSOR) +
       f"SELECT id, {_tb(TUMBLE)} + INTERVAL '{TUMBLE}' AS window_end, count(*) AS size "
       "FROM sensor GROUP BY ALL")
def q_tumble_count_full(spark, d):
    out = tumble(_sensor(spark, d), ["id"], "ts", TUMBLE, [F.count(F.lit(1)).alias("size")])
    return out.select("id", "window_end", "size")


@query("count_window_avg", _with(SENSOR) +
       "SELECT id, seq, avg_value FROM (SELECT id, row_number() OVER (PARTITION BY id ORDER BY arr) AS seq, "
       "(floor(sum(temperature) OVER w / count(temperature) OVER w "
       "* 10000000000 + 0.5) / 10000000000) AS avg_value FROM sensor "
       "WINDOW w AS (PARTITION BY id ORDER BY arr ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) WHERE seq % 2 = 0")
def q_count_window_avg(spark, d):
    out = count_window(_sensor(spark, d), ["id"], "arr", "temperature", jobs.COUNT_WINDOW_SIZE,
                       jobs.COUNT_WINDOW_SLIDE)
    return out.withColumn("avg_value", _r(F.col("avg_value")))


@query("tumble_min_by", _with(SENSOR) +
       "SELECT id, window_end, temperature, ts_sec, arr FROM (SELECT id, "
       f"{_tb(MIN_BY_WINDOW)} + INTERVAL '{MIN_BY_WINDOW}' AS window_end, temperature, ts_sec, arr, "
       f"row_number() OVER (PARTITION BY id, {_tb(MIN_BY_WINDOW)} ORDER BY temperature, arr) AS rn "
       "FROM sensor) WHERE rn = 1")
def q_tumble_min_by(spark, d):
    rec = F.struct("temperature", "arr", "ts_sec")
    out = tumble(_sensor(spark, d), ["id"], "ts", MIN_BY_WINDOW, [F.min(rec).alias("m")])
    return out.select("id", "window_end", "m.temperature", "m.ts_sec", "m.arr")


@query("session_count", _with(
    SENSOR,
    "g AS (SELECT id, ts, CASE WHEN lag(ts) OVER (PARTITION BY id ORDER BY ts) IS NULL "
    f"OR ts - lag(ts) OVER (PARTITION BY id ORDER BY ts) > INTERVAL '{SESSION_GAP}' THEN 1 ELSE 0 END AS open "
    "FROM sensor)",
    "s AS (SELECT id, ts, sum(open) OVER (PARTITION BY id ORDER BY ts "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g)") +
    f"SELECT id, min(ts) AS window_start, max(ts) + INTERVAL '{SESSION_GAP}' AS window_end, count(*) AS cnt "
    "FROM s GROUP BY id, sid")
def q_session_count(spark, d):
    return session(_sensor(spark, d), ["id"], "ts", SESSION_GAP, [F.count(F.lit(1)).alias("cnt")])


@query("tumble_count_avg", _with(SENSOR) +
       f"SELECT id, {_tb(TABLE_WINDOW)} + INTERVAL '{TABLE_WINDOW}' AS window_end, count(id) AS cnt, "
       "(floor(sum(temperature) / count(temperature) "
       "* 10000000000 + 0.5) / 10000000000) AS avg_value FROM sensor GROUP BY ALL")
def q_tumble_count_avg(spark, d):
    out = tumble(_sensor(spark, d), ["id"], "ts", TABLE_WINDOW,
                 [F.count("id").alias("cnt"), _r(avg_temp("temperature")).alias("avg_value")])
    return out.select("id", "window_end", "cnt", "avg_value")


def _hop_sql(src: str, key: str, size: str, slide: str, n: int, where: str = "") -> str:
    return (f"SELECT {key}, {_tb(slide)} + (g.i + 1) * INTERVAL '{slide}' - INTERVAL '{size}' AS window_start, "
            f"{_tb(slide)} + (g.i + 1) * INTERVAL '{slide}' AS window_end, count(*) AS cnt "
            f"FROM {src} CROSS JOIN generate_series(0, {n - 1}) AS g(i) {where} GROUP BY ALL")


HOP_ITEMS = _hop_sql("behavior", "item_id", "5 minutes", "5 minutes", 12, "WHERE behavior = 'view'") \
    .replace("- INTERVAL '5 minutes' AS window_start", "- INTERVAL '1 hour' AS window_start")


@query("hop_count", _with(BEHAVIOR) + HOP_ITEMS)
def q_hop_count(spark, d):
    return jobs.item_view_counts(_behavior(spark, d), panes=False)


@query("hop_count_panes", _with(BEHAVIOR) + HOP_ITEMS)
def q_hop_count_panes(spark, d):
    return jobs.item_view_counts(_behavior(spark, d), panes=True)


@query("hop_count_sql", _with(BEHAVIOR) + HOP_ITEMS)
def q_hop_count_sql(spark, d):
    return spark.sql(
        "SELECT item_id, window.start AS window_start, window.end AS window_end, count(item_id) AS cnt "
        "FROM {data_table} WHERE behavior = 'view' GROUP BY item_id, window(ts, '1 hour', '5 minutes')",
        data_table=_behavior(spark, d))


HOP_PAGES = _hop_sql("access", "url", "10 minutes", "5 seconds", 120,
                     "WHERE NOT regexp_matches(url, '\\.(css|js|png|ico)$')")


@query("hop_page_count", _with(ACCESS) + HOP_PAGES)
def q_hop_page_count(spark, d):
    return jobs.page_view_counts(_access(spark, d), panes=True)


@query("pv_count", _with(BEHAVIOR) +
       f"SELECT 'pv' AS label, {_tb('1 hour')} + INTERVAL '1 hour' AS window_end, count(*) AS cnt "
       "FROM behavior WHERE behavior = 'view' GROUP BY ALL")
def q_pv_count(spark, d):
    return jobs.pv_count(_behavior(spark, d))


@query("pv_count_salted", ORACLE_SQL["pv_count"])
def q_pv_count_salted(spark, d):
    return jobs.pv_count_salted(_behavior(spark, d))


# ---------------------------------------------------------------- ranking

TOP_ITEMS = (_with(BEHAVIOR, "agg AS (" + HOP_ITEMS + ")") +
             "SELECT item_id, window_end, cnt, rn FROM (SELECT item_id, window_end, cnt, "
             "CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS INTEGER) AS rn "
             "FROM agg) WHERE rn <= 5")


@query("hot_items_topn", TOP_ITEMS)
def q_hot_items_topn(spark, d):
    return jobs.hot_items(_behavior(spark, d))


@query("hot_items_sql", TOP_ITEMS)
def q_hot_items_sql(spark, d):
    return jobs.hot_items_sql(_behavior(spark, d))


@query("hot_items_sql_panes", TOP_ITEMS)
def q_hot_items_sql_panes(spark, d):
    return jobs.hot_items_sql_panes(_behavior(spark, d))


@query("hot_items_retract", _with(
    BEHAVIOR, "agg AS (" + HOP_ITEMS + ")",
    "placed AS (SELECT a.item_id, a.window_end, a.cnt, 1 + count(b.item_id) AS place FROM agg a LEFT JOIN agg b "
    "ON b.window_end = a.window_end AND b.item_id < a.item_id AND b.cnt >= a.cnt GROUP BY ALL)",
    "entering AS (SELECT * FROM placed WHERE place <= 5)",
    "state AS (SELECT e.window_end, e.item_id AS cause, e.place, x.item_id, x.cnt, s.is_add, "
    "CAST(row_number() OVER (PARTITION BY e.window_end, e.item_id, s.is_add ORDER BY x.cnt DESC, x.item_id) "
    "AS INTEGER) AS rn FROM entering e CROSS JOIN (VALUES (true), (false)) s(is_add) JOIN entering x "
    "ON x.window_end = e.window_end AND (x.item_id < e.item_id OR (s.is_add AND x.item_id = e.item_id)))") +
    "SELECT window_end, cause, is_add, rn, item_id, cnt FROM state WHERE rn BETWEEN place AND 5")
def q_hot_items_retract(spark, d):
    return jobs.hot_items_retract(_behavior(spark, d))


@query("hot_pages_topn", _with(ACCESS, "agg AS (" + HOP_PAGES + ")") +
       "SELECT url, window_end, cnt, rn FROM (SELECT url, window_end, cnt, "
       "CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS rn "
       "FROM agg) WHERE rn <= 3")
def q_hot_pages_topn(spark, d):
    return jobs.hot_pages(_access(spark, d))


@query("topn_report", _with(BEHAVIOR, "agg AS (" + HOP_ITEMS + ")",
                            "top AS (SELECT * FROM (SELECT item_id, window_end, cnt, row_number() OVER "
                            "(PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rn FROM agg) WHERE rn <= 5)") +
       "SELECT window_end, 'window end: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10) || "
       "string_agg('NO ' || rn || ': item_id = ' || item_id || ' count = ' || cnt, chr(10) ORDER BY rn) "
       "|| chr(10) || '====' AS report FROM top GROUP BY window_end")
def q_topn_report(spark, d):
    return jobs.hot_items_report(_behavior(spark, d))


@query("hot_pages_report", _with(ACCESS, "agg AS (" + HOP_PAGES + ")",
                                 "top AS (SELECT * FROM (SELECT url, window_end, cnt, row_number() OVER "
                                 "(PARTITION BY window_end ORDER BY cnt DESC, url) AS rn FROM agg) WHERE rn <= 3)") +
       "SELECT window_end, 'window end: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10) || "
       "string_agg('NO ' || rn || ': url = ' || url || ' count = ' || cnt, chr(10) ORDER BY rn) "
       "|| chr(10) || '====' AS report FROM top GROUP BY window_end")
def q_hot_pages_report(spark, d):
    return jobs.hot_pages_report(_access(spark, d))


# ------------------------------------------------------- distinct visitors

@query("poly_hash", "SELECT c_custkey, " + POLY.format(x="c_name") + " AS name_offset, " +
       POLY.format(x="CAST(c_custkey AS VARCHAR)") + " AS key_offset FROM customer")
def q_poly_hash(spark, d):
    c = tables.load_table(spark, d, "customer")
    return c.select("c_custkey", poly_hash("c_name").alias("name_offset"),
                    poly_hash(F.col("c_custkey").cast("string")).alias("key_offset"))


UV_EXACT = (_with(BEHAVIOR) +
            f"SELECT 'uv' AS label, {_tb('1 hour')} + INTERVAL '1 hour' AS window_end, "
            "count(DISTINCT " + POLY.format(x="CAST(user_id AS VARCHAR)") + ") AS cnt "
            "FROM behavior WHERE behavior = 'view' GROUP BY ALL")


@query("uv_bitmap", UV_EXACT)
def q_uv_bitmap(spark, d):
    return jobs.unique_visitors(_behavior(spark, d), how="bitmap")


@query("uv_exact", _with(BEHAVIOR) +
       f"SELECT 'uv' AS label, {_tb('1 hour')} + INTERVAL '1 hour' AS window_end, "
       "count(DISTINCT user_id) AS cnt FROM behavior WHERE behavior = 'view' GROUP BY ALL")
def q_uv_exact(spark, d):
    return jobs.unique_visitors(_behavior(spark, d), how="exact")


@query("uv_running", _with(
    BEHAVIOR,
    f"f AS (SELECT {_tb('1 hour')} + INTERVAL '1 hour' AS window_end, "
    + POLY.format(x="CAST(user_id AS VARCHAR)") + " AS off, min(arr) AS arr "
    "FROM behavior WHERE behavior = 'view' GROUP BY ALL)") +
    "SELECT 'uv' AS label, window_end, arr, count(*) OVER (PARTITION BY window_end ORDER BY arr "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM f")
def q_uv_running(spark, d):
    return jobs.unique_visitors(_behavior(spark, d), how="running")


@query("uv_approx", _with(BEHAVIOR) + f"SELECT DISTINCT 'uv' AS label, {_tb('1 hour')} + INTERVAL '1 hour' "
       "AS window_end, true AS within_bound FROM behavior WHERE behavior = 'view'")
def q_uv_approx(spark, d):
    """HyperLogLog++ estimate per hour, and whether it lies within five standard
    errors (and one visitor) of the exact count."""
    b = _behavior(spark, d)
    exact = jobs.unique_visitors(b, how="exact").withColumnRenamed("cnt", "exact")
    close = F.abs(F.col("cnt") - F.col("exact")) <= 1 + 5 * 0.01 * F.col("exact")
    return (jobs.unique_visitors(b, how="approx").join(exact, ["label", "window_end"])
            .select("label", "window_end", close.alias("within_bound")))


# ------------------------------------------------------------- user functions

@query("udf_hash_code", "SELECT c_custkey, c_name, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 "
       "ELSE h END AS INTEGER) AS hash_code FROM (SELECT c_custkey, c_name, (" +
       JHASH.format(x="c_name") + " * 23) & 4294967295 AS h FROM customer)")
def q_udf_hash_code(spark, d):
    c = tables.load_table(spark, d, "customer")
    return c.select("c_custkey", "c_name", scaled_hash_code("c_name", jobs.HASH_CODE_FACTOR).alias("hash_code"))


@query("udf_hash_code_sql", ORACLE_SQL["udf_hash_code"])
def q_udf_hash_code_sql(spark, d):
    register_sql_functions(spark, jobs.HASH_CODE_FACTOR)
    return spark.sql("SELECT c_custkey, c_name, hash_code(c_name) AS hash_code FROM {customer}",
                     customer=tables.load_table(spark, d, "customer"))


@query("udtf_split", "SELECT p_partkey, p_type, word, CAST(length(word) AS INTEGER) AS length FROM "
       "(SELECT p_partkey, p_type, unnest(" + _jsplit_sql("p_type", " ") + ") AS word FROM part)")
def q_udtf_split(spark, d):
    return split_pieces(tables.load_table(spark, d, "part").select("p_partkey", "p_type"), "p_type", " ")


@query("udtf_split_sql", ORACLE_SQL["udtf_split"])
def q_udtf_split_sql(spark, d):
    """The table function joined laterally in SQL (native generator)."""
    return spark.sql(
        "SELECT p_partkey, p_type, word, length(word) AS length FROM {part} "
        "LATERAL VIEW explode(" + java_split_sql("p_type", " ") + ") pieces AS word",
        part=tables.load_table(spark, d, "part").select("p_partkey", "p_type"))


# ------------------------------------------------------------- late data

ARRIVAL = ("arrivals AS (SELECT *, epoch_us(ts) + ((arr * 7919) % 43200) * 1000000 AS arrival_us, "
           "epoch_us(ts) AS ts_us FROM sensor)")
WATERMARK = ("wm AS (SELECT *, max(ts_us) OVER (ORDER BY arrival_us, arr ROWS BETWEEN UNBOUNDED PRECEDING "
             "AND 1 PRECEDING) - {bound} AS wm_us FROM arrivals)")
STATUS = ("st AS (SELECT *, (ts_us // {slide}) * {slide} + {size} AS end_us, CASE "
          "WHEN wm_us IS NULL OR wm_us < (ts_us // {slide}) * {slide} + {size} - 1 THEN 'on_time' "
          "WHEN wm_us < (ts_us // {slide}) * {slide} + {size} - 1 + {late} THEN 'late_accepted' "
          "ELSE 'late' END AS status FROM wm)")


def _late_sql(size: str, bound: str, lateness: str, slide: str | None = None) -> tuple[str, str]:
    us = {"size": duration_us(size), "bound": duration_us(bound), "late": duration_us(lateness),
          "slide": duration_us(slide or size)}
    return WATERMARK.format(**us), STATUS.format(**us)


LATE_SQL = _late_sql(LATE_WINDOW, LATE_BOUND, LATENESS)


@query("running_watermark", _with(SENSOR, ARRIVAL, LATE_SQL[0]) + "SELECT arr, arrival_us, wm_us FROM wm")
def q_running_watermark(spark, d):
    s = _arrival(_sensor(spark, d))
    out = late.running_watermark(s, "ts", ["arrival_us", "arr"], LATE_BOUND)
    return out.select("arr", "arrival_us", "wm_us")


@query("late_split", _with(SENSOR, ARRIVAL, *LATE_SQL) + "SELECT arr, id, status FROM st")
def q_late_split(spark, d):
    """Both outputs of the split, each row with the side it went to."""
    s = _arrival(_sensor(spark, d))
    kept, gone = late.late_split(s.select("arr", "id", "ts", "arrival_us"), "ts", ["arrival_us", "arr"], LATE_WINDOW,
                                 LATE_BOUND, LATENESS, path=scratch_path(spark, "tagged"))
    return kept.select("arr", "id", "status").unionByName(gone.select("arr", "id", F.lit(late.LATE).alias("status")))


def _page_arrivals(spark, d):
    """The access log with the disorder of the late-data queries."""
    return _arrival(_access(spark, d))


PAGE_LATE_SQL = _late_sql(jobs.HOT_PAGES_SIZE, PAGE_BOUND, jobs.HOT_PAGES_LATENESS, jobs.HOT_PAGES_SLIDE)


@query("hot_pages_late", _with(ACCESS, ARRIVAL.replace("FROM sensor", "FROM access"), *PAGE_LATE_SQL) +
       "SELECT arr, url, ts FROM st WHERE status = 'late' AND NOT regexp_matches(url, '\\.(css|js|png|ico)$')")
def q_hot_pages_late(spark, d):
    """The late output of the hot-pages job: rows whose last sliding window is past."""
    return jobs.hot_pages_with_lateness(_page_arrivals(spark, d), ["arrival_us", "arr"], PAGE_BOUND)[1].select(
        "arr", "url", "ts")


@query("hot_pages_lateness", _with(
    ACCESS, ARRIVAL.replace("FROM sensor", "FROM access"), *PAGE_LATE_SQL,
    "kept AS (SELECT url, ts FROM st WHERE status <> 'late')",
    "agg AS (" + _hop_sql("kept", "url", "10 minutes", "5 seconds", 120,
                          "WHERE NOT regexp_matches(url, '\\.(css|js|png|ico)$')") + ")") +
       "SELECT url, window_end, cnt, rn FROM (SELECT url, window_end, cnt, "
       "CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS rn "
       "FROM agg) WHERE rn <= 3")
def q_hot_pages_lateness(spark, d):
    """The hot pages of the rows that are not late."""
    return jobs.hot_pages_with_lateness(_page_arrivals(spark, d), ["arrival_us", "arr"], PAGE_BOUND)[0]


_REFIRE = {"size": 600_000_000, "slide": 5_000_000, "late": duration_us(jobs.HOT_PAGES_LATENESS)}


@query("hot_pages_refired", _with(
    ACCESS, ARRIVAL.replace("FROM sensor", "FROM access"), PAGE_LATE_SQL[0],
    "wins AS (SELECT url, wm_us, (ts_us // {slide}) * {slide} + {size} - j * {slide} AS e FROM wm, range(0, 120) t(j) "
    "WHERE NOT regexp_matches(url, '\\.(css|js|png|ico)$'))".format(**_REFIRE),
    "takings AS (SELECT url, e, count(*) FILTER (wm_us IS NULL OR wm_us < e - 1) AS n_on, count(*) AS n FROM wins "
    "WHERE wm_us IS NULL OR wm_us < e - 1 + {late} GROUP BY url, e)".format(**_REFIRE),
    "both_ AS (SELECT url, e, 'first' AS firing, n_on AS cnt FROM takings WHERE n_on > 0 UNION ALL "
    "SELECT url, e, 'last', n FROM takings)") +
       "SELECT make_timestamp(e) AS window_end, firing, url, cnt, rn FROM (SELECT *, CAST(row_number() OVER "
       "(PARTITION BY e, firing ORDER BY cnt DESC, url) AS INTEGER) AS rn FROM both_) WHERE rn <= 3")
def q_hot_pages_refired(spark, d):
    """The hot pages of each window when it first fires, and after its last refiring."""
    return jobs.hot_pages_refired(_page_arrivals(spark, d), ["arrival_us", "arr"], PAGE_BOUND)


@query("allowed_lateness", _with(
    SENSOR, ARRIVAL, *LATE_SQL,
    "base AS (SELECT id, end_us, count(*) AS n0, min({'v': temperature, 'a': arr}) AS m0 FROM st "
    "WHERE status = 'on_time' GROUP BY id, end_us)",
    "acc AS (SELECT id, end_us, count(*) OVER w AS k, min({'v': temperature, 'a': arr}) OVER w AS m FROM st "
    "WHERE status = 'late_accepted' WINDOW w AS (PARTITION BY id, end_us ORDER BY arrival_us, arr "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
    "fires AS (SELECT id, end_us, 0::BIGINT AS fire_seq, n0 AS cnt, m0 AS m FROM base UNION ALL "
    "SELECT a.id, a.end_us, a.k - CASE WHEN b.n0 IS NULL THEN 1 ELSE 0 END, a.k + coalesce(b.n0, 0), "
    "CASE WHEN b.m0 IS NULL OR a.m < b.m0 THEN a.m ELSE b.m0 END "
    "FROM acc a LEFT JOIN base b ON a.id = b.id AND a.end_us = b.end_us)") +
    "SELECT id, make_timestamp(end_us) AS window_end, fire_seq, cnt, m.v AS min_value, m.a AS min_arr FROM fires")
def q_allowed_lateness(spark, d):
    s = _arrival(_sensor(spark, d))
    return late.lateness_firings_min_by(s, "id", "ts", ["arrival_us", "arr"], "temperature",
                                        LATE_WINDOW, LATE_BOUND, LATENESS)


# ------------------------------------------------------------- scale checks

@query("hop_page_count_panes", _with(ACCESS) + HOP_PAGES)
def q_hop_page_count_panes(spark, d):
    return jobs.page_view_counts(_access(spark, d), panes=True)


@query("hop_page_count_plain", _with(ACCESS) + HOP_PAGES)
def q_hop_page_count_plain(spark, d):
    """The plain ``window()`` grouping, which copies every raw row to its 120 windows: for comparison."""
    return jobs.page_view_counts(_access(spark, d), panes=False)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_hot_items_topn(spark, sf_dir)


__all__ = ["QUERIES", "ORACLE_SQL", "flagship", "hop", "tumble"]
