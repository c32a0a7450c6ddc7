"""The analysis jobs, composed from the operators.

* hot items: views -> sliding 1 h / 5 min count per item -> top 5 per window
* hot pages: access log -> drop static assets -> 10 min / 5 s count per url -> top 3
* page views: hourly count of views, plain and salted two-stage
* unique visitors: hourly distinct visitors (bitmap, exact, approximate, running)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.operators.distinct import uv_approx, uv_bitmap, uv_exact, uv_running
from rillet.operators.late import late_split, refired_top_n
from rillet.operators.ranking import sliding_top_n, top_n, top_n_retract, topn_report
from rillet.operators.routing import filter_static_assets
from rillet.operators.windows import hop, hop_count_panes
from rillet.session import scratch_path

VIEW = "view"

# Parameters of the analyses being rebuilt.
HOT_ITEMS_N = 5
HOT_ITEMS_SIZE = "1 hour"
HOT_ITEMS_SLIDE = "5 minutes"
HOT_PAGES_N = 3
HOT_PAGES_SIZE = "10 minutes"
HOT_PAGES_SLIDE = "5 seconds"
HOT_PAGES_LATENESS = "1 minute"
PAGE_VIEW_WINDOW = "1 hour"
PAGE_VIEW_SALTS = 10
VISITOR_WINDOW = "1 hour"
SENSOR_TUMBLE = "15 seconds"
SENSOR_MIN_BY_WINDOW = "5 seconds"
SENSOR_TABLE_WINDOW = "10 seconds"
SENSOR_SESSION_GAP = "15 seconds"
SENSOR_BOUND = "2 seconds"
SENSOR_LATENESS = "1 minute"
COUNT_WINDOW_SIZE = 10
COUNT_WINDOW_SLIDE = 2
JUMP_THRESHOLD = 10.0
HIGH_TEMPERATURE = 30
HASH_CODE_FACTOR = 23
SPLIT_SEPARATOR = "_"


def item_view_counts(behavior: DataFrame, behavior_value: str = VIEW, size: str = HOT_ITEMS_SIZE,
                     slide: str = HOT_ITEMS_SLIDE, panes: bool = True) -> DataFrame:
    """(item_id, window_start, window_end, cnt) for the chosen behaviour.

    ``panes`` (default) counts per 5-minute pane first and expands only the
    pane counts; ``panes=False`` is the plain sliding ``window()`` grouping.
    """
    views = behavior.where(F.col("behavior") == behavior_value).select("item_id", "ts")
    if panes:
        return hop_count_panes(views, ["item_id"], "ts", size, slide)
    return hop(views, ["item_id"], "ts", size, slide, [F.count(F.lit(1)).alias("cnt")])


def hot_items(behavior: DataFrame, n: int = HOT_ITEMS_N, behavior_value: str = VIEW,
              size: str = HOT_ITEMS_SIZE, slide: str = HOT_ITEMS_SLIDE, panes: bool = True) -> DataFrame:
    """Top n items per sliding window (count desc, item id asc)."""
    if panes:
        views = behavior.where(F.col("behavior") == behavior_value).select("item_id", "ts")
        return sliding_top_n(views, "item_id", "ts", size, slide, n)
    counts = item_view_counts(behavior, behavior_value, size, slide, panes)
    ranked = top_n(counts, ["window_end"], [F.desc("cnt"), F.asc("item_id")], n, "rn")
    return ranked.select("item_id", "window_end", "cnt", "rn")


def hot_items_sql(behavior: DataFrame, n: int = HOT_ITEMS_N, behavior_value: str = VIEW) -> DataFrame:
    """The same job as one SQL statement (sliding window in GROUP BY)."""
    spark = behavior.sparkSession
    return spark.sql(
        """
        SELECT item_id, window_end, cnt, rn FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rn
          FROM (
            SELECT item_id, window.end AS window_end, count(item_id) AS cnt
            FROM {data_table}
            WHERE behavior = :behavior
            GROUP BY item_id, window(ts, :size, :slide)))
        WHERE rn <= :n
        """, args={"behavior": behavior_value, "n": n, "size": HOT_ITEMS_SIZE, "slide": HOT_ITEMS_SLIDE},
        data_table=behavior)


def hot_items_sql_panes(behavior: DataFrame, n: int = HOT_ITEMS_N, behavior_value: str = VIEW) -> DataFrame:
    """The pane formulation as one SQL statement: per-(item, pane) counts,
    a REPARTITION hint that spreads them before the 12x expansion, window ends
    from ``sequence``, sums spread by (item, window end), and a ranking of which
    each task sends its own first n rows only.  Same result as
    :func:`hot_items_sql` without expanding raw rows.
    """
    from rillet.operators.windows import duration_us

    spark = behavior.sparkSession
    size_us, slide_us = duration_us(HOT_ITEMS_SIZE), duration_us(HOT_ITEMS_SLIDE)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # slide divides size here, so the pane is the slide
    return spark.sql(
        f"""
        WITH panes AS (
          SELECT item_id, floor(unix_micros(CAST(ts AS TIMESTAMP)) / {slide_us}) * {slide_us} AS pane,
                 count(*) AS n
          FROM {{data_table}} WHERE behavior = :behavior GROUP BY 1, 2),
        ends AS (
          SELECT item_id, n, explode(sequence(pane + {slide_us}, pane + {size_us}, {slide_us})) AS e
          FROM (SELECT /*+ REPARTITION({parts}) */ * FROM panes)),
        counts AS (
          SELECT item_id, e, sum(n) AS cnt FROM ends GROUP BY item_id, e)
        SELECT item_id, CAST(timestamp_micros(e) AS TIMESTAMP_NTZ) AS window_end, cnt, rn FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY e ORDER BY cnt DESC, item_id) AS rn FROM counts)
        WHERE rn <= :n
        """, args={"behavior": behavior_value, "n": n}, data_table=behavior)


def hot_items_retract(behavior: DataFrame, n: int = HOT_ITEMS_N, behavior_value: str = VIEW) -> DataFrame:
    """The ranking as a retract stream: what the top ``n`` of each window changes as
    the window's item counts arrive (in item order)."""
    counts = item_view_counts(behavior, behavior_value).select("item_id", "window_end", "cnt")
    return top_n_retract(counts, "window_end", "item_id", "cnt", n)


def hot_items_report(behavior: DataFrame, n: int = HOT_ITEMS_N, behavior_value: str = VIEW) -> DataFrame:
    """One text block per window: header with the window end, then 'NO i: ...' lines."""
    ranked = hot_items(behavior, n, behavior_value)
    line = F.format_string("NO %d: item_id = %d count = %d", F.col("rn"), F.col("item_id"), F.col("cnt"))
    header = F.concat(F.lit("window end: "), F.date_format("window_end", "yyyy-MM-dd HH:mm:ss"))
    return topn_report(ranked, "window_end", "rn", line, header, "====")


def page_view_counts(log: DataFrame, size: str = HOT_PAGES_SIZE, slide: str = HOT_PAGES_SLIDE,
                     method: str | None = None, panes: bool = True) -> DataFrame:
    pages = filter_static_assets(log, "url", method).select("url", "ts")
    if panes:
        return hop_count_panes(pages, ["url"], "ts", size, slide)
    return hop(pages, ["url"], "ts", size, slide, [F.count(F.lit(1)).alias("cnt")])


def hot_pages(log: DataFrame, n: int = HOT_PAGES_N, size: str = HOT_PAGES_SIZE, slide: str = HOT_PAGES_SLIDE,
              method: str | None = None, panes: bool = True) -> DataFrame:
    """Top n urls per sliding window after the static-asset filter."""
    if panes:
        pages = filter_static_assets(log, "url", method).select("url", "ts")
        return sliding_top_n(pages, "url", "ts", size, slide, n)
    counts = page_view_counts(log, size, slide, method, panes)
    ranked = top_n(counts, ["window_end"], [F.desc("cnt"), F.asc("url")], n, "rn")
    return ranked.select("url", "window_end", "cnt", "rn")


def hot_pages_with_lateness(log: DataFrame, arrival: list, bound: str, n: int = HOT_PAGES_N,
                            lateness: str = HOT_PAGES_LATENESS) -> tuple[DataFrame, DataFrame]:
    """(top n urls per window of the rows that are not late, the late rows).

    A row is late when even the last sliding window that holds it is past by
    more than ``lateness`` as the row arrives (``arrival``: columns of the
    arrival order).
    """
    pages = filter_static_assets(log, "url")
    kept, gone = late_split(pages, "ts", arrival, HOT_PAGES_SIZE, bound, lateness, slide=HOT_PAGES_SLIDE,
                            path=scratch_path(log.sparkSession, "pages-tagged"))
    top = sliding_top_n(kept.select("url", "ts"), "url", "ts", HOT_PAGES_SIZE, HOT_PAGES_SLIDE, n)
    return top, gone


def hot_pages_refired(log: DataFrame, arrival: list, bound: str, n: int = HOT_PAGES_N,
                      lateness: str = HOT_PAGES_LATENESS) -> DataFrame:
    """Top n urls of every window as it first fires and as late rows leave it at last."""
    pages = filter_static_assets(log, "url")
    return refired_top_n(pages, "url", "ts", arrival, HOT_PAGES_SIZE, HOT_PAGES_SLIDE, bound, lateness, n)


def pv_count(behavior: DataFrame, behavior_value: str = VIEW, size: str = PAGE_VIEW_WINDOW) -> DataFrame:
    """Total views per tumbling window: ('pv', window_end, cnt)."""
    return (behavior.where(F.col("behavior") == behavior_value)
                    .groupBy(F.window("ts", size).end.alias("window_end"))
                    .agg(F.count(F.lit(1)).alias("cnt"))
                    .select(F.lit("pv").alias("label"), "window_end", "cnt"))


def pv_count_salted(behavior: DataFrame, behavior_value: str = VIEW, size: str = PAGE_VIEW_WINDOW,
                    salts: int = PAGE_VIEW_SALTS, salt_on: str = "arr") -> DataFrame:
    """Two-stage count: per (salt, window), then summed per window.

    The salt is a hash of the arrival id rather than a random number, so a
    recomputed task after an executor loss assigns the same salts.
    """
    salted = (behavior.where(F.col("behavior") == behavior_value)
                      .select(F.pmod(F.xxhash64(salt_on), F.lit(salts)).alias("salt"),
                              F.window("ts", size).end.alias("window_end")))
    per_salt = salted.groupBy("salt", "window_end").agg(F.count(F.lit(1)).alias("cnt"))
    return (per_salt.groupBy("window_end").agg(F.sum("cnt").alias("cnt"))
                    .select(F.lit("pv").alias("label"), "window_end", "cnt"))


def unique_visitors(behavior: DataFrame, behavior_value: str = VIEW, how: str = "bitmap",
                    size: str = VISITOR_WINDOW) -> DataFrame:
    views = behavior.where(F.col("behavior") == behavior_value)
    if how == "bitmap":
        return uv_bitmap(views, "ts", "user_id", size)
    if how == "exact":
        return uv_exact(views, "ts", "user_id", size)
    if how == "running":
        return uv_running(views, "ts", "user_id", "arr", size)
    if how == "approx":
        return uv_approx(views, "ts", "user_id", size)
    raise ValueError(how)


def hot_pages_report(log: DataFrame, n: int = HOT_PAGES_N) -> DataFrame:
    """One text block per window for the hot pages."""
    ranked = hot_pages(log, n)
    line = F.format_string("NO %d: url = %s count = %d", F.col("rn"), F.col("url"), F.col("cnt"))
    header = F.concat(F.lit("window end: "), F.date_format("window_end", "yyyy-MM-dd HH:mm:ss"))
    return topn_report(ranked, "window_end", "rn", line, header, "====")
