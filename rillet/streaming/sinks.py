"""``foreachBatch`` sinks: per-window ranking, late-row split, keyed upsert.

Every write is addressed by the micro-batch id and overwrites only that
batch's output, so a batch replayed after a failure rewrites the same files
instead of appending duplicates.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from rillet.operators.windows import duration_us
from rillet.operators.scan import DEFAULT_ARRIVAL_CHUNK, chunk_by, running_count
from rillet.session import delete_path, list_subdirs, path_exists


def _batch_path(root: str, batch_id: int) -> str:
    return os.path.join(root, f"batch_id={batch_id}")


def rank_windows_batch(n: int, key: str, out_path: str, count: str = "cnt", window_end: str = "window_end"):
    """foreachBatch function ranking the closed windows of an append-mode aggregate.

    In append mode all keys of a window are emitted in the same micro-batch
    (when the watermark passes the window end), so ranking inside the batch
    is exact.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        w = Window.partitionBy(window_end).orderBy(F.desc(count), F.asc(key))
        ranked = batch.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
        ranked.write.mode("overwrite").parquet(_batch_path(out_path, batch_id))
    return fn


def late_split_batch(ts: str, size: str, bound: str, lateness: str, kept_path: str,
                     late_path: str, state_path: str, slide: str | None = None):
    """foreachBatch function that separates late rows before any aggregate.

    The watermark of a batch is the max event time of all *earlier* batches
    minus ``bound``.  Each batch stores the running max through itself under
    its batch id (one row) and drops the states that no replay can need, so the
    folder holds two or three.  A row is late when the last instant of the last
    window that holds it (tumbling, or moving by ``slide``) plus ``lateness`` is
    not after that watermark; late rows are written to ``late_path`` instead of
    being silently dropped.
    """
    slide_us = duration_us(slide or size)
    size_us, bound_us, late_us = duration_us(size), duration_us(bound), duration_us(lateness)

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        us = F.unix_micros(F.col(ts).cast("timestamp"))
        earlier = sorted((int(d.split("=")[1]) for d in list_subdirs(spark, state_path)
                          if d.startswith("batch_id=")), reverse=True)
        earlier = [b for b in earlier if b < batch_id]
        prev_max = None
        if earlier:
            row = spark.read.parquet(os.path.join(state_path, f"batch_id={earlier[0]}")).first()
            prev_max = None if row is None else row.max_us
        wm = None if prev_max is None else prev_max - bound_us
        end = F.floor(us / slide_us) * slide_us + size_us
        late_cond = F.lit(False) if wm is None else (end - 1 + late_us <= F.lit(wm))
        tagged = batch.withColumn("_late", late_cond).cache()
        tagged.where(~F.col("_late")).drop("_late").write.mode("overwrite").parquet(
            _batch_path(kept_path, batch_id))
        tagged.where(F.col("_late")).drop("_late").write.mode("overwrite").parquet(
            _batch_path(late_path, batch_id))
        batch_max = tagged.agg(F.max(us).alias("m")).first().m
        cumulative = max(v for v in (prev_max, batch_max) if v is not None) \
            if (prev_max is not None or batch_max is not None) else None
        if cumulative is not None:
            spark.createDataFrame([(int(cumulative),)], "max_us bigint").write.mode("overwrite") \
                 .parquet(_batch_path(state_path, batch_id))
        tagged.unpersist()
        for old in earlier[1:]:
            delete_path(spark, os.path.join(state_path, f"batch_id={old}"))
    return fn


def upsert_batch(key: str, order: str, table_path: str, value_cols, buckets: int = 64):
    """foreachBatch function keeping the latest row per key in a bucketed table.

    The batch is reduced to its last row per key (by ``order``) and merged into
    the buckets of keys that it touches: their rows are written as version
    ``batch_id``, all other buckets stay as they are.  Readers take the highest
    version of each bucket.  Of a touched bucket the version it was made from is
    kept, so that a replayed batch finds it, and older ones are removed.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = batch.groupBy(key).agg(
            *[F.max_by(c, order).alias(c) for c in value_cols], F.max(order).alias(order)).withColumn(
            "bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).cache()
        touched = [r.bucket for r in latest.select("bucket").distinct().collect()]  # `buckets` at most
        before = _bucket_versions(spark, table_path, batch_id)
        used = {b: before[b][0] for b in touched if b in before}
        merged = latest
        if used:
            old = spark.read.parquet(*[_bucket_path(table_path, v, b) for b, v in used.items()])
            old = old.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
            merged = old.join(latest.select(key), key, "left_anti").unionByName(latest)
        (merged.write.mode("overwrite").partitionBy("bucket")
               .parquet(os.path.join(table_path, f"v={batch_id:012d}")))
        latest.unpersist()
        for b in used:
            for v in before[b][1:]:
                delete_path(spark, _bucket_path(table_path, v, b))
    return fn


def _bucket_path(table_path: str, version: str, bucket: int) -> str:
    return os.path.join(table_path, version, f"bucket={bucket}")


def _bucket_versions(spark: SparkSession, table_path: str, before: int | None = None) -> dict[int, list[str]]:
    """The versions of each bucket, newest first."""
    found: dict[int, list[str]] = {}
    for v in sorted((d for d in list_subdirs(spark, table_path) if d.startswith("v=")), reverse=True):
        if before is None or int(v[2:]) < before:
            for d in list_subdirs(spark, os.path.join(table_path, v)):
                if d.startswith("bucket="):
                    found.setdefault(int(d[7:]), []).append(v)
    return found


def read_latest_version(spark: SparkSession, table_path: str, before: int | None = None):
    """The table of :func:`upsert_batch`, or None before its first version."""
    newest = {b: v[0] for b, v in _bucket_versions(spark, table_path, before).items()}
    return spark.read.parquet(*[_bucket_path(table_path, v, b) for b, v in newest.items()]) if newest else None


def count_first_seen_batch(out_path: str, totals_path: str, label: str = "uv"):
    """foreachBatch function that numbers first-seen visitors per window.

    Rows (window_end, arr) of a batch are counted on from the totals that the
    batch before left, by a chunked scan, and written under the batch id; the
    totals, a row per window, are stored likewise.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = sorted((int(d.split("=")[1]) for d in list_subdirs(spark, totals_path)), reverse=True)
        earlier = [b for b in earlier if b < batch_id]
        totals = (spark.read.parquet(_batch_path(totals_path, earlier[0])) if earlier
                  else spark.createDataFrame([], "window_end timestamp, n bigint"))
        counted = running_count(batch.select("window_end", "arr"), ["window_end"], ["arr"],
                                chunk_by("arr", DEFAULT_ARRIVAL_CHUNK))
        (counted.join(totals, "window_end", "left")
                .select(F.lit(label).alias("label"), "window_end", "arr",
                        (F.col("cnt") + F.coalesce("n", F.lit(0))).alias("cnt"))
                .write.mode("overwrite").parquet(_batch_path(out_path, batch_id)))
        more = batch.groupBy("window_end").agg(F.count(F.lit(1)).alias("n"))
        (totals.unionByName(more).groupBy("window_end").agg(F.sum("n").alias("n"))
               .write.mode("overwrite").parquet(_batch_path(totals_path, batch_id)))
        for old in earlier[1:]:
            delete_path(spark, _batch_path(totals_path, old))
    return fn


def global_running_count_batch(order: str, out_path: str, totals_path: str, name: str = "cnt"):
    """foreachBatch function that numbers all rows of a stream, one after the other.

    The rows of a batch are numbered by a chunked scan in the order of ``order``, so
    no task sees them all, and on from the total that the batch before left, one
    stored row.  Nothing depends on the number of partitions, which may change from
    run to run.  A batch appears whole, after its total, and once.
    """
    from rillet.streaming.lateness import batch_dir, commit, stage

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if path_exists(spark, batch_dir(out_path, batch_id)):
            return
        stored = sorted((int(d.split("=")[1]) for d in list_subdirs(spark, totals_path)), reverse=True)
        stored = [b for b in stored if b < batch_id]
        base = spark.read.parquet(batch_dir(totals_path, stored[0])).first().n if stored else 0
        counted = running_count(batch, [], [order], chunk_by(order, DEFAULT_ARRIVAL_CHUNK), name)
        seen = Observation()
        staged = stage(counted.withColumn(name, F.col(name) + base).observe(seen, F.count(F.lit(1)).alias("n")),
                       out_path, batch_id)
        (spark.createDataFrame([(base + seen.get["n"],)], "n bigint").write.mode("overwrite")
         .parquet(batch_dir(totals_path, batch_id)))
        commit(spark, staged, out_path, batch_id)
        for old in stored[1:]:
            delete_path(spark, batch_dir(totals_path, old))
    return fn


def console(df: DataFrame, label: str | None = None, n: int = 20):
    """Print a batch DataFrame, or start a console sink for a streaming one."""
    if df.isStreaming:
        w = df.writeStream.format("console").option("truncate", "false").option("numRows", n)
        return w.queryName(label).start() if label else w.start()
    if label:
        print(label)
    df.show(n, truncate=False)
    return None
