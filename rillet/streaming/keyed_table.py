"""A keyed table that a stream keeps up to date: the latest row of every key.

Keys fall into buckets by the leading bits of their hash.  A micro-batch rewrites the
buckets that its keys touch and no others, and a bucket that grows beyond
``most`` rows is split by further bits when it is next written, so what a batch
writes follows its keys and not the table's size.

A version is a manifest, one row per bucket, that says where the bucket's rows
lie.  Rows are written first and the manifest appears last, in one step: a batch
that is killed leaves rows that no manifest names, and its replay begins again.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.session import delete_path, list_subdirs, path_exists
from rillet.streaming.lateness import batch_dir, commit, stage

#: Bits of the hash, and rows of a bucket, about.
BITS, MOST = 32, 1_000_000
MANIFEST = "bucket string, version bigint, n bigint"


def _bits(key: str) -> Column:
    """The key's hash as a row of bits; a null key has one too."""
    return F.lpad(F.conv(F.hex(F.xxhash64(F.lit(7), F.col(key)).bitwiseAND((1 << BITS) - 1)), 16, 2), BITS, "0")


def _manifests(spark: SparkSession, root: str, before: int | None = None) -> list[int]:
    """Batches that have a manifest, the newest first."""
    found = [int(d.split("=")[1]) for d in list_subdirs(spark, root + "/manifest") if d.startswith("batch_id=")]
    return sorted((b for b in found if before is None or b < before), reverse=True)


def _buckets(spark: SparkSession, root: str, batch_id: int) -> list:
    """The manifest's rows: as many as the table has rows by ``most``."""
    return spark.read.schema(MANIFEST).parquet(batch_dir(root + "/manifest", batch_id)).collect()


def _rows_at(root: str, version: int, bucket: str) -> str:
    return os.path.join(root, "rows", f"version={version}", f"bucket=b{bucket}")


def _of_bucket(bits: Column, buckets: list[str]) -> Column:
    """The one of ``buckets`` (no one's bits begin another's) that a key's bits begin with."""
    found = F.lit(None).cast("string")
    for d in sorted({len(b) for b in buckets}):
        begin = F.substring(bits, 1, d)
        found = F.when(begin.isin([b for b in buckets if len(b) == d]), begin).otherwise(found)
    return found


def keyed_table_batch(key: str, order: str, root: str, columns: list[str], most: int = MOST):
    """foreachBatch function that keeps the latest row per key (largest ``order``; equal
    ones: the largest row) in the keyed table ``root``.

    The batch is first reduced to one row per key.  Rows of the table that are
    later than the batch's stay.  A batch whose manifest is there is left alone;
    of earlier versions the newest stays for a replay, older rows are removed.
    """
    row = F.struct(order, *columns)

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if path_exists(spark, batch_dir(root + "/manifest", batch_id)):
            return
        earlier = _manifests(spark, root, batch_id)
        old = _buckets(spark, root, earlier[0]) if earlier else []
        latest = batch.groupBy(key).agg(F.max(row).alias("row")).select(key, "row", _bits(key).alias("bits"))
        buckets = {b.bucket: b for b in old}
        where = _of_bucket(F.col("bits"), list(buckets)) if old else F.lit("")
        fresh = latest.withColumn("was", where).persist()
        touched = {r.was: r.n for r in fresh.groupBy("was").agg(F.count(F.lit(1)).alias("n")).collect()}
        # A bucket may hold all its rows and the new ones: split it as far as these need.
        deeper = {b: min(max(0, (-(-(n + (buckets[b].n if b in buckets else 0)) // most) - 1).bit_length()),
                         BITS - len(b)) for b, n in touched.items()}
        parts = [spark.read.parquet(_rows_at(root, buckets[b].version, b)).select(
            key, F.struct(order, *columns).alias("row"), _bits(key).alias("bits"), F.lit(b).alias("was"))
            for b in touched if b in buckets]
        latest = fresh
        for part in parts:
            latest = latest.unionByName(part)
        depth = F.lit(0)
        for more in sorted(set(deeper.values())):
            those = [b for b, d in deeper.items() if d == more]
            depth = F.when(F.col("was").isin(those), F.length("was") + more).otherwise(depth)
        merged = (latest.groupBy(key, "bits", "was").agg(F.max("row").alias("row"))
                  .withColumn("bucket", F.concat(F.lit("b"), F.substring(F.col("bits"), F.lit(1), depth))))
        version = os.path.join(root, "rows", f"version={batch_id}")
        # Rows of a bucket meet in one task, and so in one file.
        (merged.select(key, "row.*", "bucket").repartition("bucket").write.mode("overwrite")
         .partitionBy("bucket").parquet(version))
        fresh.unpersist()
        made = (spark.read.parquet(version).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
                .select(F.expr("substring(bucket, 2)").alias("bucket"), F.lit(batch_id).cast("bigint").alias("version"),
                        "n"))
        kept = [tuple(b) for b in old if b.bucket not in touched]
        manifest = made.unionByName(spark.createDataFrame(kept, MANIFEST)) if kept else made
        commit(spark, stage(manifest.coalesce(1), root + "/manifest", batch_id), root + "/manifest", batch_id)
        _remove_unnamed(spark, root, [batch_id, *earlier[:1]], earlier[1:])
    return fn


def _remove_unnamed(spark: SparkSession, root: str, keep: list[int], drop: list[int]) -> None:
    """Remove old manifests, and the rows that only they name."""
    named = {(b.version, b.bucket) for m in keep for b in _buckets(spark, root, m)}
    for m in drop:
        for b in _buckets(spark, root, m):
            if (b.version, b.bucket) not in named:
                delete_path(spark, _rows_at(root, b.version, b.bucket))
        delete_path(spark, batch_dir(root + "/manifest", m))


def read_keyed_table(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """The table as the newest manifest names it, or None before the first."""
    found = _manifests(spark, root, before)
    if not found:
        return None
    paths = [_rows_at(root, b.version, b.bucket) for b in _buckets(spark, root, found[0])]
    return spark.read.parquet(*paths)
