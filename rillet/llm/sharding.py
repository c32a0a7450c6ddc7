"""Shards by vector bin packing: bytes, tokens and rows balanced together.

Documents with equal texts are one group.  Groups of some size are items of
their own; the many small ones are hashed into a fixed number of bundles, a
part of them into finer ones for the end.  Items go, the largest first, to the
shard whose residual capacity has the highest dot product with the item.
Only items come to the driver, and their number is bounded by the parameters
whatever the input.  A group larger than a shard is split by a hash of doc_id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import drop_written, written
from rillet.llm.mixing import n_words

#: A group of 1/SINGLE of a shard or more, in any measure, is an item.
SINGLE = 64
#: Bundles of small groups; one group in FINE_SHARE goes to a fine bundle.
BUNDLES, FINE, FINE_SHARE = 4096, 8192, 8
#: Blocks in which the rows of a shard are numbered, beside one per item.
BLOCKS = 16_384
MEASURES = ("size", "tokens", "n")
#: What each measure counts in the dot product: bytes come first.
WEIGHTS = (4.0, 1.0, 1.0)


def _measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + 8).cast("long").alias("size"), n_words(F.col("text")).alias("tokens"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("group"))


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (rows: items in shares of a shard, largest first)."""
    residual = np.ones((shards, items.shape[1]))
    weighted = items * np.array(WEIGHTS)
    out = np.empty(len(items), dtype=np.int32)
    for i, item in enumerate(items):
        out[i] = best = int(np.argmax(residual @ weighted[i]))
        residual[best] -= item
    return out


def _bundled(rows: DataFrame, large: DataFrame) -> DataFrame:
    """Add ``bundle``; ``large`` (group, pieces) holds the groups that are items."""
    h = F.xxhash64("group", F.lit(1))
    small = F.when(F.pmod(h, F.lit(FINE_SHARE)) == 0, BUNDLES + F.pmod(F.shiftright(h, 8), F.lit(FINE))).otherwise(
        F.pmod(F.shiftright(h, 8), F.lit(BUNDLES)))
    piece = F.pmod(F.xxhash64("doc_id", "group"), F.col("pieces"))
    # Bounded: SINGLE groups per shard and measure at most.
    return (rows.join(F.broadcast(large), "group", "left")
            .withColumn("bundle", F.when(F.col("pieces").isNull(), small).otherwise(F.xxhash64("group", piece)))
            .drop("pieces"))


def _large_groups(rows: DataFrame, shards: int) -> tuple[DataFrame, list[float]]:
    totals = rows.agg(*(F.sum(m) for m in MEASURES[:2]), F.count("*")).first()
    share = [max(float(t or 0), 1.0) / shards for t in totals]
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
                                       F.count("*").alias("n"))
    load = F.greatest(*(F.col(m) / F.lit(s) for m, s in zip(MEASURES, share)))
    large = groups.filter(load >= 1 / SINGLE).select("group", F.ceil(load).cast("long").alias("pieces"))
    return written(large, "large-groups"), share


def _placed(bundled: DataFrame, share: list[float], shards: int) -> pd.DataFrame:
    """bundle, shard and number of blocks, of every item (bounded, see the module)."""
    items = (bundled.groupBy("bundle").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
                                           F.count("*").alias("n")).toPandas())
    vectors = items[list(MEASURES)].to_numpy(dtype=float) / np.array(share)
    order = np.lexsort((items["bundle"], -vectors.max(axis=1))) if len(items) else np.zeros(0, int)
    items = items.iloc[order]
    items["shard"] = place(vectors[order], shards)
    items["blocks"] = np.ceil(items["n"] / max(1.0, items["n"].sum() / BLOCKS)).astype(np.int64)
    return items[["bundle", "shard", "blocks"]].astype({"bundle": np.int64})


def assign(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes and 8), tokens (words),
    text_crc32, shard, slot (gapless from 0 in a shard).

    Equal texts share a shard unless together they exceed one in some measure.
    A null text is empty; rows without doc_id are placed like others; equal
    rows get a slot each; an empty table gives no rows; other columns are not
    looked at.
    """
    spark = docs.sparkSession
    rows = written(_measured(docs), "measured")
    large, share = _large_groups(rows, shards)
    bundled = _bundled(rows, large)
    placed = spark.createDataFrame(_placed(bundled, share, shards), "bundle long, shard int, blocks long")
    block = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("blocks")).cast("int")
    found = written(bundled.join(F.broadcast(placed), "bundle").withColumn("block", block).drop("group", "blocks"),
                    "sharded")
    # Rows are numbered in their block; blocks, bounded in number, in their shard.
    before = Window.partitionBy("shard").orderBy("bundle", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (found.groupBy("shard", "bundle", "block").agg(F.count("*").alias("n"))
              .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n", "shard"))
    own = Window.partitionBy("bundle", "block").orderBy("doc_id", "text_crc32")
    out = (found.withColumn("nth", F.row_number().over(own)).join(blocks, ["bundle", "block"])
           .select("doc_id", "size", "tokens", "text_crc32", "shard",
                   (F.col("base") + F.col("nth") - 1).cast("long").alias("slot")))
    drop_written(rows, large)
    return out


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """Write all columns of ``docs`` as Parquet, one folder ``shard=N`` per shard."""
    spark = docs.sparkSession
    rows = _measured(docs)
    large, share = _large_groups(rows, shards)
    placed = spark.createDataFrame(_placed(_bundled(rows, large), share, shards), "bundle long, shard int, blocks long")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                        F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("group"))
    sharded = _bundled(whole, large).join(F.broadcast(placed), "bundle")
    kept = [c for c in docs.columns if c.lower() != "shard"]
    sharded.select(*(F.col("row").getField(c).alias(c) for c in kept), "shard").write.partitionBy("shard").parquet(path)
