"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all 64-bit values within half the radius of
itself; two fingerprints within the radius meet in at least one value.  What
meets is verified by its bit distance, links are joined into components.

The fingerprints that can meet in one value are bounded by the ball around it
(65 for radius 2), so a value's members fit a 64-bit mask that Spark sums up
with ``bit_or`` before and after the shuffle: no group is ever collected, and
copies of a text cost one fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import text_bytes, texts_of, written
from rillet.llm.components import components

# Fixed values of the fingerprint's definition.
SEED = 42
BITS = 64
BLOCK = 1 << 16


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of the word shingles of a text, as an unsigned 64-bit number.

    A-Z are lower-cased; fewer words than ``width`` make one shingle, none give 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    begin = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1:] - 1
    counts = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, BLOCK):
        pairs = zip(begin[i:i + BLOCK].tolist(), last[i:i + BLOCK].tolist())
        h = np.array([digest(data[a:b], SEED) for a, b in pairs], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, th, fp): hash of the text and its fingerprint, as signed longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, width) for t in text_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(np.array(fps, dtype="<u8").view("<i8"))],
                ["doc_id", "th", "fp"])

    keyed = texts_of(docs).select("doc_id", "text", F.xxhash64("text").alias("th"))
    return keyed.mapInArrow(run, "doc_id long, th long, fp long")


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def _ball(fp: Column) -> Column:
    """All values at distance 0 or 1, each with the flipped bit (-1: none)."""
    flipped = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)),
                          lambda i: F.struct(fp.bitwiseXOR(_bit(i)).alias("value"),
                                             i.alias("bit")))
    return F.concat(F.array(F.struct(fp.alias("value"), F.lit(-1).alias("bit"))), flipped)


def near_links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """(u, v): links that connect all distinct ``fp`` at ``distance`` (0, 1 or 2) bits or fewer.

    Fingerprints that meet in a value lie within two bits of each other, so
    for distance 2 linking each to the least of them loses no connection; for
    distance 1 the links are those to the value itself.
    """
    if distance not in (0, 1, 2):
        raise ValueError("distance must be 0, 1 or 2")
    if distance == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    # The few distinct values are spread again, as each gives 65 rows; by another hash
    # than that of ``distinct``, or Spark would take its few partitions for these.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = (fps.select("fp").distinct().repartition(parts, F.xxhash64("fp")).select(F.explode(_ball(F.col("fp"))).alias("b"))
           .select("b.value", F.when(F.col("b.bit") < 0, F.lit(0).cast("long"))
                   .otherwise(_bit(F.col("b.bit"))).alias("mask"),
                   (F.col("b.bit") < 0).alias("own"))
           .groupBy("value").agg(F.bit_or("mask").alias("mask"), F.max("own").alias("own"))
           .filter(F.bit_count("mask") + F.col("own").cast("int") > 1))
    flips = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.getbit("mask", i) == 1)
    others = F.transform(flips, lambda i: F.col("value").bitwiseXOR(_bit(i)))
    members = F.when(F.col("own"), F.concat(F.array("value"), others)).otherwise(others)
    centre = F.array_min("members") if distance == 2 else F.when(F.col("own"), F.col("value"))
    return (met.select("value", "own", members.alias("members"))
            .select(centre.alias("u"), F.explode("members").alias("v")).filter("u <> v").distinct()
            .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance))


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """One row per document: doc_id, th, fp (signed longs), component_id, label.

    component_id is the smallest doc_id reachable over links, the document's
    own included (nulls count only where a whole component has no id); label
    names the component by its least fingerprint.  A null text counts as empty;
    texts without words share fingerprint zero and are linked like any other.
    Repeated rows give a row each; an empty table gives none; columns other
    than doc_id and text are not looked at.
    """
    fps = written(fingerprints(docs, width), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = components(near_links(fps, distance))
    labelled = written(classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
                       .select("fp", "least", F.coalesce("label", "fp").alias("label")), "classes")
    lowest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = labelled.join(lowest, "label").select("fp", "component_id", "label")
    return fps.join(by_fp, "fp").select("doc_id", "th", "fp", "component_id", "label")


def one_of_each(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, of one document per component: the one with
    the smallest doc_id (a row without doc_id only where none has one; of rows that
    share it, the one with the least hash of its text; of equal rows, one)."""
    found = near_duplicates(docs, width, distance)
    own = found.groupBy("label", "doc_id", "th").agg(F.count("*").alias("copies"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "copies")).alias("k")
    kept = written(own.groupBy("label").agg(least).select(
        F.xxhash64("k.doc_id", "k.no_id").alias("_id"), F.col("k.th").alias("_th"), "k.copies"), "kept")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                        F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull()).alias("_id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_th"))
    keyed = keyed.join(kept.hint("merge"), ["_id", "_th"])  # no bound that would allow a broadcast
    if not kept.filter("copies > 1").isEmpty():  # equal rows: number them, which sorts the texts
        first = Window.partitionBy("_id", "_th").orderBy(F.lit(0))
        keyed = keyed.withColumn("nth", F.row_number().over(first)).filter("nth = 1")
    return keyed.select("row.*")


def hex_of(fp: Column) -> Column:
    """16 lowercase hex digits of a 64-bit fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
