"""Mixing sources to target weights by capped water-filling.

Sources share the corpus's size by weight; a source that would repeat more
than ``most`` times is clamped there, and what it leaves is shared by weight
among the others until none is above its cap.  A source then gives whole
repetitions of all its documents and, for the rest, a seeded part of them.

DataFrame operations only.  A round of the filling is one aggregate over the
table of sources.  The seeded part is a prefix of the source's documents in
the order of a hash of doc_id: sizes are summed per hash bucket (about a
thousand documents each, so a source's number of buckets follows its size),
and only the one bucket in which the prefix ends is looked at document by
document.  One more document, the nearest in size, closes what is then left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import WORD_PATTERN, drop_written, written

#: Weights of sources in code point order, repeating; largest repetition.
WEIGHTS, MOST = (5, 2, 1), 3
#: Documents of a hash bucket, about.
BUCKET = 1024
#: Columns that name a source, and with ``h`` and ``th`` a unit of documents.
SOURCE = ["source_key", "no_source"]
UNIT = ["h", "th", *SOURCE]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _keyed(docs: DataFrame, seed: int, *more: str | Column) -> DataFrame:
    """The columns UNIT, none of them null, beside ``more``."""
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return docs.select(F.md5(F.concat(F.lit(f"{seed}:"), named)).alias("h"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
                       F.coalesce("source", F.lit("")).alias("source_key"),
                       F.col("source").isNull().alias("no_source"), *more)


def source_targets(units: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source_key, no_source, docs, source_size, target): the filled table of sources."""
    sources = (units.groupBy(*SOURCE).agg(F.sum("docs").alias("docs"), F.sum("total").alias("source_size")))
    # A source's place in code point order, null last, without one task for all.
    ranged = written(sources.repartitionByRange("no_source", "source_key")
                     .withColumn("part", F.spark_partition_id()), "sources")
    before = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    place = F.col("base") + F.row_number().over(Window.partitionBy("part").orderBy("no_source", "source_key")) - 1
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (place % len(weights)).cast("int") + 1)
    weighed = written(ranged.join(before, "part").withColumn("weight", weight.cast("long"))
                      .withColumn("cap", F.col("source_size") * most).drop("part", "base"), "weighed")
    all_size, free_weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    free_size, capped, level = all_size, -1, 0.0
    while free_weight:
        level = free_size / free_weight
        above = F.col("cap") < F.col("weight") * F.lit(level)
        row = weighed.agg(F.count(F.when(above, 1)), F.sum(F.when(above, F.col("cap"))),
                          F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if row[0] == capped:
            break
        capped, free_size, free_weight = row[0], all_size - (row[1] or 0), row[2]
    target = F.least(F.col("weight") * F.lit(float(level)), F.col("cap").cast("double"))
    out = written(weighed.select(*SOURCE, "docs", "source_size", target.alias("target")), "targets")
    drop_written(ranged, weighed)
    return out


def plan(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: int = 11) -> DataFrame:
    """(h, th, source_key, no_source, size, source_size, target, copies): how often the
    mix takes each unit, a unit being rows equal in doc_id, source and text."""
    sized = _keyed(docs, seed, n_words(F.col("text")).alias("size"))
    units = written(sized.groupBy(*UNIT).agg(F.max("size").alias("size"), F.count("*").alias("docs"),
                                             F.sum("size").alias("total")), "units")
    targets = source_targets(units, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("docs") / BUCKET))).cast("int")
    shares = targets.select(*SOURCE, "source_size", "target", whole.alias("whole"),
                            (F.col("target") - whole * F.col("source_size")).alias("rest"), digits.alias("digits"))
    placed = units.join(shares, SOURCE).withColumn("bucket", F.expr("substring(h, 1, digits)"))
    sums = placed.groupBy(*SOURCE, "bucket").agg(F.sum("total").alias("bucket_size"), F.first("rest").alias("rest"))
    by_bucket = Window.partitionBy(*SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("bucket_size").over(by_bucket), F.lit(0)))
    # 1: the bucket lies inside the prefix, 0: the prefix ends in it, -1: beyond.
    state = (F.when(F.col("base") + F.col("bucket_size") <= F.col("rest"), 1)
             .when(F.col("base") <= F.col("rest"), 0).otherwise(-1))
    marked = written(placed.join(sums.select(*SOURCE, "bucket", "base", state.alias("state")), [*SOURCE, "bucket"])
                     .drop("bucket", "digits"), "placed")
    # At most two buckets of a source can be its end (an empty one beside it).
    running = Window.partitionBy(*SOURCE, "base").orderBy("h", "th").rowsBetween(Window.unboundedPreceding, 0)
    ends = marked.filter("state = 0").withColumn(
        "extra", (F.col("base") + F.sum("total").over(running) <= F.col("rest")).cast("int"))
    chosen = written(marked.filter("state <> 0").withColumn("extra", (F.col("state") > 0).cast("int"))
                     .unionByName(ends).drop("base", "state"), "chosen")
    left = (chosen.groupBy(*SOURCE).agg((F.max("rest") - F.sum(F.col("extra") * F.col("total"))).alias("left")))
    # One unit for each size of a source, summed up before the shuffle: a hot source has no
    # more rows than its documents have sizes.
    sizes = (chosen.filter("extra = 0 and total > 0").groupBy(*SOURCE, "total")
             .agg(F.min(F.struct("h", "th")).alias("unit")).join(left, SOURCE))
    gap = F.abs(F.col("left") - F.col("total")).alias("gap")
    closing = (sizes.groupBy(*SOURCE).agg(F.min(F.struct(gap, "unit")).alias("best"), F.max("left").alias("left"))
               .filter("best.gap < left").select("best.unit.h", "best.unit.th", *SOURCE, F.lit(1).alias("closing")))
    copies = (F.col("whole") + F.col("extra") + F.coalesce("closing", F.lit(0))).cast("long")
    out = written(chosen.join(closing, UNIT, "left").select(
        *UNIT, "size", "source_size", "target", copies.alias("copies")), "mix-plan")
    drop_written(units, targets, marked, chosen)
    return out


def mix_report(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: int = 11) -> DataFrame:
    """One row per document: doc_id, size (words), source_size, target (its
    source's), taken (words the mix takes of it, repeats counted).

    The order of a source's documents, and so the mix, depends on ``seed`` and
    doc_id alone.  A null source is a source of its own and comes last; a null
    text has no words; rows equal in doc_id, source and text are taken
    together; an empty table gives no rows; other columns are not looked at.
    """
    taken = (F.col("size") * F.col("copies")).alias("taken")
    chosen = plan(docs, weights, most, seed).select(*UNIT, "size", "source_size", "target", taken)
    return (_keyed(docs, seed, F.col("doc_id").cast("long").alias("doc_id")).join(chosen, UNIT)
            .select("doc_id", "size", "source_size", "target", "taken"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: int = 11) -> DataFrame:
    """The mixed documents themselves: each row as often as the mix takes it.

    All columns of ``docs`` are kept as they are.
    """
    chosen = plan(docs, weights, most, seed).filter("copies > 0").select(*UNIT, "copies")
    rows = _keyed(docs, seed, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.join(chosen.hint("merge"), UNIT)  # no bound that would allow a broadcast
    repeated = rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("nth"))
    return repeated.select("row.*")
