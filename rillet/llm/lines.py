"""Line deduplication by content-defined chunks.

A rolling hash over the hashes of neighbouring lines chooses where a chunk of
lines ends, so chunks depend on their own lines only and an inserted line
moves no boundary beyond its neighbourhood.  Chunks of two lines or more that
an earlier document has as well are removed after comparison byte by byte.

Such chunks miss most short runs that two documents share, as a chunk mixes in
the lines beside the run.  Where ``words`` is given (the pipeline), every run of
lines with so many words that an earlier document has goes as well: from each
line the shortest run of so many words, forwards and backwards, is looked up, so
no line of a longer common run is missed.

DataFrame operations only.  Chunk hashes are counted first; only chunks whose
hash repeats are compared as texts, and equal ones are one row before they
are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import WORD_PATTERN, drop_written, written

#: A boundary lies where the rolling hash is 0 modulo MODULUS.  Fixed values.
MODULUS, FACTOR = 3, 31
KEY = ["doc_id", "th"]


def _then(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row: a generator's output is not
    folded into the expressions above it, which may use it for each element."""
    one = F.array(F.struct(*(c.alias(n) for n, c in columns.items())))
    return df.select("*", F.inline(one))


def chunked(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, th (hash of the text), n_lines, ``chunks`` (the text's lines, joined chunk
    by chunk), ``begin`` and ``end`` (their first and last lines) and ``more``.  Chunks have two lines at least, unless the text has one."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)
    names = df.columns[2:]
    df = _then(df, th=F.xxhash64("text"), lines=F.split("text", "\n")).drop("text")
    df = _then(df, hashes=F.transform("lines", lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")))
    shifted = F.concat(F.array(F.lit(0).cast("long")), F.slice("hashes", 1, F.size("lines") - 1))
    df = _then(df, hit=F.zip_with("hashes", shifted, lambda a, b: (a + b * FACTOR) % MODULUS == 0))
    # A chunk ends at a hit that follows no hit: ends lie two lines apart.
    earlier = F.concat(F.array(F.lit(True)), F.slice("hit", 1, F.size("hit") - 1))
    ends = F.filter(F.transform(F.zip_with("hit", earlier, lambda a, b: a & ~b),
                                lambda x, i: F.when(x, i).otherwise(-1)), lambda i: i >= 0)
    df = _then(df, ends=ends, last=F.size("lines") - 1)
    short = F.get("ends", F.size("ends") - 1) > F.col("last") - 2  # the last chunk would have one line
    inner = F.when(short, F.slice("ends", 1, F.size("ends") - 1)).otherwise(F.col("ends"))
    df = _then(df, inner=inner)
    df = _then(df, begin=F.concat(F.array(F.lit(0)), F.transform("inner", lambda e: e + 1)),
               end=F.concat("inner", F.array("last")))
    chunks = F.zip_with("begin", "end", lambda b, e: F.array_join(F.slice("lines", b + 1, e - b + 1), "\n"))
    return _then(df, chunks=chunks).select("doc_id", "th", (F.col("last") + 1).cast("long").alias("n_lines"), "chunks",
                                           "begin", "end", *names)


def _repeatable(chunk: Column) -> Column:
    """Chunks of several lines that hold more than white space."""
    return (F.instr(chunk, "\n") > 0) & chunk.rlike(r"[^\x20\x09-\x0D]")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, th, k): chunk k of the document is one that a document with a smaller
    doc_id has, or that stands earlier in the document itself."""
    named = chunked(docs.filter("doc_id is not null"))
    at = named.select(*KEY, F.posexplode("chunks").alias("k", "chunk")).filter(_repeatable(F.col("chunk")))
    places = written(at.select(*KEY, "k", F.xxhash64("chunk").alias("ch")), "chunks")
    twice = places.groupBy("ch").agg(F.count("*").alias("n")).filter("n > 1").select("ch")
    wanted = places.join(twice, "ch").groupBy(*KEY).agg(F.collect_set("k").alias("ks"))
    # Merge joins: neither side has a bound that would allow a broadcast.
    texts = _then(named.join(wanted.hint("merge"), KEY), pairs=F.arrays_zip(
        F.transform("ks", lambda k: k).alias("k"), F.transform("ks", lambda k: F.get("chunks", k)).alias("chunk")))
    texts = texts.select(*KEY, F.inline("pairs").alias("k", "chunk")).withColumn("ch", F.xxhash64("chunk"))
    # Rows equal in doc_id and text give the same k twice: equal k are one place.
    again = F.rank().over(Window.partitionBy(*KEY, "ch", "chunk").orderBy("k")) > 1
    texts = written(texts.withColumn("again", again), "repeated", "zstd")
    first = texts.groupBy("ch", "chunk").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    found = written(texts.join(first, ["ch", "chunk"]).filter("again or first < doc_id").select(*KEY, "k").distinct(),
                    "removed")
    drop_written(places, texts)
    return found


def _runs(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, th, ``at`` (numbers of the lines that have words), ``sha`` (their SHA-256) and
    ``runs``: the shortest runs of such lines with ``words`` words or more, from each line on
    and up to each line.  A run of n lines from the b-th on is b * (words + 1) + n."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    df = _then(df, th=F.xxhash64("text"), lines=F.split("text", "\n")).drop("text")
    df = _then(df, line=F.filter(F.transform("lines", lambda x, i: F.struct(
        i.alias("i"), F.sha2(x, 256).alias("sha"), F.regexp_count(x, F.lit(WORD_PATTERN)).alias("w"))),
        lambda x: x["w"] > 0)).drop("lines")
    df = _then(df, at=F.transform("line", lambda x: x["i"]), sha=F.transform("line", lambda x: x["sha"]),
               w=F.transform("line", lambda x: F.least(x["w"], F.lit(words)))).drop("line")

    def reach(part: Column) -> Column:
        """Lines of ``part`` until it has enough words; 0 if it never has."""
        start = F.struct(F.lit(0).alias("s"), F.lit(0).alias("n"))
        return F.aggregate(part, start, lambda a, x: F.struct(
            (a["s"] + x).alias("s"), (a["n"] + (a["s"] < words).cast("int")).alias("n")),
            lambda a: F.when(a["s"] >= words, a["n"]).otherwise(0))

    # A line has a word at least, so a run has no more than ``words`` lines.
    on = F.transform("w", lambda x, p: F.struct(p.alias("p"), reach(F.slice("w", p + 1, words)).alias("n")))
    back = F.transform("w", lambda x, p: F.struct(p.alias("p"), reach(F.reverse(F.slice(
        "w", F.greatest(p - words + 2, F.lit(1)), F.least(p + 1, F.lit(words))))).alias("n")))
    df = _then(df, on=on, back=back)
    code = lambda b, n: F.when(n > 0, b.cast("long") * (words + 1) + n)
    runs = F.concat(F.transform("on", lambda r: code(r["p"], r["n"])),
                    F.transform("back", lambda r: code(r["p"] - r["n"] + 1, r["n"])))
    return _then(df, runs=F.array_distinct(F.array_compact(runs))).select(*KEY, "at", "sha", "runs")


def repeated_passages(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, th, covered): numbers of the document's lines that lie in a run of lines with
    ``words`` words or more that a document with a smaller doc_id has.  Lines of white space
    are passed over.  Runs are equal if the SHA-256 of all their lines are."""
    named = _runs(docs.filter("doc_id is not null"), words)
    of = lambda r: F.slice("sha", (F.floor(r / (words + 1)) + 1).cast("int"), (r % (words + 1)).cast("int"))
    places = _then(named, pairs=F.transform("runs", lambda r: F.struct(r.alias("run"), F.xxhash64(of(r)).alias("rh"))))
    places = written(places.select(*KEY, F.inline("pairs")), "runs")
    several = (F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    twice = places.groupBy("rh").agg(*several).filter("first < last").select("rh")
    wanted = places.join(twice, "rh").groupBy(*KEY).agg(F.collect_set("run").alias("wanted"))
    # Merge joins, as in repeated_chunks.
    found = _then(named.join(wanted.hint("merge"), KEY), pairs=F.transform("wanted", lambda r: F.struct(
        F.unhex(F.sha2(F.array_join(of(r), ""), 256)).alias("key"),
        F.slice("at", (F.floor(r / (words + 1)) + 1).cast("int"), (r % (words + 1)).cast("int")).alias("run"))))
    found = written(found.select(*KEY, F.inline("pairs")), "passages", "zstd")
    first = found.groupBy("key").agg(*several).filter("first < last").select("key", "first")
    covered = found.join(first, "key").filter("first < doc_id").select(*KEY, F.explode("run").alias("line"))
    out = written(covered.groupBy(*KEY).agg(F.collect_set("line").alias("covered")), "covered")
    drop_written(places, found)
    return out


def _less(df: DataFrame, passages: DataFrame) -> DataFrame:
    """:func:`_kept` with the lines of ``passages`` gone too: ``kept`` are single lines, none if
    only white space is left."""
    df = df.join(passages.hint("merge"), KEY, "left")
    df = df.withColumn("covered", F.coalesce("covered", F.array().cast("array<int>")))
    of_chunks = F.flatten(F.transform("gone", lambda k: F.sequence(F.get("begin", k), F.get("end", k))))
    df = _then(df, lines=F.split(F.array_join("chunks", "\n"), "\n"), rest=F.array_except(
        F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), F.concat("covered", of_chunks)))
    df = _then(df, left=F.transform("rest", lambda i: F.get("lines", i)))
    gone = F.concat("gone", "covered")
    empty = (F.size(gone) > 0) & ~F.exists("left", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return df.withColumns({"gone": gone, "kept": F.when(empty, F.array().cast("array<string>")).otherwise(F.col("left"))})


def _kept(docs: DataFrame, *more: Column) -> DataFrame:
    """Chunked documents with ``kept``, the chunks that stay."""
    gone = repeated_chunks(docs).groupBy(*KEY).agg(F.collect_set("k").alias("gone"))
    df = chunked(docs, *more).join(gone.hint("merge"), KEY, "left")
    df = df.withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    df = _then(df, stay=F.array_except(F.sequence(F.lit(0), F.size("chunks") - 1), "gone"))  # one pass, hashed
    kept = F.transform("stay", lambda k: F.get("chunks", k))
    return _then(df, kept=F.when(F.size("gone") > 0, kept).otherwise(F.col("chunks")))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed (lines), text (the lines kept).

    Lines end at a line feed.  Of equal chunks the one in the smallest doc_id
    stays, and in a document the first.  Rows without doc_id lose nothing and
    take nothing; rows that share a doc_id do not count as earlier than one
    another.  A null text is one empty line, and stays empty; chunks of one
    line or of white space stay; an empty table gives none; other columns are
    not looked at.
    """
    lines = F.aggregate("kept", F.lit(0).cast("long"), lambda n, c: n + F.size(F.split(c, "\n")))
    return _kept(docs).select("doc_id", "n_lines", (F.col("n_lines") - lines).alias("n_removed"),
                              F.array_join("kept", "\n").alias("text"))


def rewritten(docs: DataFrame, length: str | None = "n_chars", words: int | None = None) -> DataFrame:
    """``docs`` with texts as :func:`remove_repeats` leaves them, all other columns kept
    (``length``, if there, is the new text's).  With ``words``, the lines of
    :func:`repeated_passages` go as well.  A document of which nothing stays is
    dropped; one that was null or empty before stays as it was."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    df = _kept(docs, row)
    if words:
        df = _less(df, repeated_passages(docs, words))
    df = df.filter(F.size("kept") > 0)
    text = F.when(F.size("gone") > 0, F.array_join("kept", "\n")).otherwise(F.col("row.text"))
    df = _then(df, new=text)
    new = {"text": F.col("new")}
    if length in docs.columns:
        new[length] = F.when(F.size("gone") > 0, F.length("new")).otherwise(F.col("row").getField(length)).cast(
            docs.schema[length].dataType)
    return df.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
