"""Substring deduplication by super-k-mer partitioning.

A window is ``width`` consecutive words.  Each window has a minimiser: the
least of its ``mmer``-word hashes.  Consecutive windows that share one travel
as one packed string (a super-k-mer) to the minimiser's bucket; there all
windows of the bucket's strings are sorted, and windows that are equal byte
for byte learn the smallest document that has them.

* Minimisers seen in one document only cannot repeat: their windows are never
  packed.
* Equal packed strings are one row with their smallest and largest document
  before they are shuffled, so copies of a passage cost one string.
* Very frequent m-mers come last in the order of minimisers.  Windows at the
  edge of a frequent passage thus meet by the rare words beside it and not by
  the passage, and no bucket gathers all its surroundings.  The list is
  bounded; it changes where windows meet and never whether they do.
* A bucket that is too wide for one task all the same is split: its windows meet
  by their own digests instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import drop_written, slices, text_bytes, texts_of, written
from rillet.llm.words import Words, mix, window_hashes, window_minima, words_of

#: Windows of one packed string at most, so that they fit a 64-bit mask.
MOST_WINDOWS = 64
#: Bytes of text handled at once in a task; a longer text is handled alone.
SLICE = 1 << 19
#: Bytes of packed strings sorted at once (whole buckets).
CHUNK = 1 << 20
#: Bytes of a bucket's strings, copies included, beyond which its windows are spread over tasks.
WIDE = 1 << 23
FREQUENT = np.uint64(1 << 63)


def _key(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text, apart from rows with the same id) and text."""
    t = texts_of(docs)
    return t.select("doc_id", F.xxhash64("text").alias("th"), "text")


def frequent_mmers(docs: DataFrame, mmer: int = 8, share: int = 100_000, least: int = 100) -> np.ndarray:
    """Hashes of m-mers that make up about 1/``share`` of all, ``share`` of them at most.

    A slice of text reports what it holds three times or more, so the sums are
    lower bounds; sums of all slices count.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text", 2 * SLICE):
                h = mix(window_hashes(words_of(text_bytes(part.column("text"))).hashes, mmer))
                h.sort()
                begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))[:len(h)])
                n = np.diff(np.append(begin, len(h)))
                often = n >= 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(h[begin[often]], np.uint64(0)).view(np.int64)),
                     pa.array(np.append(n[often], 0)),
                     pa.array(np.append(np.zeros(often.sum(), np.int64), len(h)))], ["mini", "n", "total"])

    counted = written(texts_of(docs).filter("doc_id is not null").mapInArrow(run, "mini long, n long, total long")
                      .groupBy("mini").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "mmers")
    total = counted.agg(F.sum("total")).first()[0] or 0
    most = counted.filter((F.col("n") >= least) & (F.col("n") * share >= total)).select("mini")
    found = np.array([r[0] for r in most.limit(share).collect()], dtype=np.int64).view(np.uint64)
    drop_written(counted)
    return np.sort(found)


def _minimisers(w: Words, width: int, mmer: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings (word index) of all windows inside one text, and their minimisers."""
    h = mix(window_hashes(w.hashes, mmer))
    rank = h & ~FREQUENT
    if len(frequent) and len(h):
        at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        rank |= np.where(frequent[at] == h, FREQUENT, np.uint64(0))
    least = window_minima(rank, width - mmer + 1) if len(h) > width - mmer else rank[:0]
    last = np.repeat(w.first[1:], w.counts)[:len(least)]  # end of the text that holds word i
    begin = np.flatnonzero(np.arange(len(least)) + width <= last)
    return begin, least[begin]


def super_kmers(docs: DataFrame, frequent: np.ndarray, width: int = 50, mmer: int = 8) -> DataFrame:
    """(doc_id, th, start, n, n_bytes, mini): runs of windows that share a minimiser."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # `share` values at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text", SLICE):
                w = words_of(text_bytes(part.column("text")))
                at, mini = _minimisers(w, width, mmer, shared.value)
                if not len(at):
                    continue
                new = np.concatenate(([True], (np.diff(at) != 1) | (mini[1:] != mini[:-1])))
                head = np.flatnonzero(new)
                n = np.diff(np.append(head, len(at)))
                if n.max() > MOST_WINDOWS:  # repeats inside a text: cut again
                    pieces = -(-n // MOST_WINDOWS)
                    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                    head = np.repeat(head, pieces) + nth * MOST_WINDOWS
                    n = np.minimum(np.repeat(n, pieces) - nth * MOST_WINDOWS, MOST_WINDOWS)
                row = np.searchsorted(w.first, at[head], side="right") - 1
                n_bytes = w.begin[at[head] + n + width - 1] - 1 - w.begin[at[head]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), part.column("th").take(pa.array(row)),
                     pa.array((at[head] - w.first[row]).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(n_bytes.astype(np.int32)), pa.array(mini[head].view(np.int64))],
                    ["doc_id", "th", "start", "n", "n_bytes", "mini"])

    return (_key(docs).filter("doc_id is not null")
            .mapInArrow(run, "doc_id long, th long, start int, n int, n_bytes int, mini long"))


def _pack(docs: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """The packed strings of ``spans``, with a digest that names equal strings."""
    per_doc = spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "n", "mini", "wide")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text", SLICE):
                w = words_of(text_bytes(part.column("text")))
                spans = part.column("spans")
                row = np.repeat(np.arange(part.num_rows), np.diff(spans.offsets.to_numpy()))
                start, n, mini, wide = spans.flatten().flatten()
                first = w.first[row] + start.to_numpy()
                packed = [w.joined(k, m + width - 1) for k, m in zip(first.tolist(), n.to_pylist())]
                out = [part.column("doc_id").take(pa.array(row)), part.column("th").take(pa.array(row)), start, n,
                       mini, wide, pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in packed], pa.binary()),
                       pa.array(packed, pa.binary())]
                for i in range(0, len(row), 5000):
                    yield pa.RecordBatch.from_arrays([x.slice(i, 5000) for x in out],
                                                     ["doc_id", "th", "start", "n", "mini", "wide", "digest", "packed"])

    # A merge join: neither side has a bound that would allow a broadcast.
    return _key(docs).join(per_doc.hint("merge"), ["doc_id", "th"]).mapInArrow(
        run, "doc_id long, th long, start int, n int, mini long, wide boolean, digest binary, packed binary")


def _first_documents(packed: list[bytes], dmin: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each packed string, in order, the smallest document that
    has it; and the offsets of the strings' windows."""
    w = words_of(packed)
    n = w.counts - width + 1
    offsets = np.concatenate(([0], np.cumsum(n)))
    row = np.repeat(np.arange(len(packed)), n)
    at = np.arange(offsets[-1]) - offsets[row] + w.first[row]
    h = window_hashes(w.hashes, width)[at]
    order = np.argsort(h, kind="stable")
    group = np.cumsum(np.concatenate(([0], h[order][1:] != h[order][:-1]))) if len(order) else order
    heads = order[np.flatnonzero(np.concatenate(([True], np.diff(group) > 0)))] if len(order) else order
    # Byte comparison of every window with the head of its group.
    begin, end = w.begin[at].tolist(), (w.begin[at + width] - 1).tolist()
    data = w.data
    other = heads[group]
    pairs = np.flatnonzero(other != order)
    wrong = [i for i, a, b in zip(pairs.tolist(), order[pairs].tolist(), other[pairs].tolist())
             if data[begin[a]:end[a]] != data[begin[b]:end[b]]]
    if wrong:  # equal hashes of different windows: group these by their bytes
        fresh: dict[bytes, int] = {}
        for i in wrong:
            own = data[begin[order[i]]:end[order[i]]]
            group[i] = fresh.setdefault(own, int(group[-1]) + 1 + len(fresh))
        again = np.argsort(group, kind="stable")
        order, group = order[again], group[again]
    first = np.empty(len(order), dtype=np.int64)
    if len(order):
        begins = np.flatnonzero(np.concatenate(([True], np.diff(group) != 0)))
        least = np.minimum.reduceat(dmin[row[order]], begins)
        first[order] = np.repeat(least, np.diff(np.append(begins, len(order))))
    return first, offsets


def _sort_buckets(strings: DataFrame, width: int) -> DataFrame:
    """(digest, firsts) of the strings in which some window belongs to an earlier
    document than the last one that has the string."""
    def flush(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows).combine_chunks()
        if not t.num_rows:
            return
        first, offsets = _first_documents(t["packed"].to_pylist(), t["dmin"].to_numpy(), width)
        keep = np.minimum.reduceat(first, offsets[:-1]) < t["dmax"].to_numpy()
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(first))
        which = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_arrays([t["digest"].combine_chunks().take(which), lists.take(which)],
                                         ["digest", "firsts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.nbytes
            if size < CHUNK:
                continue
            mini = b.column("mini").to_numpy()
            cut = int(np.searchsorted(mini, mini[-1]))  # the last bucket may go on
            if cut:
                held[-1] = b.slice(0, cut)
                yield from flush(held)
                held = [b.slice(cut)]
                size = held[0].nbytes
        if held:
            yield from flush(held)

    return (strings.repartition("mini").sortWithinPartitions("mini")
            .mapInArrow(run, "digest binary, firsts array<long>"))


def _spread_windows(strings: DataFrame, width: int) -> DataFrame:
    """What :func:`_sort_buckets` returns, for buckets of any width: windows are shuffled by
    their digests, summed up in every task first, and joined back to their strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "packed", SLICE):
                w = words_of(part.column("packed").to_pylist())
                n = w.counts - width + 1
                row = np.repeat(np.arange(part.num_rows), n)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                at = w.first[row] + nth
                data = w.data
                for i in range(0, len(row), 5000):
                    to, cut = pa.array(row[i:i + 5000]), slice(i, i + 5000)
                    keys = [hashlib.blake2b(data[a:z], digest_size=16).digest() for a, z in
                            zip(w.begin[at[cut]].tolist(), (w.begin[at[cut] + width] - 1).tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("digest").take(to), pa.array(nth[cut].astype(np.int32)),
                         pa.array(keys, pa.binary()), part.column("dmin").take(to), part.column("dmax").take(to)],
                        ["digest", "nth", "window", "dmin", "dmax"])

    windows = strings.mapInArrow(run, "digest binary, nth int, window binary, dmin long, dmax long")
    least = windows.groupBy("window").agg(F.min("dmin").alias("first"))
    # a string has at most MOST_WINDOWS windows
    whole = (windows.join(least.hint("merge"), "window").groupBy("digest")
             .agg(F.array_sort(F.collect_list(F.struct("nth", "first"))).alias("found"), F.max("dmax").alias("dmax")))
    return (whole.select("digest", F.transform("found", lambda x: x["first"]).alias("firsts"), "dmax")
            .filter(F.array_min("firsts") < F.col("dmax")).select("digest", "firsts"))


def repeated_windows(docs: DataFrame, width: int = 50, mmer: int = 8) -> DataFrame:
    """(doc_id, th, start, mask): bit i of the mask says that the window that begins
    at word start + i also begins in a document with a smaller doc_id."""
    spans = written(super_kmers(docs, frequent_mmers(docs, mmer), width, mmer), "super-kmers")
    shared = (spans.groupBy("mini").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"),
                                        (F.sum("n_bytes") > WIDE).alias("wide"))
              .filter("a < b").select("mini", "wide"))
    packed = written(_pack(docs, spans.join(shared, "mini"), width), "packed", "zstd")

    def strings(which: str) -> DataFrame:
        return packed.filter(which).groupBy("mini", "digest", "packed").agg(
            F.min("doc_id").alias("dmin"), F.max("doc_id").alias("dmax"))

    firsts = _sort_buckets(strings("not wide"), width).unionByName(
        _spread_windows(strings("wide").select("digest", "packed", "dmin", "dmax"), width))
    one = F.lit(1).cast("long")
    bits = F.transform("firsts", lambda f, i: F.when(f < F.col("doc_id"), F.call_function("shiftleft", one, i))
                       .otherwise(F.lit(0).cast("long")))
    marks = (packed.select("doc_id", "th", "start", "digest").join(firsts, "digest")
             .select("doc_id", "th", "start",
                     F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)).alias("mask"))
             .filter("mask <> 0"))
    out = written(marks, "repeated-windows")
    drop_written(spans, packed)
    return out


def remove_repeats(docs: DataFrame, width: int = 50, mmer: int = 8) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, text (kept words, one space between).

    A word goes if a window of ``width`` words covers it whose word sequence
    also starts in a document with a smaller doc_id, judged on the input.  Rows
    without doc_id neither lose words nor take any; rows that share a doc_id do
    not count as earlier than one another.  A null text has no words; an empty
    table gives none; other columns are not looked at.
    """
    marks = (repeated_windows(docs, width, mmer).groupBy("doc_id", "th")
             .agg(F.collect_list(F.struct("start", "mask")).alias("marks")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text", SLICE):
                n_words, n_removed, kept = [], [], []
                for text, found in zip(text_bytes(part.column("text")), part.column("marks").to_pylist()):
                    words = text.split()
                    n = len(words)
                    if found:
                        covered = _covered(n, found, width)
                        words = [words[i] for i in np.flatnonzero(~covered).tolist()]
                    n_words.append(n)
                    n_removed.append(n - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "text"])

    return _key(docs).join(marks.hint("merge"), ["doc_id", "th"], "left").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, text string")


def _covered(n: int, marks: list[dict], width: int) -> np.ndarray:
    """Which of ``n`` words lie in a marked window."""
    start = np.array([m["start"] for m in marks], dtype=np.int64)
    mask = np.array([m["mask"] for m in marks], dtype=np.int64).view(np.uint64)
    which, bit = np.nonzero((mask[:, None] >> np.arange(MOST_WINDOWS, dtype=np.uint64)) & np.uint64(1))
    step = np.zeros(n + 1, dtype=np.int64)
    begin = np.unique(start[which] + bit)
    step[begin] += 1
    np.add.at(step, begin + width, -1)
    return np.cumsum(step[:-1]) > 0
