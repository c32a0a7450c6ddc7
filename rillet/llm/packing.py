"""Packing documents into token sequences along a space-filling curve.

A document's hashed counts of byte 4-grams are projected to a few dimensions; each
dimension is made uniform by the normal distribution, and the cell's place on a
Hilbert curve is the document's key.  Documents are range-sorted by key; each range is a task that encodes its
documents in curve order, lays them end to end and cuts every ``length`` ids,
so neighbours on the curve share sequences.  What is left at the end of a
range is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import math
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import slices, texts_of
from rillet.llm.encode import encoder

#: Hash dimensions of a document vector, projected dimensions, bits of each on
#: the curve, and bits that tell documents of one cell apart.
HASHED, DIMENSIONS, CELL_BITS = 1024, 3, 14
TIE_BITS = 62 - DIMENSIONS * CELL_BITS
#: Odd factors of the 4-gram hash, modulo 2**16.
MULTIPLIERS = np.array([40503, 60493, 19141, 52711], dtype=np.uint16)
SLICE = 1 << 20
SEQUENCE_BITS = 40
ROWS = 4_000
#: Sampled documents of a range, about, that place its bounds.
PER_RANGE = 300


def _projection(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((HASHED, DIMENSIONS))


def document_points(texts: list[bytes], projection: np.ndarray) -> np.ndarray:
    """Each text's hashed 4-gram counts (their roots, at unit length), projected;
    a text of fewer than four bytes: the origin."""
    out = np.zeros((len(texts), DIMENSIONS))
    for begin in range(0, len(texts), 256):
        part = texts[begin:begin + 256]
        counts = np.zeros((len(part), HASHED))
        for row, text in zip(counts, part):
            for i in range(0, len(text) - 3, SLICE):
                b = np.frombuffer(text, dtype=np.uint8, count=min(len(text) - i, SLICE + 3), offset=i)
                h = b[:-3] * MULTIPLIERS[0]
                for k in range(1, 4):
                    h += b[k:len(b) - 3 + k] * MULTIPLIERS[k]
                row += np.bincount(h >> np.uint16(16 - HASHED.bit_length() + 1), minlength=HASHED)
        np.sqrt(counts, out=counts)
        norm = np.maximum(np.sqrt((counts * counts).sum(axis=1)), 1.0)
        out[begin:begin + 256] = (counts @ projection) / norm[:, None]
    return out


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer points (one row each) on the Hilbert curve of ``bits`` bits a side.

    The curve is walked from the coarsest level: at each level the cube's
    orientation (a swap and flips of axes) is undone in the remaining bits, and
    the axes' bits, Gray-decoded, are the next digits of the key.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(dims):
            flip = (x[axis] >> level) & 1 == 1
            swap = (x[0] ^ x[axis]) & low
            x[0] ^= np.where(flip, low, swap)
            x[axis] ^= np.where(flip, 0, swap)
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    parity = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        parity ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= parity
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(dims):
            key = key << 1 | (x[axis] >> level) & 1
    return key


def _cells(points: np.ndarray) -> np.ndarray:
    """Projections of unit vectors on standard normal directions are standard normal
    at large; their distribution function spreads them over the cells of each side."""
    side = 1 << CELL_BITS
    uniform = np.vectorize(math.erf, otypes=[float])(points / math.sqrt(2)) * 0.5 + 0.5
    return np.minimum((uniform * side).astype(np.int64), side - 1)


def curve_order(docs: DataFrame, seed: int = 7, split: int | None = None) -> DataFrame:
    """doc_id, text and ``key``, range-partitioned and sorted by key.

    The key is a function of the text alone, followed by bits of a hash of
    doc_id, so that many equal texts, which share a cell, still fall into many
    ranges.  The ranges' bounds come from about ``PER_RANGE`` documents a range,
    chosen by hash, as Spark's own range partitioning samples its input; they
    decide which task has a document, and every document is packed.  Computing
    the bounds apart spares a second walk through all texts.
    """
    spark = docs.sparkSession
    projection = _projection(seed)
    base = texts_of(docs).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("tie"))
    ranges = split or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def key_of(tie: pd.Series, text: pd.Series) -> np.ndarray:
        place = hilbert_key(_cells(document_points(list(text), projection)), CELL_BITS)
        return place << TIE_BITS | (tie.to_numpy() & ((1 << TIE_BITS) - 1))

    @F.pandas_udf("long")
    def sampled_key(tie: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series(key_of(tie, text))

    share = min(1.0, PER_RANGE * ranges / max(docs.count(), 1))
    chosen = F.xxhash64("tie", F.lit(seed)).bitwiseAND((1 << 62) - 1) < int(share * (1 << 62))
    sample = base.filter(chosen)
    shares = [i / ranges for i in range(1, ranges)]
    bounds = sample.select(sampled_key("tie", F.col("text").cast("binary")).alias("key")).agg(
        F.percentile_approx("key", shares, 100 * ranges) if shares else F.lit(None)).first()[0]
    bounds = np.unique(np.array(bounds or [], dtype=np.int64))  # fewer than `ranges`

    # Key and range in one function: two would be two Python workers a task.
    @F.pandas_udf("key long, range int")
    def place_of_text(tie: pd.Series, text: pd.Series) -> pd.DataFrame:
        key = key_of(tie, text)
        return pd.DataFrame({"key": key, "range": np.searchsorted(bounds, key).astype(np.int32)})

    placed = base.select("doc_id", "text", place_of_text("tie", F.col("text").cast("binary")).alias("place"))
    ranged = placed.repartitionById(len(bounds) + 1, F.col("place.range"))
    return ranged.select("doc_id", "text", "place.key").sortWithinPartitions("key", "doc_id")


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = 2048, seed: int = 7) -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length,
    ids_crc32 (of its ids as little-endian unsigned 32-bit numbers), doc_tokens,
    sequence_id, offset, ids (binary, little-endian, the tokenizer's width).

    A document is its ids and ``end_id``; a null text is empty, a null doc_id
    stays null, repeated rows are packed once each; an empty table gives no
    rows; other columns are not looked at.  A sequence holds ``length`` ids, or
    a smaller power of two at the end of a range: none needs padding.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        end = np.array([end_id], dtype=tokens.dtype)
        sequence = TaskContext.get().partitionId() << SEQUENCE_BITS
        held: deque[tuple] = deque()  # documents, or their ends, that are not cut yet
        n_held = 0
        rows: list[tuple] = []

        def cut(most: int) -> None:
            """Take one sequence of ``most`` ids from what is held."""
            nonlocal sequence, n_held, held
            offset = 0
            while offset < most:
                doc_id, ids, start = held[0]
                piece = ids[start:start + most - offset]
                rows.append((doc_id, start, len(piece), zlib.crc32(piece.astype("<u4")), len(ids),
                             sequence, offset, piece.tobytes()))
                offset += len(piece)
                if start + len(piece) == len(ids):
                    held.popleft()
                else:
                    held[0] = (doc_id, ids, start + len(piece))
            sequence, n_held = sequence + 1, n_held - most

        for b in batches:
            for part in slices(b, "text", SLICE):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(),
                                       tokens.encode(part.column("text").to_pylist())):
                    held.append((doc_id, np.concatenate((ids, end)), 0))
                    n_held += len(ids) + 1
                    while n_held >= length:
                        cut(length)
                    if len(rows) >= ROWS:
                        yield _pieces(rows)
                        rows = []
        while n_held:
            cut(1 << (n_held.bit_length() - 1))
        yield _pieces(rows)

    return curve_order(docs, seed).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
             "offset long, ids binary")


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 8
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns[:7]), pa.array(columns[7], pa.binary())],
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
