"""Approximate nearest neighbours over balanced posting lists.

Centroids of a bounded sample cut the unit sphere into lists.  Every vector is
posted to the list of its nearest centroid and, if it lies near a boundary,
to those of further centroids within a distance ratio that are not nearer to
one already chosen than to the vector.  Centroids are searched by a beam over
an in-memory neighbour graph; a query visits all lists whose centroid lies
within a distance ratio of its nearest one.

A list is cut into blocks of vectors and the queries that visit it into
blocks of queries, so a crowded list is many tasks' work; equal vectors are
one posting with the few smallest ids that can be among the nearest.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import drop_written, written

#: Vectors of the fit at most, and their bytes; vectors per list, about.
MOST_SAMPLE, MOST_SAMPLE_BYTES, PER_LIST, SAMPLE_PER_LIST = 32_768, 1 << 25, 256, 16
#: A vector is posted within (1 + NEAR) of its least distance, to COPIES lists at most.
NEAR, COPIES = 0.15, 8
#: A query visits lists within (1 + VISIT) of its least distance.
VISIT = 0.2
#: Neighbours of a centroid in the graph, and random far ones.
DEGREE, FAR_LINKS, BEAM = 16, 8, 32
BLOCK_VECTORS, BLOCK_QUERIES = 4096, 1024
ROWS = 256
#: What rounding may part a product of unit vectors from the score, amply.
ROUNDING = 1e-9
#: Vectors of different lengths are searched apart, one after the other.
MOST_LENGTHS = 32


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cosine(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of some vectors with one, from wider sums, so that parallel vectors tie."""
    v, q = v.astype(np.longdouble), q.astype(np.longdouble)
    return ((v * q).sum(axis=1) / np.sqrt((v * v).sum(axis=1) * (q * q).sum())).astype(np.float64)


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0.0))


@dataclass
class Index:
    """Centroids (unit vectors) and their graph."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray

    def nearest(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For each unit vector ``width`` centroids found by beam search, the nearest
        first, and their distances."""
        n, k = len(x), len(self.centroids)
        width = min(width, k)
        rows = np.arange(n)[:, None]
        seen = np.zeros((n, k), dtype=bool)
        ids = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        cosine = x @ self.centroids[self.entries].T
        seen[rows, ids] = True
        done = np.zeros(ids.shape, dtype=bool)
        while True:
            order = np.argsort(-cosine, axis=1, kind="stable")[:, :width]
            ids, cosine, done = (np.take_along_axis(a, order, 1) for a in (ids, cosine, done))
            waiting = ~done & np.isfinite(cosine)
            if not waiting.any():
                break
            # Expand the best two that wait in each row; rows without any repeat a done one.
            best = np.argsort(~waiting, axis=1, kind="stable")[:, :2]
            done[rows, best] = True
            more = self.graph[np.take_along_axis(ids, best, 1)].reshape(n, -1)
            fresh = ~seen[rows, more]
            seen[rows, more] = True
            near = np.einsum("nd,nmd->nm", x, self.centroids[more])
            near[~fresh] = -np.inf
            # A centroid that two expansions name counts once.
            repeated = np.sort(more, axis=1)
            if (repeated[:, 1:] == repeated[:, :-1]).any():
                by_id = np.argsort(more, axis=1, kind="stable")
                same = np.take_along_axis(more, by_id, 1)
                twice = np.zeros(more.shape, dtype=bool)
                twice[:, 1:] = same[:, 1:] == same[:, :-1]
                near[np.take_along_axis(rows + 0 * more, by_id, 1)[twice], by_id[twice]] = -np.inf
            ids = np.concatenate((ids, more), axis=1)
            cosine = np.concatenate((cosine, near), axis=1)
            done = np.concatenate((done, np.zeros(more.shape, dtype=bool)), axis=1)
        return ids, _distance(np.where(np.isfinite(cosine), cosine, -7.0))

    def within(self, x: np.ndarray, ratio: float, width: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (row, centroid, distance) within ``1 + ratio`` of the row's least
        distance, nearest first; the beam widens until it reaches beyond the ratio."""
        out, rows = [], np.arange(len(x))
        while len(rows):
            ids, distance = self.nearest(x[rows], width)
            limit = (1 + ratio) * distance[:, :1]
            open_ = (distance[:, -1:] <= limit).ravel() & (width < len(self.centroids))
            keep = (distance <= limit) & ~open_[:, None]
            r, c = np.nonzero(keep)
            out.append((rows[r], ids[r, c], distance[r, c]))
            rows, width = rows[open_], width * 2
        parts = [np.concatenate(p) for p in zip(*out)] if out else [np.zeros(0, int), np.zeros(0, int), np.zeros(0)]
        order = np.lexsort((parts[2], parts[0]))
        return tuple(p[order] for p in parts)

    def postings(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, centroid): the lists of each unit vector."""
        row, centroid, distance = self.within(x, NEAR)
        begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else row
        rank = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
        keep = rank == 0
        chosen = np.full((len(x), COPIES), -1)
        chosen[row[keep], 0] = centroid[keep]
        count = np.ones(len(x), dtype=int)
        for r in range(1, int(rank.max(initial=0)) + 1):
            at = np.flatnonzero((rank == r) & (count[row] < COPIES))
            if not len(at):
                break
            mine = chosen[row[at]]
            between = _distance(np.einsum("nd,nmd->nm", self.centroids[centroid[at]], self.centroids[mine]))
            fits = ((mine < 0) | (between >= distance[at, None])).all(axis=1)
            at = at[fits]
            chosen[row[at], count[row[at]]] = centroid[at]
            count[row[at]] += 1
        r, c = np.nonzero(chosen >= 0)
        return r, chosen[r, c]


def build_index(sample: np.ndarray, lists: int, seed: int = 5, rounds: int = 8) -> Index:
    """Balanced spherical k-means of unit vectors, and the graph of its centroids.

    A crowded list's centroid is handicapped in the next round, in proportion
    to how far the list lies above the mean, so lists come out of like length.
    """
    rng = np.random.default_rng(seed)
    lists = max(1, min(lists, len(sample)))
    centroids = sample[rng.permutation(len(sample))[:lists]].copy()
    handicap = np.zeros(lists)
    for _ in range(rounds):
        at = np.concatenate([np.argmax(sample[i:i + 2048] @ centroids.T - handicap, axis=1)
                             for i in range(0, len(sample), 2048)])
        order = np.argsort(at, kind="stable")
        begin = np.flatnonzero(np.concatenate(([True], np.diff(at[order]) > 0)))
        sums = np.add.reduceat(sample[order], begin, axis=0)
        norm = np.sqrt((sums * sums).sum(axis=1))
        full = at[order][begin][norm > 0]
        centroids[full] = sums[norm > 0] / norm[norm > 0, None]
        size = np.bincount(at, minlength=lists)
        handicap = 0.02 * np.clip(size / size.mean() - 1, 0, 5)
        empty = np.flatnonzero(size == 0)
        centroids[empty] = sample[rng.integers(0, len(sample), len(empty))]
    links = []
    for i in range(0, lists, 512):
        cosine = centroids[i:i + 512] @ centroids.T
        links.append(np.argsort(-cosine, axis=1, kind="stable")[:, :DEGREE + 1])
    near = np.concatenate(links)
    far = rng.integers(0, lists, (lists, FAR_LINKS))
    return Index(centroids, np.concatenate((near, far), axis=1), rng.permutation(lists)[:min(lists, BEAM)])


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors as arrays of doubles, without null, zero and non-finite ones.

    Each is divided by a power of two near its largest component, which changes
    no cosine and no digit of one, so that squares neither overflow nor vanish.
    """
    v = F.col("embedding").cast("array<double>")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
              .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~odd)
              .filter(F.exists("v", lambda x: x != 0)))
    most = F.array_max(F.transform("v", F.abs))
    unit = F.pow(F.lit(2.0), F.least(F.lit(1023), F.floor(F.log2(most)))).alias("unit")
    usable = usable.select("vec_id", "v", F.inline(F.array(F.struct(unit))))  # computed once a row
    return usable.select("vec_id", F.transform("v", lambda x: x / F.col("unit")).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def _blocked(per_list: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(per_list / size)).cast("int")


def search(vectors: DataFrame, is_query: Column, k: int = 5, per_list: int = PER_LIST, visit: float = VISIT,
           seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query row.

    Queries are the rows of ``vectors`` (vec_id, embedding) for which
    ``is_query`` holds; candidates are all rows but those with the query's
    vec_id.  The score is the cosine of the original vectors in double
    precision, whatever the vectors' magnitudes; ties go to the smaller vec_id.
    Vectors that are null, zero, or hold null or non-finite numbers and rows
    without vec_id take no part; of several query rows with one vec_id the
    least vector asks.  A vector is a candidate for those of its own length, as
    no cosine joins two lengths; more than ``MOST_LENGTHS`` lengths are refused.
    With fewer candidates than ``k`` all are returned; an empty table gives none.
    """
    usable = _usable(vectors)
    sizes = (usable.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), "d").limit(MOST_LENGTHS + 1).collect())
    if len(sizes) > MOST_LENGTHS:
        raise ValueError(f"vectors of more than {MOST_LENGTHS} lengths")
    found = [_search(usable.filter(F.size("v") == d), is_query, k, d, n, per_list, visit, seed)
             for d, n in sizes or [(1, 0)]]
    if len(found) == 1:
        return found[0]
    all_ = functools.reduce(DataFrame.unionByName, found)  # a query row of each length may bear one vec_id
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return all_.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(usable: DataFrame, is_query: Column, k: int, d: int, n: int, per_list: int, visit: float,
            seed: int) -> DataFrame:
    """:func:`search` among the ``n`` rows (vec_id, v) of length ``d``."""
    spark = usable.sparkSession
    # Equal vectors are one posting; only the smallest ids can be among the nearest.
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    points = written(usable.distinct().withColumn("nth", nth).filter(F.col("nth") <= k + 1)
                     .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "points")
    queries = written(usable.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")

    most = min(MOST_SAMPLE, max(1, MOST_SAMPLE_BYTES // (8 * d)))
    sample = points.orderBy(F.xxhash64(F.col("ids")[0], F.lit(seed)), "ids").limit(most).select("v").toPandas()
    sample = np.array(sample["v"].tolist(), dtype=float).reshape(-1, d)
    index = build_index(_unit(sample), min(n // per_list, len(sample) // SAMPLE_PER_LIST), seed) if n else None
    shared = spark.sparkContext.broadcast(index)  # bounded by the sample

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                row, centroid = shared.value.postings(_unit(_matrix(part.column("v"))))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(centroid.astype(np.int32)), part.column("ids").take(at),
                                                  part.column("v").take(at)], ["list", "ids", "v"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                row, centroid, _ = shared.value.within(_unit(_matrix(part.column("v"))), visit)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(centroid.astype(np.int32)), part.column("vec_id").take(at),
                                                  part.column("v").take(at)], ["list", "query_id", "v"])

    posted = written(points.mapInArrow(post, "list int, ids array<long>, v array<double>"), "postings")
    asked = written(queries.mapInArrow(ask, "list int, query_id long, v array<double>"), "visits")
    # One row per list, bounded by the index.
    blocks = (posted.groupBy("list").agg(F.count("*").alias("n"))
              .join(asked.groupBy("list").agg(F.count("*").alias("q")), "list")
              .select("list", _blocked(F.col("n"), BLOCK_VECTORS).alias("nb"),
                      _blocked(F.col("q"), BLOCK_QUERIES).alias("qb")))
    blocks = F.broadcast(blocks)
    left = (posted.join(blocks, "list")
            .withColumn("b", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("nb")).cast("int"))
            .select("list", "b", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("c"), "ids", "v"))
    right = (asked.join(blocks, "list")
             .withColumn("c", F.pmod(F.xxhash64("query_id"), F.col("qb")).cast("int"))
             .select("list", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"), "c", "query_id", "v"))

    def compare(vs: pa.Table, qs: pa.Table) -> pa.Table:
        v, q = _matrix(vs.column("v")), _matrix(qs.column("v"))
        if not len(v) or not len(q):
            return _found([], [], [])
        vn, qn = np.sqrt((v * v).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
        ids = vs.column("ids").combine_chunks()
        first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
        keep = min(len(v), k + 1)
        out_q, out_v, out_s = [], [], []
        for i in range(0, len(q), ROWS):
            cosine = (q[i:i + ROWS] / qn[i:i + ROWS, None]) @ (v / vn[:, None]).T
            # All that may be among the first ``keep`` once scores are exact, ties included.
            least = np.partition(cosine, len(v) - keep, axis=1)[:, len(v) - keep] - ROUNDING
            for j, (row, limit) in enumerate(zip(cosine, least), i):
                cand = np.flatnonzero(row >= limit)
                score = _cosine(v[cand], q[j])
                order = np.lexsort((first[cand], -score))[:k + 1]
                out_q.append(np.full(len(order), j))
                out_v.append(cand[order])
                out_s.append(score[order])
        at = np.concatenate(out_q)
        return _found(qs.column("query_id").combine_chunks().take(pa.array(at)),
                      ids.take(pa.array(np.concatenate(out_v))), np.concatenate(out_s))

    def _found(query_id, ids, score) -> pa.Table:
        return pa.table([pa.array(query_id, pa.int64()), pa.array(ids, pa.list_(pa.int64())),
                         pa.array(score, pa.float64())], names=["query_id", "ids", "score"])

    keys = ["list", "b", "c"]
    near = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
            .applyInArrow(compare, "query_id long, ids array<long>, score double")
            .select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id").distinct())
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = written(near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                  .select("query_id", "rank", "vec_id", "score"), "nearest")
    drop_written(points, queries, posted, asked)
    return out
