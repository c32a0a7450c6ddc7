"""Centroid clustering in whole numbers, with bounds that follow the centroids' moves.

Every vector keeps an upper bound of the distance to its centroid and a lower
bound of the distance to all others.  When centroids move, the upper bound
grows by its centroid's move.  The lower bound shrinks by the most that a move
can gain on any point of the cluster's sphere, which plane geometry tells and
which is less than the whole move (see :func:`loosening`).  Vectors whose bounds
stay apart keep their cluster unseen; the others are compared with all
centroids in whole numbers, so the result is that of comparing every vector.

Vectors are written once, as blocks in buckets by block number.  A round joins
them with the bounds of the round before, in the same buckets, which shuffles
neither, and writes new bounds, about a tenth of the vectors' size, beside what
vectors that changed their cluster add to its sums.  The driver holds centroids
and sums only.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm.common import written
from rillet.session import delete_path, scratch_path

#: Vectors of a block (an Arrow batch holds a thousand blocks); bytes of vectors in a bucket, about.
BLOCK, BUCKET_BYTES = 256, 1 << 27
#: Components reach this size at most, so that squared distances fit into 64 bits.
LARGEST = 1 << 27
#: Bounds are widened by this share, far above what rounding may take.
SLACK = 1e-9

VECTORS = "block long, ids array<long>, x binary"
BOUNDS = "block long, cluster binary, upper binary, lower binary, radius array<double>, delta array<long>, scanned long"


@dataclass
class Move:
    """Centroids of a round, how far each came, and what that takes from lower bounds."""

    centroids: np.ndarray  # whole numbers
    drift: np.ndarray
    loosen: np.ndarray


@dataclass
class Clustering:
    """``rows`` (vec_id, cluster, distance), the final centroids, and how many
    vectors each round compared with all centroids."""

    rows: DataFrame
    centroids: np.ndarray
    scanned: list[int]


def loosening(center: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """The most by which any point within ``radius`` of ``center`` comes nearer to a
    centroid that moves from ``old`` to ``new``.

    With o midway between old and new, D the move's length and x a point whose
    direction from o makes the angle t with the move:
    ``|x-old| - |x-new| = 2 D |x-o| cos t / (|x-old| + |x-new|)``, and the sum below
    is at least ``2 |x-o|``, so the gain is at most ``D cos t``.  Seen from o the
    sphere fills the angles that differ from its centre's by ``asin(radius / |center-o|)``
    at most; the least of them gives the bound.  Only the plane through centre,
    old and new matters.
    """
    move = new - old
    length = math.sqrt(float(move @ move))
    if length == 0:
        return 0.0
    to_center = center - (old + new) / 2
    square = float(to_center @ to_center)
    along = float(to_center @ move) / length
    aside = math.sqrt(max(square - along * along, 0.0))
    if radius * radius >= square or (aside <= radius and along >= 0):
        return length  # the sphere holds o or a point straight ahead
    cosine = (along * math.sqrt(square - radius * radius) + aside * radius) / square
    return length * min(max(cosine, 0.0) + SLACK, 1.0)


def moved(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Move:
    """The move of all centroids; ``radius``: of the sphere that holds each cluster."""
    a, b = old.astype(float), new.astype(float)
    drift = np.sqrt(((a - b) ** 2).sum(axis=1)) * (1 + SLACK)
    k = len(a)
    loosen = np.array([max((loosening(a[i], float(radius[i]), a[j], b[j]) for j in range(k) if j != i), default=0.0)
                       for i in range(k)])
    return Move(new, drift, loosen * (1 + SLACK))


def squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids, exact."""
    out = np.empty((len(x), len(centroids)), dtype=np.int64)
    for j, c in enumerate(centroids):
        gap = x - c
        out[:, j] = np.einsum("nd,nd->n", gap, gap)
    return out


def scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centroid of each row (ties: the smaller number) and its bounds."""
    d = squares(x, centroids)
    at = d.argmin(axis=1).astype(np.int32)
    rows = np.arange(len(x))
    upper = np.sqrt(d[rows, at].astype(float)) * (1 + SLACK)
    d[rows, at] = np.iinfo(np.int64).max
    lower = np.sqrt(d.min(axis=1).astype(float)) * (1 - SLACK) if len(centroids) > 1 else np.full(len(x), np.inf)
    return at, upper, lower


def reassign(x: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray, move: Move):
    """(cluster, upper, lower, how many were compared with all) after a move.

    Bounds that touch do not decide, so ties are always compared in whole numbers.
    """
    at, upper, lower = at.copy(), (upper + move.drift[at]) * (1 + SLACK), lower - move.loosen[at]
    doubtful = np.flatnonzero(upper >= lower)
    if len(doubtful):  # the distance to the own centroid first
        gap = x[doubtful] - move.centroids[at[doubtful]]
        upper[doubtful] = np.sqrt(np.einsum("nd,nd->n", gap, gap).astype(float)) * (1 + SLACK)
        doubtful = doubtful[upper[doubtful] >= lower[doubtful]]
    if len(doubtful):
        at[doubtful], upper[doubtful], lower[doubtful] = scan(x[doubtful], move.centroids)
    return at, upper, lower, len(doubtful)


def _delta(x: np.ndarray, old: np.ndarray | None, new: np.ndarray, k: int) -> list[int] | None:
    """What a block adds to the sums and counts of all clusters, one after the other; None if nothing."""
    changed = np.arange(len(x)) if old is None else np.flatnonzero(old != new)
    if not len(changed):
        return None
    one = np.concatenate((x[changed], np.ones((len(changed), 1), dtype=np.int64)), axis=1)
    out = np.zeros((k, one.shape[1]), dtype=np.int64)
    np.add.at(out, new[changed], one)
    if old is not None:
        np.subtract.at(out, old[changed], one)
    return out.ravel().tolist()


def _matrix(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<i4").reshape(-1, dim).astype(np.int64)


def _bounds_row(block: int, x: np.ndarray, old, at, upper, lower, scanned: int, k: int) -> dict:
    radius = np.zeros(k)
    np.maximum.at(radius, at, upper)
    return {"block": block, "cluster": at.astype("<i4").tobytes(), "upper": upper.astype("<f8").tobytes(),
            "lower": lower.astype("<f8").tobytes(), "radius": radius.tolist(), "delta": _delta(x, old, at, k),
            "scanned": scanned}


def _pack(dim: int) -> Callable:
    """Rows (vec_id, x) as blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                if x.max() >= LARGEST or x.min() <= -LARGEST:
                    raise ValueError(f"a component reaches {LARGEST}: squared distances would not fit into 64 bits")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("vec_id")),
                     pa.array([x.astype("<i4").tobytes()], pa.binary())], ["block", "ids", "x"])
                block += 1
    return run


def _kept(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """(vec_id, x): vectors of ``dim`` finite components as whole numbers."""
    v = F.col("embedding").cast("array<double>")
    odd = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .filter((F.size("v") == dim) & ~odd)
            .select("vec_id", F.transform("v", lambda e: F.floor(e * F.lit(float(scale)))).alias("x")))


class _Buckets:
    """Tables in the same buckets by block number, under the scratch folder."""

    def __init__(self, spark: SparkSession, n: int):
        self.spark, self.n, self.made = spark, n, []

    def save(self, df: DataFrame) -> DataFrame:
        name = f"clusters_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, name)
        df.write.bucketBy(self.n, "block").option("path", path).saveAsTable(name)
        self.made.append((name, path))
        return self.spark.table(name)

    def drop(self, keep: int = 0) -> None:
        """Remove all tables but the first ``keep``."""
        for name, path in self.made[keep:]:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_path(self.spark, path)
        del self.made[keep:]


def cluster(vectors: DataFrame, k: int, rounds: int, dim: int = 64, scale: int = 1024, seed: int = 3) -> Clustering:
    """Cluster the rows of ``vectors`` (vec_id, embedding) around ``k`` centroids.

    A component x becomes floor(scale * x).  Rows whose vector is null, has not
    ``dim`` components or holds null or non-finite ones take no part.  The first
    centroids are the ``k`` vectors with the smallest sha256 of ``seed:vec_id`` (a
    null vec_id: ``null``; equal ones: the smaller vector first; all vectors if there
    are fewer).  Each of ``rounds`` rounds assigns every vector to the nearest
    centroid (ties: the smaller number) and moves each centroid that has
    vectors to the floor of their mean; then vectors are assigned once more.
    When no centroid moves any more the rounds left would change nothing and are
    not run.  Equal and repeated rows are rows of their own; an empty table
    gives none; scaled components of 2^27 and more fail the job, as their
    distances have no long.  Other columns go.
    """
    spark = vectors.sparkSession
    kept = _kept(vectors, dim, scale)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    first = kept.orderBy(F.sha2(name, 256), "x").limit(k).collect()
    if not first:
        return Clustering(spark.createDataFrame([], "vec_id long, cluster int, distance long"),
                          np.zeros((0, dim), dtype=np.int64), [])
    centroids = np.array([r.x for r in first], dtype=np.int64)
    k = len(centroids)

    blocks = written(kept.mapInArrow(_pack(dim), VECTORS), "vector_blocks")
    n = blocks.agg(F.sum(F.size("ids"))).first()[0]
    # Small tables go by the session's partitions, large ones by their size.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n * dim * 4 / BUCKET_BYTES))
    buckets = _Buckets(spark, parts)
    stored = buckets.save(blocks.repartition(parts, "block"))
    delete_path(spark, blocks.written_path)

    sums = np.zeros((k, dim + 1), dtype=np.int64)
    scanned: list[int] = []
    move = Move(centroids, np.zeros(k), np.zeros(k))
    bounds = None
    for _ in range(rounds):
        bounds = buckets.save(_round(stored, bounds, move, dim))
        if len(buckets.made) > 2:  # vectors, bounds of the round before, new bounds
            old = buckets.made.pop(1)
            spark.sql(f"DROP TABLE IF EXISTS {old[0]}")
            delete_path(spark, old[1])
        radius, delta, seen = _totals(bounds, k, dim)
        scanned.append(seen)
        sums += delta
        count = sums[:, -1:]
        target = np.where(count > 0, sums[:, :-1] // np.maximum(count, 1), centroids)
        move = moved(centroids, target, radius)
        if (target == centroids).all():
            break
        centroids = target
    rows = written(_final(stored, bounds, move, dim), "clustered")
    buckets.drop()
    return Clustering(rows, centroids, scanned)


def _joined(stored: DataFrame, bounds: DataFrame | None) -> DataFrame:
    if bounds is None:
        return stored
    # buckets meet buckets: no shuffle, and the smaller side is hashed, not sorted
    return stored.join(bounds.select("block", "cluster", "upper", "lower").hint("shuffle_hash"), "block")


def _blocks_of(batches: Iterable[pa.RecordBatch], dim: int, move: Move):
    """(row, x, old cluster or None, cluster, upper, lower, compared with all) of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]  # one block at a time
            x = _matrix(row["x"], dim)
            if "cluster" not in row:
                yield (row, x, None, *scan(x, move.centroids), len(x))
                continue
            old = np.frombuffer(row["cluster"], dtype="<i4")
            upper, lower = (np.frombuffer(row[c], dtype="<f8") for c in ("upper", "lower"))
            yield (row, x, old, *reassign(x, old, upper, lower, move))


def _round(stored: DataFrame, bounds: DataFrame | None, move: Move, dim: int) -> DataFrame:
    shared = stored.sparkSession.sparkContext.broadcast(move)  # k centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(shared.value.centroids)
        for row, x, old, at, upper, lower, seen in _blocks_of(batches, dim, shared.value):
            yield pa.RecordBatch.from_pylist([_bounds_row(row["block"], x, old, at, upper, lower, seen, k)],
                                             schema=_BOUNDS_ARROW)

    return _joined(stored, bounds).drop("ids").mapInArrow(run, BOUNDS)


_BOUNDS_ARROW = pa.schema([("block", pa.int64()), ("cluster", pa.binary()), ("upper", pa.binary()),
                           ("lower", pa.binary()), ("radius", pa.list_(pa.float64())),
                           ("delta", pa.list_(pa.int64())), ("scanned", pa.int64())])


def _totals(bounds: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Radius of every cluster, what its sums and count gain, vectors compared with all: k numbers each, or k times dim."""
    radius = np.zeros(k)
    for i, r in bounds.select(F.posexplode("radius").alias("i", "r")).groupBy("i").agg(F.max("r")).collect():
        radius[i] = r
    delta = np.zeros(k * (dim + 1), dtype=np.int64)
    for i, d in bounds.select(F.posexplode("delta").alias("i", "d")).groupBy("i").agg(F.sum("d")).collect():
        delta[i] = d
    return radius, delta.reshape(k, dim + 1), int(bounds.agg(F.sum("scanned")).first()[0])


def _final(stored: DataFrame, bounds: DataFrame | None, move: Move, dim: int) -> DataFrame:
    """(vec_id, cluster, distance) after the last move."""
    shared = stored.sparkSession.sparkContext.broadcast(move)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, x, _, at, *_ in _blocks_of(batches, dim, shared.value):
            gap = x - shared.value.centroids[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(at, pa.int32()),
                 pa.array(np.einsum("nd,nd->n", gap, gap), pa.int64())], ["vec_id", "cluster", "distance"])

    return _joined(stored, bounds).mapInArrow(run, "vec_id long, cluster int, distance long")


def with_inertia(found: Clustering) -> DataFrame:
    """``rows`` with cluster_inertia and inertia (distance summed over the cluster and
    over all) and centroid_sha256 (of the centroid's components, joined by commas)."""
    spark = found.rows.sparkSession
    per = found.rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows at most
    total = sum(r.cluster_inertia for r in per)
    named = [(r.cluster, r.cluster_inertia, total, ",".join(map(str, found.centroids[r.cluster].tolist())))
             for r in per]
    table = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid string")
    return (found.rows.join(F.broadcast(table), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                    F.sha2("centroid", 256).alias("centroid_sha256")))
