"""Clustering with drifting bounds: against comparing every vector, in whole numbers."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillet.llm import clusters


def brute(vectors, k, rounds, dim, scale, seed):
    """(vec_id, cluster, distance) of each kept vector, and the centroids: plain rounds."""
    kept = []
    for vec_id, v in vectors:
        if v is None or len(v) != dim or any(e is None or not np.isfinite(e) for e in v):
            continue
        kept.append((vec_id, [int(np.floor(np.float64(e) * scale)) for e in v]))
    name = [hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    order = sorted(range(len(kept)), key=lambda j: (name[j], kept[j][1]))
    centroids = [kept[j][1] for j in order[:k]]

    def assign():
        out = []
        for vec_id, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((vec_id, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = [a for _, a, _ in assign()]
        for c in range(len(centroids)):
            mine = [x for (_, x), a in zip(kept, at) if a == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return assign(), centroids


def table(spark, vectors):
    rows = [(i, v, "x", 0) for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, block string, cluster int").repartition(3)


def check(spark, vectors, k, rounds, dim, scale=1024, seed=3):
    found = clusters.cluster(table(spark, vectors), k, rounds, dim, scale, seed)
    wanted, centroids = brute(vectors, k, rounds, dim, scale, seed)
    got = [tuple(r) for r in found.rows.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert found.centroids.tolist() == centroids
    return found


def blobs(n, dim, seed, spread=0.05, centers=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, dim))
    x = middle[rng.integers(0, centers, n)] + spread * rng.normal(size=(n, dim))
    return [(i, row.tolist()) for i, row in enumerate(x)]


def test_clustered_vectors_and_skipped_work(spark, monkeypatch):
    monkeypatch.setattr(clusters, "BLOCK", 32)
    found = check(spark, blobs(400, 6, 1), 5, 10, 6)
    assert found.scanned[0] == 400 and sum(found.scanned[1:]) < 0.5 * 400 * len(found.scanned[1:])
    check(spark, blobs(300, 4, 2, spread=1.0), 8, 10, 4)


def test_odd_rows(spark):
    odd = [(1, None), (2, [1.0]), (3, [0.5, float("nan")]), (4, [float("inf"), 0.0]), (5, [None, 1.0]), (6, []),
           (None, [0.25, -0.3]), (None, [0.25, -0.3]), (7, [0.25, -0.3]), (7, [0.25, -0.3]), (8, [-1e-9, 1e-9]),
           (9, [1e-300, -1e-300]), (10, [50.0, -50.0]), (11, [0.0, 0.0]), (12, [-0.0, 0.0])]
    for k, rounds in ((3, 4), (8, 10), (50, 2), (1, 3), (2, 0)):
        check(spark, odd, k, rounds, 2)


def test_ties_go_to_the_smaller_number(spark):
    grid = [(i, [float(i % 5), float(i // 5)]) for i in range(25)] * 2
    for seed in range(3):
        check(spark, grid, 6, 5, 2, 1, seed)


def test_empty_and_too_large(spark):
    found = clusters.cluster(table(spark, [(1, [1.0]), (2, None)]), 8, 10, 2)
    assert clusters.with_inertia(found).collect() == [] and found.scanned == []
    with pytest.raises(Exception, match="64 bits"):
        clusters.cluster(table(spark, [(1, [1e30, 0.0])]), 2, 1, 2)
    with pytest.raises(Exception, match="64 bits"):
        clusters.cluster(table(spark, [(1, [0.0, -1e30])]), 2, 1, 2)


def test_inertia(spark):
    found = clusters.cluster(table(spark, blobs(100, 3, 4)), 4, 3, 3)
    rows = clusters.with_inertia(found).collect()
    assert {r.inertia for r in rows} == {sum(r.distance for r in rows)}
    for r in rows:
        assert r.cluster_inertia == sum(q.distance for q in rows if q.cluster == r.cluster)
        text = ",".join(map(str, found.centroids[r.cluster].tolist()))
        assert r.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()


COORD = st.floats(-50, 50, allow_nan=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(COORD, min_size=3, max_size=3), st.lists(COORD, min_size=3, max_size=3),
       st.lists(COORD, min_size=3, max_size=3), st.floats(0, 80), st.integers(0, 2 ** 32 - 1))
def test_no_point_of_the_sphere_gains_more(center, old, new, radius, seed):
    center, old, new = (np.array(v) for v in (center, old, new))
    bound = clusters.loosening(center, radius, old, new)
    assert 0 <= bound <= np.linalg.norm(new - old) * (1 + 1e-12)
    rng = np.random.default_rng(seed)
    way = rng.normal(size=(500, 3))
    x = center + radius * way / np.linalg.norm(way, axis=1, keepdims=True)
    gain = np.linalg.norm(x - old, axis=1) - np.linalg.norm(x - new, axis=1)
    assert gain.max() <= bound + 1e-6 * max(1.0, bound)


def test_bound_is_less_than_the_move():
    origin = np.zeros(2)
    aside = clusters.loosening(np.array([10.0, 0.0]), 1.0, origin, np.array([0.0, 1.0]))
    assert 0 < aside < 0.2
    assert clusters.loosening(np.array([-10.0, 0.0]), 1.0, origin, np.array([1.0, 0.0])) < 1e-8
    assert clusters.loosening(np.array([10.0, 0.0]), 1.0, origin, np.array([1.0, 0.0])) == 1


def test_plan_shuffles_neither_side(spark):
    stored = clusters._Buckets(spark, 4)
    blocks = stored.save(spark.range(40).selectExpr("id AS block", "array(id) AS ids", "cast('' AS binary) AS x")
                         .repartition(4, "block"))
    bounds = stored.save(spark.range(40).selectExpr("id AS block", "cast('' AS binary) AS cluster",
                                                    "cast('' AS binary) AS upper", "cast('' AS binary) AS lower")
                         .repartition(4, "block"))
    plan = clusters._joined(blocks, bounds)._jdf.queryExecution().executedPlan().toString()
    stored.drop()
    assert "ShuffledHashJoin" in plan and "Exchange" not in plan
