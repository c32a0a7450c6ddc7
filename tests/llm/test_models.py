"""Classifier, nearest neighbours, mixing, sharding and the pipeline."""

from __future__ import annotations

import bisect
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rillet.llm import ann, mixing, quality, queries, sharding
from rillet.llm.common import DOC_COLUMNS
from tests.llm.fixtures import documents, empty, rows
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.01"


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_quality_on_held_out_rows(spark):
    scored = {r.doc_id: r for r in queries.op1_quality(spark, SF).collect()}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.doc_id in scored]
    assert len(scored) == 1000
    for r in scored.values():
        assert r.held_out == held_out(r.doc_id)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    out = [r for r in labels if held_out(r.doc_id)]
    assert len(out) > 50
    assert np.mean([scored[r.doc_id].predicted == r.quality for r in out]) > 0.95


def test_quality_does_not_see_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a, b = (quality.fit_on(docs, x, 200) for x in (labels, turned))
    assert all(np.array_equal(x, y) for x, y in zip(a.tables + a.pair_tables, b.tables + b.pair_tables))


def test_quality_of_odd_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(3, 1), (5, 0), (6, 1), (None, 1), (7, None), (8, 3), (100, 0), (100, 0), (19, 1),
                                    (999, 1)], "doc_id long, quality int")
    model = quality.fit_on(docs, labels)
    got = quality.score_documents(docs, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    assert all(0 <= r.score <= 1 for r in got)
    by_column = docs.select("doc_id", quality.score_column(model)("text").alias("s"), "score").collect()
    assert sorted((r.doc_id or -9, r.s) for r in by_column) == sorted((r.doc_id or -9, r.score) for r in got)
    for few in (labels.limit(0), labels.filter("quality = 1")):  # no labels, or one kind: a constant
        flat = {r.score for r in quality.score_documents(docs, quality.fit_on(docs, few)).collect()}
        assert len(flat) == 1
    assert quality.score_documents(empty(spark), quality.fit_on(empty(spark), labels)).count() == 0


def test_scores_equal_a_plain_loop(spark):
    """The additive model, document by document and table by table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit_on(docs, spark.read.parquet(f"{SF}/labels.parquet"), 400)
    assert model.pairs and any(len(t) > 2 for t in model.tables)
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    for r in quality.score_documents(docs, model).collect():
        x = [float(v) for v in quality.features(texts[r.doc_id].encode())]
        total = model.base
        for value, edges, table in zip(x, model.edges, model.tables):
            total += table[bisect.bisect_right(edges.tolist(), value)]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[bisect.bisect_right(model.pair_edges[a].tolist(), x[a]),
                           bisect.bisect_right(model.pair_edges[b].tolist(), x[b])]
        assert math.isclose(r.score, 1 / (1 + math.exp(-total)), rel_tol=1e-9, abs_tol=1e-12)


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    alone = quality.fit(x[:3000], y[:3000], n_pairs=0)
    assert ((alone.score(x[3000:]) > 0.5) == y[3000:]).mean() < 0.7


def exact_nearest(vectors: dict, q: int, k: int) -> list:
    v = vectors[q]
    found = []
    for other, u in vectors.items():
        if other != q:
            found.append((-(float((u * v).sum()) / (math.sqrt((u * u).sum()) * math.sqrt((v * v).sum()))), other))
    return [o for _, o in sorted(found)[:k]]


def test_ann_recall_and_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, dtype=float) for r in table.collect()}
    got = defaultdict(list)
    for r in ann.search(table, F.col("vec_id") % 50 == 0, 5, per_list=40).collect():
        got[r.query_id].append(r)
    assert set(got) == {v for v in vectors if v % 50 == 0}
    hits = 0
    for q, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == [1, 2, 3, 4, 5]
        assert [r.vec_id for r in found] == [r.vec_id for r in sorted(found, key=lambda r: (-r.score, r.vec_id))]
        hits += len({r.vec_id for r in found} & set(exact_nearest(vectors, q, 5)))
        for r in found:
            a, b = vectors[q], vectors[r.vec_id]
            assert abs(r.score - float(a @ b) / float(np.linalg.norm(a) * np.linalg.norm(b))) < 1e-12
    assert hits >= 0.9 * 5 * len(got)


def test_ann_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 7)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(1)
    table = [(i, rng.standard_normal(4).tolist(), "x") for i in range(60)]
    table += [(100 + i, [1.0, 2.0, 3.0, 4.0], "same") for i in range(40)]
    table += [(200, None, "x"), (201, [0.0] * 4, "x"), (202, [1.0, None, 0.0, 0.0], "x"), (250, [float("nan")] * 4, "x"),
              (203, [float("inf"), 0.0, 0.0, 0.0], "x"), (None, [1.0, 0.0, 0.0, 0.0], "x"), (204, [1.0, 2.0], "x"),
              (205, [], "x"), (7, table[7][1], "x")]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, score string").repartition(3)
    good = {i: np.array(v) for i, v, _ in table if i is not None and v and len(v) == 4 and None not in v
            and np.isfinite(v).all() and any(v)}
    got = defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 10 == 0, 5, per_list=10, visit=10.0).collect():
        got[r.query_id].append((r["rank"], r.vec_id))
    assert set(got) == {i for i in good if i % 10 == 0}
    for q, found in got.items():
        mine, best = [v for _, v in sorted(found)], exact_nearest(good, q, 5)
        assert len(mine) == 5 and q not in mine
        if q < 100:  # far from ties of rounding
            assert mine == best
    assert [v for _, v in sorted(got[100])] == [101, 102, 103, 104, 105]
    assert [v for _, v in sorted(got[130])] == [100, 101, 102, 103, 104]


def test_ann_ties_of_parallel_vectors(spark):
    """All scores are 1: the smallest ids are the nearest, whatever the lengths."""
    base = np.array([0.3, -0.7, 0.2])
    rows = [(i, (base * (1 + (i * 37) % 61)).tolist()) for i in range(61)]
    rows += [(100 + i, [1.0, 0.1 * i, 0.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = ann.search(df, F.col("vec_id") == 0, 5, per_list=20, visit=10.0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(i, 1.0) for i in (1, 2, 3, 4, 5)]


def test_ann_magnitudes(spark):
    rows = [(0, [1.0, 0.0]), (1, [1e200, 0.0]), (2, [1e-200, 1e-202]), (3, [-1e308, 1e308]), (4, [5e-324, 0.0]),
            (5, [0.0, 1.7e308]), (6, [3e-310, 4e-310])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in ann.search(df, F.col("vec_id") == 0, 9).collect()}
    wanted = {1: 1.0, 2: 1 / np.sqrt(1.0001), 3: -np.sqrt(0.5), 4: 1.0, 5: 0.0, 6: 0.6}
    assert got.keys() == wanted.keys()
    assert all(abs(got[i] - wanted[i]) < 1e-9 for i in wanted)


def test_ann_lengths_are_searched_apart(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(2 + i % 3).tolist()) for i in range(60)] + [(0, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, 4, per_list=10, visit=10.0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in (0, 20, 40):
        a = np.array(rows[q][1])
        score = {i: (a @ v) / np.linalg.norm(a) / np.linalg.norm(v) for i, v in rows[:60]
                 if len(v) == len(a) and i != q}
        assert sorted(got[q]) == list(enumerate(sorted(score, key=lambda i: (-score[i], i))[:4], 1))


def test_ann_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema), F.col("vec_id") % 2 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0])], schema)
    assert [tuple(r) for r in ann.search(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 0.0)]
    assert ann.search(two.limit(1), F.col("vec_id") >= 0).count() == 0


def test_graph_search_equals_a_full_scan():
    rng = np.random.default_rng(2)
    index = ann.build_index(ann._unit(rng.standard_normal((3000, 8))), 150)
    x = ann._unit(rng.standard_normal((200, 8)))
    ids, distance = index.nearest(x, 32)
    full = np.argsort(-(x @ index.centroids.T), axis=1)
    assert np.mean(ids[:, 0] == full[:, 0]) > 0.98 and (np.diff(distance, axis=1) >= 0).all()
    row, centroid, d = index.within(x, 0.3)
    truth = ann._distance(x @ index.centroids.T)
    want = {(r, c) for r, c in zip(*np.nonzero(truth <= 1.3 * truth.min(axis=1, keepdims=True)))}
    have = set(zip(row.tolist(), centroid.tolist()))
    assert len(have) == len(row) and len(want & have) > 0.98 * len(want)
    row, centroid = index.postings(x)
    assert set(row.tolist()) == set(range(200)) and np.bincount(row).max() <= ann.COPIES


def filled(sizes: list[int], weights, most) -> list[float]:
    """Water-filling by the definition: clamp, share again, until none is above."""
    capped: set[int] = set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = sum(sizes) - sum(most * sizes[i] for i in capped)
        total = sum(weights[i] for i in free)
        level = left / total if total else 0.0
        above = {i for i in free if weights[i] * level > most * sizes[i]}
        if not above:
            return [most * s if i in capped else weights[i] * level for i, s in enumerate(sizes)]
        capped |= above


@pytest.mark.parametrize("sizes", [[10, 1000, 5, 800], [1, 1, 1, 1000], [3], [0, 0, 7], [5, 4, 3, 2, 1, 500, 1]])
def test_water_filling(spark, sizes):
    table = [(i, f"s{i}", "w " * n) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(table, "doc_id long, source string, text string")
    got = {r.doc_id: r for r in mixing.mix_report(df).collect()}
    want = filled(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 3)
    for i, t in enumerate(want):
        assert got[i].size == got[i].source_size == sizes[i]
        assert got[i].target == pytest.approx(t)
        assert got[i].taken <= 3 * sizes[i]


def test_mix_comes_near_targets_and_is_repeatable(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    a, b = ([tuple(r) for r in mixing.mix_report(d).sort("doc_id").collect()] for d in (docs, docs.repartition(7)))
    assert a == b
    by_target = defaultdict(list)
    for _, size, source_size, target, taken in a:
        assert taken % max(size, 1) == 0 and taken <= 3 * size
        by_target[source_size, target].append(taken)
    for (_, target), taken in by_target.items():
        assert abs(sum(taken) - target) < 0.01 * target


def test_mix_equals_its_sql(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 4)  # several levels of buckets
    assert compare(queries.op5_mixing(spark, SF), duck(SF), queries.ORACLE_SQL["op5_mixing"]) == 1000


def test_mix_of_odd_rows(spark):
    docs = documents(spark)
    got = mixing.mix_report(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    size = {(d, len((t or "").encode().split())) for d, t, *_ in rows()}
    assert {(r.doc_id, r["size"]) for r in got} == size
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = sum(r.taken for r in got)
    assert mixed.select(F.sum(mixing.n_words(F.col("text")))).first()[0] == want
    assert mixing.mix_report(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0


def check_shards(got, table, shards):
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in table)
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_shards_of_odd_rows(spark):
    got = sharding.assign(documents(spark), 4).collect()
    check_shards(got, rows(), 4)
    by_text = defaultdict(set)
    for r in got:
        by_text[r.text_crc32, r["size"]].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    assert sharding.assign(empty(spark)).count() == 0


def test_shards_are_balanced_and_split_large_groups(spark):
    rng = np.random.default_rng(4)
    table = [(i, "w" * int(rng.integers(1, 400))) for i in range(4000)] + [(9000 + i, "the same " * 30) for i in range(3000)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    got = sharding.assign(df, 8).collect()
    check_shards(got, table, 8)
    size, n = np.zeros(8), np.zeros(8)
    for r in got:
        size[r.shard] += r["size"]
        n[r.shard] += 1
    assert size.max() / size.mean() < 1.05 and size.min() / size.mean() > 0.95
    assert n.max() / n.mean() < 1.3
    assert sorted(tuple(r) for r in sharding.assign(df.repartition(9), 8).collect()) == sorted(tuple(r) for r in got)


def test_shards_equal_a_step_by_step_packer(spark):
    """Items in order of their largest share, each where the dot product with what is left is highest."""
    rng = np.random.default_rng(9)
    table = [(i, " ".join("w" * int(rng.integers(1, 9)) for _ in range(int(rng.integers(0, 60))))) for i in range(1500)]
    table += [(9000 + i, "the same words " * 20) for i in range(500)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    shards = 6
    found = {r.doc_id: r.shard for r in sharding.assign(df, shards).collect()}
    rows_ = sharding._measured(df)
    large, share = sharding._large_groups(rows_, shards)
    items = defaultdict(lambda: [0, 0, 0, set()])
    for r in sharding._bundled(rows_, large).collect():
        item = items[r.bundle]
        for j, v in enumerate((r["size"], r.tokens, 1)):
            item[j] += v
        item[3].add(r.doc_id)
    totals = [sum(it[j] for it in items.values()) / shards for j in range(3)]
    assert np.allclose(totals, share)
    left = [[1.0, 1.0, 1.0] for _ in range(shards)]
    shares = {b: [it[j] / share[j] for j in range(3)] for b, it in items.items()}
    for bundle in sorted(items, key=lambda b: (-max(shares[b]), b)):
        item = shares[bundle]
        dot = [sum(l * v * w for l, v, w in zip(rest, item, sharding.WEIGHTS)) for rest in left]
        best = {found[d] for d in items[bundle][3]}
        assert len(best) == 1  # an item stays together
        best = best.pop()
        assert math.isclose(dot[best], max(dot), rel_tol=1e-9, abs_tol=1e-12)
        left[best] = [l - v for l, v in zip(left[best], item)]


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = documents(spark)
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows()) and set(back.columns) == set(docs.columns)
    have = {(r.doc_id, r.text, r.shard) for r in back.collect()}
    want = {(r.doc_id, r.text_crc32, r.shard) for r in sharding.assign(docs, 4).collect()}
    assert {(d, zlib.crc32((t or "").encode()), s) for d, t, s in have} == want


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    labels = spark.createDataFrame([(3, 1), (5, 0), (6, 1), (27, 0), (19, 1)], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(spark)
    for table in (docs, empty(spark)):
        got = table
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, got, str(tmp_path))
            if name != "pack_sequences":
                assert got.columns == list(DOC_COLUMNS)
                assert {r.doc_id for r in got.collect()} <= {r[0] for r in rows()}
        assert (got.count() > 0) == (table is docs)


def test_pipeline_catches_copies_and_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = {r.text: r.doc_id for r in docs.sort(F.desc("doc_id")).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {}
    got = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        got = stage(spark, got, SF)
        kept[name] = {r.doc_id for r in got.collect()}
    rejected = {r.doc_id for r in docs.collect()} - kept["quality_classifier"]
    judged = [(d not in rejected) == (q == 1) for d, q in labels.items()]
    assert np.mean(judged) > 0.97
    copies = {r.doc_id for r in docs.collect() if first[r.text] != r.doc_id}
    assert copies and not copies & kept["near_duplicates"]
    clean = {d for d in set(first.values()) - rejected if labels.get(d) == 1}
    assert len(kept["near_duplicates"] & clean) > 0.95 * len(clean)


def test_pipeline_rows_are_whole(spark):
    pieces = corpus_pipeline.run(spark, SF).collect()
    length = defaultdict(int)
    for p in pieces:
        assert len(p.ids) == 2 * p.length and zlib.crc32(np.frombuffer(p.ids, "<u2").astype("<u4").tobytes()) == p.ids_crc32
        length[p.sequence_id] += p.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in length.values())
    whole = {p.doc_id: p.doc_tokens for p in pieces}
    total = defaultdict(int)
    for p in pieces:
        total[p.doc_id] += p.length
    assert all(total[d] % n == 0 and 1 <= total[d] // n <= 3 for d, n in whole.items())
