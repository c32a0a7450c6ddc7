"""Deduplication operators against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillet.llm import components, lines, simhash, substring
from rillet.llm.words import OF_WORDS, window_hashes, window_minima, words_of
from tests.llm.fixtures import documents, empty, lined, rows, words
from tests.oracle import compare, duck

WIDTH, MMER = 10, 3


def brute_substring(table, width):
    """Rows (doc_id, n_words, n_removed, kept) by the definition."""
    first: dict[tuple, int] = {}
    for d, t, *_ in table:
        w = (t or "").encode().split()
        for i in range(len(w) - width + 1 if d is not None else 0):
            k = tuple(w[i:i + width])
            first[k] = min(first.get(k, d), d)
    out = Counter()
    for d, t, *_ in table:
        w = (t or "").encode().split()
        covered = np.zeros(len(w), bool)
        for i in range(len(w) - width + 1 if d is not None else 0):
            if first[tuple(w[i:i + width])] < d:
                covered[i:i + width] = True
        kept = b" ".join(x for x, c in zip(w, covered) if not c).decode()
        out[d, len(w), int(covered.sum()), kept] += 1
    return out


def test_substring_against_brute_force(spark):
    got = Counter(tuple(r) for r in substring.remove_repeats(documents(spark), WIDTH, MMER).collect())
    assert got == brute_substring(rows(), WIDTH)
    assert sum(r[2] for r in got) > 0


def test_substring_with_frequent_mmers(spark, monkeypatch):
    table = [(i, " ".join(f"u{i}x{j}" for j in range(8)) + " common words that all texts share " * 3 + f" {i % 7} end", "en",
              "s", 0) for i in range(300)]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
    found = substring.frequent_mmers(df, MMER, share=100, least=10)
    assert 0 < len(found) <= 100
    monkeypatch.setattr(substring, "frequent_mmers", lambda docs, mmer: found)
    monkeypatch.setattr(substring, "CHUNK", 2000)
    monkeypatch.setattr(substring, "SLICE", 500)
    got = Counter(tuple(r) for r in substring.remove_repeats(df, WIDTH, MMER).collect())
    assert got == brute_substring(table, WIDTH)


@pytest.mark.parametrize("wide", [0, 400, 3000])
def test_substring_with_wide_buckets(spark, monkeypatch, wide):
    """All, some or few buckets are spread over tasks; one passage has very many surroundings."""
    passage = " ".join(f"p{j}" for j in range(WIDTH + 4))
    hot = [(1000 + i, f"left{i} of{i % 3} {passage} right{i} and {i % 5}", "en", "s", 0) for i in range(120)]
    table = rows() + hot
    df = documents(spark).unionByName(spark.createDataFrame(
        hot, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    monkeypatch.setattr(substring, "WIDE", wide)
    monkeypatch.setattr(substring, "SLICE", 500)
    got = Counter(tuple(r) for r in substring.remove_repeats(df, WIDTH, MMER).collect())
    assert got == brute_substring(table, WIDTH)


def test_substring_of_equal_hashes(monkeypatch):
    """Windows whose hashes collide are told apart by their bytes."""
    monkeypatch.setattr(substring, "window_hashes", lambda h, n: window_hashes(h, n) * np.uint64(0))
    packed = [b"a b c d", b"b c d e", b"x b c d"]
    first, offsets = substring._first_documents(packed, np.array([5, 3, 9]), 3)
    assert offsets.tolist() == [0, 2, 4, 6]
    assert first.tolist() == [5, 3, 3, 3, 9, 3]


def test_substring_of_empty_table(spark):
    assert substring.remove_repeats(empty(spark)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=80), st.integers(1, 60))
def test_window_helpers(values, width):
    v = np.array(values, dtype=np.uint64)
    want = [sum(x * pow(int(OF_WORDS), k, 1 << 64) for k, x in enumerate(values[i:i + width])) % (1 << 64)
            for i in range(len(values) - width + 1)]
    assert window_hashes(v, width).tolist() == want
    if len(v) >= width:
        assert window_minima(v, width).tolist() == [min(values[i:i + width]) for i in range(len(values) - width + 1)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=8))
def test_words_of(texts):
    w = words_of(texts)
    split = [t.split() for t in texts]
    assert w.counts.tolist() == [len(s) for s in split]
    flat = [x for s in split for x in s]
    assert [w.joined(k, 1) for k in range(len(flat))] == flat
    known: dict[bytes, int] = {}
    for x, h in zip(flat, w.hashes.tolist()):
        assert known.setdefault(x, h) == h
    assert len(set(known.values())) == len(known)


def brute_fingerprint(text: str | None, width: int = 3) -> int:
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = raw.split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def grouped(values, linked) -> dict:
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in values:
        for b in values:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_simhash_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 1000)
    table = [r for r in rows() if len(r[1] or "") < 50_000]
    df = documents(spark).filter("text is null or length(text) < 50000")
    fps = {id(r): brute_fingerprint(r[1]) for r in table}
    label = grouped(set(fps.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least: dict[int, int] = {}
    for r in table:
        if r[0] is not None:
            k = label[fps[id(r)]]
            least[k] = min(least.get(k, r[0]), r[0])
    want = Counter((r[0], f"{fps[id(r)]:016x}", least.get(label[fps[id(r)]])) for r in table)
    got = simhash.near_duplicates(df).select("doc_id", simhash.hex_of(F.col("fp")), "component_id")
    assert Counter(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_ball_links_connect_what_brute_force_links(spark, distance):
    rng = np.random.default_rng(3)
    base = rng.integers(-2**63, 2**63 - 1, 12)
    values = set(base.tolist())
    for b in base.tolist():
        for _ in range(12):
            v = b
            for bit in rng.integers(0, 64, rng.integers(1, 5)).tolist():
                v ^= -2**63 if bit == 63 else 1 << bit
            values.add(v)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.label for r in components.components(simhash.near_links(df, distance)).collect()}
    want = grouped(values, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= distance)
    assert {v: got.get(v, v) for v in values} == want


def test_one_of_each(spark):
    kept = simhash.one_of_each(documents(spark)).select("doc_id", "text", "th").collect()
    found = simhash.near_duplicates(documents(spark)).collect()
    assert len(kept) == len({r.label for r in found})
    assert {r.doc_id for r in kept} == {r.component_id for r in found}
    assert all(r.th == "?th" for r in kept)  # the table's own column
    assert simhash.one_of_each(empty(spark)).count() == 0
    nameless = spark.createDataFrame([(None, "same text here"), (None, "same text here")], "doc_id long, text string")
    assert simhash.one_of_each(nameless).count() == 1


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5, 5), (7, 3)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.label for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components.components(df.limit(0)).count() == 0


def line_chunks(text: str) -> list[str]:
    ls = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in ls]
    hit = [(x + 31 * (h[i - 1] if i else 0)) % 3 == 0 for i, x in enumerate(h)]
    ends = [i for i in range(1, len(ls) - 2) if hit[i] and not hit[i - 1]] + [len(ls) - 1]
    return ["\n".join(ls[a + 1:b + 1]) for a, b in zip([-1, *ends], ends)]


def brute_lines(table) -> Counter:
    first: dict[str, int] = {}
    repeatable = lambda c: "\n" in c and c.strip(" \t\n\x0b\x0c\r") != ""
    for d, t, *_ in table:
        for c in line_chunks(t or ""):
            if d is not None and repeatable(c):
                first[c] = min(first.get(c, d), d)
    out = Counter()
    for d, t, *_ in table:
        kept, seen = [], set()
        for c in line_chunks(t or ""):
            if d is None or not repeatable(c) or (first[c] >= d and c not in seen):
                kept.append(c)
            seen.add(c)
        n = len((t or "").split("\n"))
        left = sum(c.count("\n") + 1 for c in kept)
        out[d, n, n - left, "\n".join(kept)] += 1
    return out


def test_lines_against_brute_force(spark):
    got = Counter(tuple(r) for r in lines.remove_repeats(documents(spark)).collect())
    assert got == brute_lines(rows())
    assert sum(r[2] for r in got) > 0


def test_line_chunks_shift_with_the_text():
    text = rows()[12][1]
    moved = line_chunks("new line\n" + text)
    assert len(set(moved) & set(line_chunks(text))) >= len(line_chunks(text)) - 2


def test_lines_rewritten_keeps_columns(spark):
    docs = documents(spark)
    out = lines.rewritten(docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    kept = Counter((d, t) for (d, _, gone, t), n in brute_lines(rows()).items() for _ in range(n)
                   if not (gone and t == ""))
    got = out.collect()
    assert Counter((r.doc_id, r.text or "") for r in got) == kept
    assert sum(r.text is None for r in got) == sum(r[1] is None for r in rows())
    assert lines.rewritten(empty(spark)).count() == 0 and lines.remove_repeats(empty(spark)).count() == 0


def test_lines_of_repeated_rows_stay(spark):
    """Rows equal in doc_id and text take nothing from one another, only from earlier documents."""
    block, again = lined(21, 30), lined(22, 9) + "\n" + lined(22, 9)
    table = [(7, block), (7, block), (8, again), (8, again), (9, "head\nline\n" + block), (9, "head\nline\n" + block)]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in lines.remove_repeats(docs).collect())
    assert got == brute_lines(table)
    assert got[7, 30, 0, block] == 2
    assert sum(r.doc_id == 7 for r in lines.rewritten(docs).collect()) == 2


def runs_of(text: str, least: int) -> dict[tuple, set]:
    """Every run of lines with words, of ``least`` words or more, and the numbers of its lines."""
    ls = [(i, x) for i, x in enumerate(text.split("\n")) if x.encode().split()]
    out: dict[tuple, set] = {}
    for a in range(len(ls)):
        for b in range(a + 1, len(ls) + 1):
            if sum(len(x.encode().split()) for _, x in ls[a:b]) >= least:
                out.setdefault(tuple(x for _, x in ls[a:b]), set()).update(i for i, _ in ls[a:b])
    return out


def test_passages_against_brute_force(spark):
    """Short runs of lines, and one long line, between other lines."""
    long, run, blank = words(31, 60), lined(32, 9), lined(33, 6) + "\n \n" + lined(34, 6)
    around = lambda seed, x: lined(seed, 3) + "\n" + x + "\n" + lined(seed + 1, 4)
    table = [(1, around(40, long)), (2, around(42, run)), (3, around(44, long)), (4, around(46, run)), (4, None),
             (5, around(48, blank)), (6, around(50, blank.replace("\n \n", "\n"))), (7, run), (7, run),
             (8, run + "\n" + long + "\n\n"), (9, around(52, lined(32, 8))), (None, run), (10, words(35, 70) + "\n" + "x"),
             (10, words(35, 70)), (11, "\n".join(["y"] * 80)), (12, "z\n" + "\n".join(["y"] * 60)), (13, "")]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    runs = [(d, t, runs_of(t or "", 50)) for d, t in table]
    want = Counter()
    for d, t, own in runs:
        before = set().union(*(o for e, _, o in runs if None not in (d, e) and e < d)) if d is not None else set()
        gone = set().union(*(at for r, at in own.items() if r in before))
        n = 0
        for c in line_chunks(t or ""):
            first = [e for e, u in table if e is not None and c in line_chunks(u or "")]
            if d is not None and "\n" in c and c.split() and min(first) < d:
                gone.update(range(n, n + c.count("\n") + 1))
            n += c.count("\n") + 1
        left = [x for i, x in enumerate((t or "").split("\n")) if i not in gone]
        if not gone or "".join(left).split():
            want[d, "\n".join(left)] += 1
    got = lines.rewritten(docs, words=50).collect()
    assert Counter((r.doc_id, r.text or "") for r in got) == want
    assert (3, around(44, long).replace(long + "\n", "")) in want and (7, run) not in want


def test_lines_equal_their_sql_on_a_table_with_copies(spark):
    from rillet.llm import queries
    sf = "/root/testdata/sf0.001"
    assert compare(queries.op7_lines(spark, sf), duck(sf), queries.ORACLE_SQL["op7_lines"]) > 0


def test_chunks_are_computed_once_per_row(spark):
    """No lambda of the optimised plan holds a split, hash or window of its own."""
    plan = lines.chunked(empty(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 2 and plan.count("md5(") == 1


