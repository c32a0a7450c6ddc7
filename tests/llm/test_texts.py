"""Encoding, token files, packing, fingerprints: against direct computation."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rillet.llm import edit_fingerprint as ef
from rillet.llm import encode, packing, token_files
from rillet.session import scratch_path
from tests.llm.fixtures import documents, empty, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text: str | None, end: int) -> np.ndarray:
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], dtype="<u4")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(
    st.characters(max_codepoint=0x24F), st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sdé9² \x1c")), max_size=60),
    max_size=5))
def test_encoder_equals_library(texts):
    for mine, text in zip(encode.encoder(PATH).encode(texts), texts):
        assert mine.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_encoder_long_texts_and_forgetting(monkeypatch):
    monkeypatch.setattr(encode, "PIECE", 200)
    small = encode.Encoder(PATH, generation=50)
    for _ in range(2):
        for _, text, *_ in rows():
            text = (text or "")[:20_000]
            assert small.encode([text])[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert len(small.known) + len(small.old) < 20_000 and small.old is not None


def test_other_tokenizers_go_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    direct = Tokenizer.from_file(path)
    for text in ("Some Words, and MORE  of them", "", "naïve \n x"):
        assert encode.Encoder(path).encode([text])[0].tolist() == direct.encode(text, add_special_tokens=False).ids


def test_token_files_round_trip(spark):
    docs = documents(spark)
    manifest = token_files.write_tokens(docs, scratch_path(spark, "tokens"), PATH, 0, length=64, rows=4)
    got = [tuple(r) for r in token_files.read_documents(manifest).collect()]
    start, want = 0, defaultdict(Counter)
    for doc_id, text, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0])):
        want[doc_id][len(ids_of(text, 0)), crc(ids_of(text, 0))] += 1
    have = defaultdict(Counter)
    for doc_id, begin, n, c in sorted(got, key=lambda r: r[1]):
        assert begin == start
        start += n
        have[doc_id][n, c] += 1
    assert have == want
    order = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda d: (d is not None, d))


def test_token_file_sequences_are_views(spark):
    manifest = token_files.write_tokens(documents(spark), scratch_path(spark, "tokens"), PATH, 0, 64, 4).collect()
    for row in manifest:
        f = token_files.TokenFile(row.path)
        n = -(-row.n_tokens // 64)
        flat, masks = [], []
        for i in range(n):
            ids, mask = f.sequence(i)
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata
            flat.append(ids.copy())
            masks += mask.to_pylist()
        assert sum(masks) == row.n_tokens and all(masks[:row.n_tokens])
        docs = list(f.documents())
        assert sum(d[2] for d in docs) == row.n_tokens and len(docs) == row.n_docs
        whole = np.concatenate(flat)
        for _, begin, length in docs:
            assert np.array_equal(np.concatenate(list(f.runs(begin, length))), whole[begin:begin + length])


def test_token_files_of_empty_table(spark):
    manifest = token_files.write_tokens(empty(spark), scratch_path(spark, "tokens"), PATH, 0)
    assert manifest.count() == 0 and token_files.read_documents(manifest).count() == 0


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert_key(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        walk = grid[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_packing_covers_every_id_once(spark):
    pieces = packing.pack(documents(spark), PATH, 1, 256).collect()
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        assert crc(np.frombuffer(p.ids, "<u2")) == p.ids_crc32
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256 and at & (at - 1) == 0  # nothing to pad
    want = Counter((d, crc(ids_of(t, 1))) for d, t, *_ in rows())
    # Copies of a doc_id lie next to each other; put pieces together greedily.
    left = defaultdict(list)
    for p in pieces:
        left[p.doc_id].append(p)
    have = Counter()
    for doc_id, mine in left.items():
        mine.sort(key=lambda p: (p.doc_tokens, p.sequence_id, p.offset))
        open_ = []
        for p in mine:
            run = next((r for r in open_ if r[0] == p.start and r[1] == p.doc_tokens), None)
            if run is None:
                assert p.start == 0
                run = [0, p.doc_tokens, []]
                open_.append(run)
            run[0] += p.length
            run[2].append(np.frombuffer(p.ids, "<u2"))
        for at, n, ids in open_:
            assert at == n
            have[doc_id, crc(np.concatenate(ids))] += 1
    assert have == want


def test_packing_is_repeatable_and_keeps_copies_together(spark):
    docs = documents(spark)
    a, b = ([tuple(r) for r in packing.pack(docs, PATH, 1).sort("sequence_id", "offset").collect()] for _ in range(2))
    assert a == b
    assert packing.pack(empty(spark), PATH, 1).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, 1, 1000)


def slow_walk(text: str) -> list[int]:
    codes = np.array([ord(c) for c in text], dtype="<u4")
    j, out = 0, []
    for c in ef._class_of(codes):
        j += int(ef._dwell()[c, j & 4095])
        out.append(j)
    return out


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(max_size=50), min_size=1, max_size=40))
def test_walks_side_by_side_equal_single_walks(texts):
    codes, left, fps = ef._fingerprinted(texts)
    for t, mine, fp in zip(texts, left, fps):
        assert mine.tolist() == slow_walk(t)
        assert fp == ef._fingerprinted([t])[2][0]


def test_likeness_orders_edits():
    base = " ".join(rows()[19][1].split()[:2000])
    fp = ef._fingerprinted([base])[2][0]
    near = ef._fingerprinted([base[:3000] + "inserted" + base[3000:]])[2][0]
    half = ef._fingerprinted([base[:len(base) // 2] + base[:len(base) // 2][::-1]])[2][0]
    far = ef._fingerprinted([base[::-1]])[2][0]
    assert ef.likeness(fp, fp) == 1.0
    assert ef.likeness(fp, near) > 0.8 > ef.likeness(fp, half) > 0.35 > ef.likeness(fp, far)
    assert set(ef.band_keys(fp)) & set(ef.band_keys(near)) and not set(ef.band_keys(fp)) & set(ef.band_keys(far))
    blank = ef._fingerprinted([""])[2][0]
    assert ef.likeness(blank, blank) == 1.0 and ef.likeness(blank, fp) == 0.0


def test_compare_with_next_against_brute_force(spark):
    got = ef.compare_with_next(documents(spark)).collect()
    assert len(got) == len(rows())
    have = defaultdict(Counter)
    for r in got:
        have[r.doc_id][r.n_chars, r.fingerprint] += 1
    want = defaultdict(Counter)
    for d, t, *_ in rows():
        want[d][len(t or ""), ef._fingerprinted([t or ""])[2][0]] += 1
    assert have == want
    # Documents alone with their id, whose next one is alone too: one possible partner.
    by_id = defaultdict(list)
    for d, t, *_ in rows():
        by_id[d].append(t or "")
    ids = sorted((d for d in by_id if d is not None), reverse=True)
    checked = 0
    for d, after in zip(ids, ids[1:]):
        if len(by_id[d]) == len(by_id[after]) == 1:
            text, other = by_id[d][0], by_id[after][0]
            k = len(text) // 3
            edited = text[:len(text) - k] + other[:k]
            r = next(r for r in got if r.doc_id == d)
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.edited_fingerprint == ef._fingerprinted([edited])[2][0]
            assert r.near_edited == ef.likeness(r.fingerprint, r.edited_fingerprint)
            assert r.near_next == ef.likeness(r.fingerprint, ef._fingerprinted([other])[2][0])
            checked += 1
    assert checked > 20


def test_compare_with_next_wraps_around(spark):
    df = spark.createDataFrame([(1, "aaa bbb ccc"), (2, "ddd eee fff"), (3, "ggg hhh iii")], "doc_id long, text string")
    got = {r.doc_id: r for r in ef.compare_with_next(df).collect()}
    assert got[1].edited_sha256 == hashlib.sha256(b"aaa bbb ggg").hexdigest()  # after the smallest, the largest
    one = ef.compare_with_next(df.filter("doc_id = 2")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert ef.compare_with_next(empty(spark)).count() == 0


def test_near_groups_join_edits(spark):
    base = rows()[12][1]
    df = spark.createDataFrame([(1, base), (2, base + " more"), (3, base[:200] + "x" + base[200:]), (4, base),
                                (5, base[::-1]), (6, "")], "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in ef.near_groups(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6}


def test_near_groups_of_a_template_against_brute_force(spark):
    """Texts of one template share bands, and the least of them is often unlike the others."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    draw = lambda n: "".join(rng.choice(letters, n))
    template, table = draw(450), []
    for cluster in range(12):
        own = draw(900)
        for _ in range(4):
            at = sorted(rng.integers(0, 900, 3).tolist())
            text = own[:at[0]] + draw(40) + own[at[0] + 40:at[1]] + draw(40) + own[at[1] + 40:]
            table.append((len(table), template + text[:900]))
    fps = ef._fingerprinted([t for _, t in table])[2]
    label = list(range(len(table)))
    for i in range(len(table)):
        for j in range(i):
            if ef.likeness(fps[i], fps[j]) >= 0.5:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    assert len(set(label)) < len(table)
    got = {r.doc_id: r.group_id for r in ef.near_groups(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(label))
    assert all(len(set(ef.band_keys(f)) - set(ef.band_keys(f, ef.bands_for(0.5)))) == 0 for f in fps)
