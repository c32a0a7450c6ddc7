"""Fill-in-middle: code points found by words, cuts, forms and the way back."""

from __future__ import annotations

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillet.llm import fim
from tests.llm.fixtures import documents, empty, rows

CHARS = st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aé漢😀\x00\x7f\u0080߿ࠀ￿\U0010ffff"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=CHARS, max_size=40), max_size=6))
def test_ends_of_code_points(texts):
    raw = [t.encode() for t in texts]
    units = fim.UnitEnds(b"".join(raw))
    edge = np.cumsum([0, *map(len, raw)])
    rank = units.rank(edge)
    assert rank.tolist() == np.cumsum([0, *map(len, texts)]).tolist()
    for i, t in enumerate(texts):
        wanted = [edge[i] + len(t[:k].encode()) for k in range(len(t) + 1)]
        assert units.select(rank[i] + np.arange(len(t) + 1)).tolist() == wanted


def cut(doc_id, text: str | None, seed: int, cut_share: int, suffix_first: int):
    """The definition, character by character."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= cut_share:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


MORE = [(200, "with a <P> mark", None, None, None), (201, "ends in <S", None, None, None), (202, "<", None, None, None),
        (203, "S>M>P>" * 9 + "<", None, None, None), (204, "é<M>", None, None, None), (205, "\u0000\u0000", None, None, None)]


def test_definition(spark):
    docs = documents(spark)
    docs = docs.unionByName(spark.createDataFrame(MORE, "doc_id long, text string, lang string, source string, n_chars long"),
                            allowMissingColumns=True)
    for seed, share, first in ((1, 90, 20), (2, 100, 50), (3, 0, 0)):
        made = fim.fill_in_middle(docs, seed, share, first)
        got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
        wanted = [(d, *cut(d, t, seed, share, first), t or "") for d, t, *_ in rows() + MORE]
        assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, wanted))
        forms = {r.form for r in got}
        assert forms == ({"plain"} if share == 0 else {"plain", "psm", "spm"})


def test_steps_do_not_show(spark, monkeypatch):
    docs = documents(spark)
    whole = sorted(map(repr, fim.fill_in_middle(docs, 1).collect()))
    monkeypatch.setattr(fim, "STEP_BYTES", 50)
    assert sorted(map(repr, fim.fill_in_middle(docs, 1).collect())) == whole


def test_empty_table(spark):
    made = fim.fill_in_middle(empty(spark), 1)
    assert made.collect() == [] and made.columns[0] == "doc_id"
