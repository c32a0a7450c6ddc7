"""SentencePiece encoding by an agenda: against the library."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from rillet.llm import pieces
from tests.llm.fixtures import documents, empty, rows

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
CHARS = st.one_of(st.characters(exclude_categories=["Cs"]), st.characters(max_codepoint=0x24F),
                  st.sampled_from(" ▁\n\tetaoin.,1234<0x>é漢😀\x00"))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=CHARS, max_size=80))
def test_ids_equal_library(text):
    encoder = pieces.piece_encoder(PATH)
    ids = LIBRARY.encode(text)
    assert [x.tolist() for x in encoder.encode([text, text])] == [ids, ids]
    assert np.frombuffer(encoder._encoded(encoder.normal(text)), pieces.ID).tolist() == ids  # and without words
    assert encoder.decode([ids]) == [LIBRARY.decode(ids)] == [text.replace(pieces.SPACE, " ")]
    assert [x.tolist() for x in encoder.checked([text, "", text + " x"])[0]] == [ids, [], LIBRARY.encode(text + " x")]


def test_agenda_takes_the_best_then_the_leftmost():
    score = {"ab": -2.0, "bc": -1.0, "abc": -3.0, "aa": -1.0, "aaa": -1.0}
    agenda = pieces.Agenda(score)

    def cut(text, symbols):
        ends = [0]
        for symbol in symbols:
            ends.append(ends[-1] + agenda.length[symbol])
        return [text[a:b] for a, b in zip(ends, ends[1:])]

    wanted = {"abc": ["abc"],  # bc first, then a + bc
              "abab": ["ab", "ab"], "aaaa": ["aaa", "a"],  # equal scores: the leftmost first
              "axbcx": ["a", "x", "bc", "x"], "x": ["x"], "\U0010ffff": ["\U0010ffff"], "bcab": ["bc", "ab"]}
    for text, symbols in wanted.items():
        assert cut(text, agenda.merged(text)) == symbols
    all_, n = agenda.merged_all(list(wanted))
    ends = np.cumsum(n)
    assert [cut(t, all_[b - k:b]) for t, b, k in zip(wanted, ends, n)] == list(wanted.values())
    assert agenda.merged("") == []


def test_long_texts_and_forgetting(monkeypatch):
    monkeypatch.setattr(pieces, "PIECE", 300)
    monkeypatch.setattr(pieces, "GENERATION", 60)
    monkeypatch.setattr(pieces, "STEP", 7)
    small = pieces.PieceEncoder(PATH)
    for _ in range(2):
        for _, text, *_ in rows():
            text = (text or "")[:30_000]
            assert small.encode([text])[0].tolist() == LIBRARY.encode(text)
    assert small.old and len(small.known) < 2000
    assert max(map(len, small.known)) <= pieces.REMEMBERED


def test_one_long_word():
    text = "".join(chr(0x61 + (i * i) % 26) for i in range(100_000))
    assert pieces.piece_encoder(PATH).encode([text])[0].tolist() == LIBRARY.encode(text)


def test_a_difference_fails(monkeypatch):
    encoder = pieces.PieceEncoder(PATH)
    encoder.checked(["the text"])
    encoder.known["▁text"] = encoder.known["▁the"]  # a wrong word, remembered
    with pytest.raises(ValueError, match="differ"):
        encoder.checked(["the text"])
    monkeypatch.setattr(encoder.agenda, "_places", encoder.agenda._places * 0 + encoder.agenda.none)
    with pytest.raises(ValueError, match="word"):  # a wrong merge
        encoder.checked(["another"])
    whole = pieces.PieceEncoder(PATH)
    whole.by_word = False  # as for a model whose pieces cross words
    assert whole.checked(["the text, as it is"])[0][0].tolist() == LIBRARY.encode("the text, as it is")
    monkeypatch.setattr(whole.agenda, "place", {})
    with pytest.raises(ValueError, match="differ"):
        whole.checked(["the text"])


def test_documents(spark):
    got = [(r.doc_id, tuple(r.ids), r.decoded) for r in pieces.encode_documents(documents(spark), PATH).collect()]
    wanted = []
    for d, text, *_ in rows():
        ids = LIBRARY.encode(text or "")
        wanted.append((d, tuple(ids), LIBRARY.decode(ids)))
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert all(t == (text or "") for (_, _, t), (_, text, *_) in zip(wanted, rows()))
    made = pieces.encode_documents(empty(spark), PATH)
    assert made.collect() == [] and made.columns == ["doc_id", "ids", "decoded"]
    assert [len(x) for x in pieces.piece_encoder(PATH).encode(["", "a", ""])] == [0, 1, 0]
