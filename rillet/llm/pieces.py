"""SentencePiece encoding of merge-type vocabularies by an agenda of symbol pairs.

A text's symbols, at first its characters, stand in a linked row.  Every two
neighbours whose union is a piece wait in an agenda, the best score first and
the leftmost among equals; the first is taken and joined, and the pairs that the
new symbol makes with its neighbours join the agenda, until none is left.

No piece goes on from another character to a space mark, so a text falls into
words (space marks and what follows them) that no merge crosses, and the ids of
a word met before are remembered.  All is checked against the sentencepiece library,
batch by batch: the ids of every word that was not remembered, and, as words
are only put together, that each text's ids decode to the text.  Texts of models
whose pieces do cross words are compared whole.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rillet.llm.common import slices, texts_of

#: The character that stands for a space in pieces (fixed value).
SPACE = "▁"
#: A word: space marks, then other characters.
WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Where a word begins after another.
NEXT_WORD = re.compile(f"(?<=[^{SPACE}]){SPACE}")
#: Longest word that is remembered, and merged beside others; words of one generation; characters
#: cut into words at a time, and words encoded at a time.
REMEMBERED, GENERATION, PIECE, GROUP = 20, 400_000, 1 << 18, 1 << 15
#: An id in memory.
ID = np.dtype("<i4")
#: New words that are merged together.
STEP = 4096
#: UTF-8 of the texts of one step, about.
STEP_BYTES = 1 << 21
#: Model type and piece types of the model file's format (fixed values).
MERGE_MODEL, NORMAL, UNKNOWN, CONTROL, BYTE = 2, 1, 2, 3, 6


class Agenda:
    """The pieces of a vocabulary as numbered symbols, and the pairs that make one.

    ``score`` gives the pieces in the order of their ids.  Characters that occur
    in pieces only have numbers behind those, and all others share the last.
    """

    def __init__(self, score: dict[str, float]):
        number = {p: i for i, p in enumerate(score)}
        for c in set().union(*score):
            number.setdefault(c, len(number))
        self.other = len(number)
        self.width = len(number) + 2  # one more stands behind the end of a word
        self.number = {c: i for c, i in number.items() if len(c) == 1}
        self.length = [len(p) for p in number] + [1]
        places = {s: i for i, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.none = len(places)  # behind all scores
        #: by pair: the place of its union's score among all, and the union's number
        self.place, self.union = {}, {}
        for p, s in score.items():
            for i in range(1, len(p)):
                if p[:i] in number and p[i:] in number:
                    pair = number[p[:i]] * self.width + number[p[i:]]
                    self.place[pair], self.union[pair] = places[s], number[p]
        # the same for many pairs at once
        self._pairs = np.array(sorted(self.place), dtype=np.int64)
        self._places = np.array([*map(self.place.get, self._pairs.tolist()), self.none], dtype=np.int32)
        self._unions = np.array([*map(self.union.get, self._pairs.tolist()), 0], dtype=np.int64)
        self._by_char = np.full(0x110000, self.other, dtype=np.int64)
        self._by_char[[ord(c) for c in self.number]] = list(self.number.values())

    def merged(self, text: str) -> list[int]:
        """The symbols that are left when no two neighbours make a piece.

        The agenda is a heap of (place of a pair's score, its first symbol), as one
        number; an entry one of whose symbols has been joined since is passed over.
        """
        symbols: list = [self.number.get(c, self.other) for c in text]
        place, union, width, n = self.place.get, self.union, self.width, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[int] = []

        def wait(i: int, j: int) -> None:
            found = place(symbols[i] * width + symbols[j])
            if found is not None:
                heapq.heappush(agenda, found << 32 | i)

        for i in range(n - 1):
            wait(i, i + 1)
        while agenda:
            entry = heapq.heappop(agenda)
            i = entry & 0xFFFFFFFF
            j = after[i]
            pair = symbols[i] * width + symbols[j] if symbols[i] is not None and j < n else None
            if pair is None or place(pair) != entry >> 32:
                continue
            symbols[i], symbols[j] = union[pair], None
            right = after[i] = after[j]
            if right < n:
                before[right] = i
                wait(i, right)
            if before[i] >= 0:
                wait(before[i], i)
        return [s for s in symbols if s is not None]

    def _look_up(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and union of many pairs."""
        pair = first * self.width + second
        at = np.searchsorted(self._pairs, pair)
        at[(at == len(self._pairs)) | (self._pairs[np.minimum(at, len(self._pairs) - 1)] != pair)] = -1
        return self._places[at], self._unions[at]

    def merged_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`merged` of many short words, one after the other, and how many symbols each has.

        The agenda of a word is the row of its pairs' places, of which the first least
        is taken; all words take a step together.
        """
        n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        cols = np.arange(int(n.max()) + 1)
        inside = cols < n[:, None]
        symbols = np.full(inside.shape, self.width - 1, dtype=np.int64)
        symbols[inside] = self._by_char[np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")]
        place, union = self._look_up(symbols[:, :-1], symbols[:, 1:])
        n, open_ = n.copy(), np.arange(len(words))
        while True:
            i = place[open_].argmin(axis=1)
            more = place[open_, i] < self.none
            open_, i = open_[more], i[more]
            if not len(open_):
                return symbols[cols < n[:, None]], n
            symbols[open_, i] = union[open_, i]
            n[open_] -= 1
            # what stands behind the pair moves one place to the left
            move = np.minimum(cols + (cols > i[:, None]), cols[-1])
            symbols[open_] = np.take_along_axis(symbols[open_], move, 1)
            symbols[open_, -1] = self.width - 1
            for x in (place, union):
                x[open_] = np.take_along_axis(x[open_], np.minimum(move[:, :-1], cols[-2]), 1)
            place[open_, -1] = self.none
            for at, rows in ((i, open_), (i[i > 0] - 1, open_[i > 0])):
                place[rows, at], union[rows, at] = self._look_up(symbols[rows, at], symbols[rows, at + 1])


class PieceEncoder:
    """``encode(texts)`` and ``decode(ids)`` for one model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_format

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = model_format.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != MERGE_MODEL or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only merge-type vocabularies of plain, byte and control pieces are encoded")
        score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.ids = np.array([i for i, p in enumerate(model.pieces) if p.type == NORMAL], dtype=np.int64)
        self.agenda = Agenda(score)
        by_byte = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.bytes = [by_byte[b] for b in range(256)] if len(by_byte) == 256 else None
        self.unknown = self.library.unk_id()
        spec = model.normalizer_spec
        self.as_it_is = (not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
                         and spec.escape_whitespaces and spec.add_dummy_prefix
                         and not model.trainer_spec.treat_whitespace_as_suffix)
        self.by_word = (self.as_it_is and self.bytes is not None and SPACE in score
                        and not any(NEXT_WORD.search(p) for p in score))
        # ids by word, as 32-bit integers end to end: when the young generation is full it
        # becomes the old one, from which what is met again moves over
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def normal(self, text: str) -> str:
        """The text as pieces spell it: spaces are marks, one more in front."""
        if self.as_it_is:
            return SPACE + text.replace(" ", SPACE) if text else ""
        return self.library.normalize(text)

    def _encoded(self, text: str) -> bytes:
        return self._ids_of(text, self.agenda.merged(text))

    def _ids_of(self, text: str, symbols: list[int]) -> bytes:
        """The ids of merged symbols, those of characters that are no pieces too."""
        out: list[int] = []
        at, unknown_before = 0, False
        for symbol in symbols:
            known = symbol < len(self.ids)
            if known:
                out.append(int(self.ids[symbol]))
            elif self.bytes is not None:  # a character that is no piece
                out.extend([self.bytes[b] for b in text[at].encode()])
            elif not unknown_before:
                out.append(self.unknown)  # one for a run of unknown symbols
            unknown_before = not known
            at += self.agenda.length[symbol]
        return np.array(out, dtype=ID).tobytes()

    def _learn(self, words: set[str]) -> None:
        """Find the ids of the words that are not known."""
        if len(self.known) > GENERATION:
            self.old, self.known = self.known, {}
        new = words.difference(self.known)
        again = [w for w in new if w in self.old]
        self.known.update((w, self.old[w]) for w in again)
        fresh = sorted(new.difference(again), key=len)
        short = [w for w in fresh if len(w) <= REMEMBERED]
        for i in range(0, len(short), STEP):
            part = short[i:i + STEP]
            symbols, n = self.agenda.merged_all(part)
            plain = symbols < len(self.ids)
            ids = self.ids[np.where(plain, symbols, 0)].astype(ID).tobytes()
            ends = np.cumsum(n)
            odd = np.add.reduceat(~plain, ends - n) > 0
            size = ID.itemsize
            self.known.update((word, ids[a:b]) for word, a, b in zip(
                part, (size * (ends - n)).tolist(), (size * ends).tolist()))
            for i in np.flatnonzero(odd).tolist():
                a, b = ends[i] - n[i], ends[i]
                self.known[part[i]] = self._ids_of(part[i], symbols[a:b].tolist())
        self.known.update((w, self._encoded(w)) for w in fresh[len(short):])
        self._compare(fresh)

    def _compare(self, words: list[str]) -> None:
        """Compare the ids of some words with the library's, which puts the first mark itself."""
        words = [w for w in words if w != SPACE]  # a mark alone is a piece, and no text by itself
        for word, ids in zip(words, self.library.encode([w[1:].replace(SPACE, " ") for w in words], num_threads=1)):
            if self.known[word] != np.array(ids, dtype=ID).tobytes():
                raise ValueError(f"ids differ from the library's for the word {word[:80]!r}")

    def _words(self, text: str) -> Iterator[list[str]]:
        """The words of a text, many at a time."""
        begin = 0
        while len(text) - begin > PIECE:
            cut = NEXT_WORD.search(text, begin + PIECE)
            if not cut:
                break
            yield WORD.findall(text, begin, cut.start())
            begin = cut.start()
        yield WORD.findall(text, begin)

    def _fill(self, out: list[list[bytes]], group: list[tuple[int, list[str]]]) -> None:
        words = set().union(*(w for _, w in group))
        self._learn(words)
        ids = self.known.__getitem__
        for k, w in group:
            out[k].append(b"".join(map(ids, w)))
        for w in words:
            if len(w) > REMEMBERED:
                del self.known[w]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as 32-bit integers; none for an empty text."""
        out: list[list[bytes]] = [[] for _ in texts]
        group, size = [], 0
        for k, text in enumerate(texts):
            spelled = self.normal(text)
            if not self.by_word:
                out[k].append(self._encoded(spelled))
                continue
            for words in self._words(spelled):
                group.append((k, words))
                size += len(words)
                if size > GROUP:
                    self._fill(out, group)
                    group, size = [], 0
        self._fill(out, group)
        return [np.frombuffer(b"".join(parts), dtype=ID) for parts in out]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids)

    def checked(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """The ids of some texts and what the library decodes them to, checked (see the module)."""
        ids = self.encode(texts)
        lists = [x.tolist() for x in ids]
        decoded = self.decode(lists)
        if self.by_word:
            right = [text.replace(SPACE, " ") == back for text, back in zip(texts, decoded)]
        else:
            right = [a == b for a, b in zip(lists, self.library.encode(texts, num_threads=1))]
        for text, same in zip(texts, right):
            if not same:
                raise ValueError(f"ids differ from the library's for a text that begins {text[:80]!r}")
        return ids, decoded


@functools.lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker."""
    return PieceEncoder(path)


def default_pieces() -> str:
    """Path of the model file that the registered query uses."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(ids) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in ids], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``docs``: the ids of its whole text by the
    model file ``path``, without begin and end ids, and the text that they decode to.

    The ids are the sentencepiece library's; every batch is checked against it, and
    a difference fails the job.  A null text is empty and has no ids.  Repeated
    rows and rows without doc_id stay rows of their own; a long text is cut at
    words for memory's sake, which changes no id; other columns go; an empty table
    gives none.  Decoding loses nothing but what the model's normaliser changes
    (a space mark in a text comes back as a space).
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in batches:
            for part in slices(batch, "text", STEP_BYTES):
                ids, decoded = encoder.checked(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _id_lists(ids), pa.array(decoded, pa.string())],
                                                 ["doc_id", "ids", "decoded"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")
