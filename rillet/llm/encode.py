"""Token ids by the ``tokenizers`` library, remembered for each pre-token.

A byte-level BPE cuts a text into pre-tokens by a fixed pattern and encodes
each on its own.  The library encodes every distinct pre-token once; texts are
then put together from the remembered ids.  Texts, or whole tokenizers, for
which this does not hold go to the library as they are.
"""

from __future__ import annotations

import codecs
import functools
import json
import re
import unicodedata

import numpy as np
from tokenizers import Tokenizer, models, pre_tokenizers

#: Code points whose class is settled in every library: Latin, Greek and
#: Cyrillic, general punctuation and currency signs.
SETTLED = [*range(0x1C), *range(0x20, 0x530), *range(0x2000, 0x2070), *range(0x20A0, 0x20C0)]
PIECE = 1 << 19
#: Characters of the pre-tokens of one generation, about.
REMEMBERED = 1 << 24


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in SETTLED if unicodedata.category(chr(c))[0] == kind)


def _pre_token_pattern() -> str:
    """The pre-token pattern of byte-level BPE (fixed value), its two Unicode
    classes spelled out over the settled code points.  Words are tried first:
    no other alternative begins as they do."""
    pattern = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    letters, numbers = _class("L"), _class("N")
    return (pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{letters}{numbers}]")
            .replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]"))


#: ASCII controls that only some libraries count as white space.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
UNSETTLED = re.compile("[^\x00-\x1b\x20-\u052f\u2000-\u206f\u20a0-\u20bf]")
#: A space that follows a non-space and precedes a letter begins a pre-token.
CUT = re.compile(rf"(?<=\S) (?=[{_class('L')}])")


def _byte_letters() -> list[str]:
    """The letter by which byte-level BPE writes each byte (fixed value): printable
    bytes stand for themselves, the others take the letters from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(0x100 + others.index(b)) for b in range(256)]


class _Known(dict):
    """Pre-tokens numbered as they are met; ``ids`` of number i are
    ``flat[start[i]:start[i] + length[i]]``."""

    def __init__(self, dtype: np.dtype):
        super().__init__()
        self.new: list[str] = []
        # A generation's ids are far fewer than 2**31.
        self.flat, self.start, self.length = np.zeros(1 << 16, dtype), np.zeros(1 << 16, np.int32), np.zeros(
            1 << 16, np.int32)
        self.used, self.chars = 0, 0

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        self.chars += len(word)
        return number

    def store(self, numbers: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Ids of numbered pre-tokens, laid end to end."""
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while len(self.start) < len(self):
            self.start, self.length = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.length))
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[numbers] = self.used + np.cumsum(lengths) - lengths
        self.length[numbers] = lengths
        self.used += len(ids)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many numbers, end to end, and how many each has."""
        lengths = self.length[numbers]
        ends = np.cumsum(lengths, dtype=np.int32)
        place = np.repeat(self.start[numbers] - ends + lengths, lengths)
        place += np.arange(len(place), dtype=np.int32)
        return self.flat[place], lengths


class Encoder:
    """``encode(texts)`` gives the ids of each text as a little-endian array."""

    def __init__(self, path: str, generation: int = 400_000):
        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        pre = config.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in config.get("added_tokens") or ()]
        self.find = re.compile(_pre_token_pattern()).findall
        # Two generations: when the young one is full, by number or by characters,
        # it becomes the old one, from which what is met again moves over; the rest
        # is forgotten.
        self.generation, self.known, self.old = generation, _Known(self.dtype), None
        model = config["model"]
        letters = _byte_letters()
        self.letters, self.line = "".join(letters), letters[ord("\n")]
        self.line_id = self.library.token_to_id(self.line)
        self.by_pre_token = (
            model["type"] == "BPE" and config.get("normalizer") is None and self.line_id is not None
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                               "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and pre.get("type") == "ByteLevel" and pre.get("use_regex")
            and not pre.get("add_prefix_space"))
        if self.by_pre_token:
            # The same model, without the library's own memory, over pre-tokens
            # that are cut already and written in the letters of bytes, a line
            # feed's letter between them.
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            self.words = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0))
            self.words.pre_tokenizer = pre_tokenizers.Split(self.line, "isolated")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        done: dict[str, np.ndarray | None] = dict.fromkeys(texts)  # equal texts are encoded once
        group: list[str] = []
        size = 0
        for text in done:
            if not self._sure(text):
                done[text] = self._direct([text])[0]
            elif len(text) > PIECE:
                done[text] = np.concatenate([self._remembered([p])[0] for p in _pieces(text)])
            else:
                group.append(text)
                size += len(text)
                if size > PIECE:
                    self._fill(done, group)
                    group, size = [], 0
        self._fill(done, group)
        return [done[t] for t in texts]

    def _sure(self, text: str) -> bool:
        if not self.by_pre_token or any(a in text for a in self.added):
            return False
        if text.isascii():
            return not any(c in text for c in SEPARATORS)
        return not UNSETTLED.search(text)

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype)
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _fill(self, done: dict, group: list[str]) -> None:
        if group:
            done.update(zip(group, self._remembered(group)))

    def _remembered(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > self.generation or self.known.chars > REMEMBERED:
            self.old, self.known = self.known, _Known(self.dtype)
        number = self.known.__getitem__
        split = [self.find(t) for t in texts]
        numbers = np.concatenate([np.fromiter(map(number, w), dtype=np.int32, count=len(w)) for w in split])
        if self.known.new:
            self._learn()
        ids, lengths = self.known.ids(numbers)
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum([len(w) for w in split])]
        return np.split(ids, ends[:-1])

    def _learn(self) -> None:
        """Store the ids of the pre-tokens that were new: from the old generation, or
        from the library, many in one call, cut again at the line feeds between."""
        known, new = self.known, self.known.new
        first = len(known) - len(new)
        known.new = []
        again, fresh = [], range(len(new))
        if self.old:
            before = list(map(self.old.get, new))
            again = [i for i, n in enumerate(before) if n is not None]
            fresh = [i for i, n in enumerate(before) if n is None]
            if again:
                known.store(first + np.array(again), *self.old.ids(np.array([before[i] for i in again])))
        blank = [i for i in fresh if new[i].isspace()]
        plain = [i for i in fresh if not new[i].isspace()] if blank else fresh
        for i in blank:
            ids = self._direct([new[i]])[0]
            known.store(np.array([first + i]), ids, np.array([len(ids)]))
        if not len(plain):
            return
        raw = "\n".join([new[i] for i in plain]).encode()
        written = codecs.charmap_decode(raw, "strict", self.letters)[0]
        ids = np.array(self.words.encode_batch_fast([written], add_special_tokens=False)[0].ids, dtype=self.dtype)
        cuts = np.flatnonzero(ids == self.line_id)
        lengths = np.diff(np.concatenate(([-1], cuts, [len(ids)]))) - 1
        if len(lengths) != len(plain):
            raise ValueError("pre-tokens cannot be told apart")
        known.store(first + np.array(plain), np.delete(ids, cuts), lengths)


def _pieces(text: str):
    begin = 0
    while len(text) - begin > PIECE:
        cut = CUT.search(text, begin + PIECE)
        if not cut:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)


def default_tokenizer() -> str:
    """Path of the tokenizer file that the registered queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
