"""Vectorised word hashes of a batch of texts (NumPy, no loop over words)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Odd multipliers of the polynomial hashes, arithmetic modulo 2**64.
IN_WORD = np.uint64(0x9E3779B97F4A7C15)
OF_WORDS = np.uint64(0xD6E8FEB86659FD93)
_SPACE = 32
_powers = np.ones(1, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _in_word_powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        table = np.full(max(n, 256), IN_WORD, dtype=np.uint64)
        table[0] = 1
        _powers = np.multiply.accumulate(table)
    return _powers


@dataclass
class Words:
    """The words of some texts, laid end to end, each followed by one space."""

    data: bytes
    begin: np.ndarray   # byte at which word k begins; its end is begin[k + 1] - 1
    first: np.ndarray   # index of each text's first word, and the number of all words
    hashes: np.ndarray  # 64-bit hash of each word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def joined(self, k: int, n: int) -> bytes:
        """Words k .. k+n-1, joined by one space."""
        return self.data[self.begin[k]:self.begin[k + n] - 1]


def words_of(texts: list[bytes]) -> Words:
    split = [t.split() for t in texts]
    first = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(w) for w in split], out=first[1:])
    data = b"".join(b" ".join(w) + b" " for w in split if w)
    raw = np.frombuffer(data, dtype=np.uint8)
    begin = np.zeros(int(first[-1]) + 1, dtype=np.int64)
    begin[1:] = np.flatnonzero(raw == _SPACE) + 1
    if not len(raw):
        return Words(data, begin, first, np.zeros(0, dtype=np.uint64))
    lengths = np.diff(begin)
    small = np.int32 if len(raw) < 1 << 31 else np.int64
    place = np.arange(len(raw), dtype=small)
    place -= np.repeat(begin[:-1].astype(small), lengths)
    terms = _in_word_powers(int(lengths.max()))[place]
    terms *= raw  # the closing space takes part, and so does the length
    return Words(data, begin, first, mix(np.add.reduceat(terms, begin[:-1])))


def _power_of_words(n: int) -> np.uint64:
    return np.uint64(pow(int(OF_WORDS), n, 1 << 64))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive values, by doubling."""
    total = len(hashes) - width + 1
    if total <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, done = np.zeros(total, dtype=np.uint64), 0
    part, size = hashes, 1  # part: hashes of `size` values
    while size <= width:
        if width & size:
            out += part[done:done + total] * _power_of_words(done)
            done += size
        if size * 2 <= width:
            part = part[:-size] + part[size:] * _power_of_words(size)
        size *= 2
    return out


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values
