"""Fill-in-middle: texts cut at two code points and put together in another order.

Code points are counted and found eight bytes at a time.  The UTF-8 of many
texts, end to end, is viewed as 64-bit words; a byte ends a code point unless
the byte after it goes one on, which shifts and masks tell for all eight bytes
of a word at once.  ``bitwise_count`` gives the ends of each word, their running
sum is searched for the word that holds the wanted end, and a multiplication
finds its byte in that word.  No text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import slices, text_bytes, texts_of

#: What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK_PATTERN = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
#: Of 100 texts so many are cut at most; of 100 that are cut so many have the suffix first.
CUT_SHARE, SUFFIX_FIRST_SHARE = 90, 20
#: UTF-8 that one step works on, about.
STEP_BYTES = 1 << 22

_LOW = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_ONE = np.uint64(1)


def _bits(n: int) -> np.uint64:
    return np.uint64(n)


class UnitEnds:
    """The bytes of some valid UTF-8 that end a code point, by 64-bit words."""

    def __init__(self, data: bytes | np.ndarray):
        raw = np.frombuffer(data, dtype=np.uint8)
        words = np.zeros(len(raw) // 8 + 2, dtype="<u8")  # zeros follow the last byte
        words.view(np.uint8)[:len(raw)] = raw
        goes_on = (words >> _bits(7)) & ~(words >> _bits(6)) & _LOW  # bytes 10xxxxxx
        next_goes_on = goes_on >> _bits(8)
        next_goes_on[:-1] |= goes_on[1:] << _bits(56)
        self.ends = ~next_goes_on & _LOW
        self.before = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.ends), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many ends lie before each byte."""
        word = at >> 3
        below = (_ONE << (8 * (at & 7)).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.ends[word] & below)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """The byte after the ``nth`` end (the first is 1; 0: byte 0)."""
        wanted = np.maximum(nth, 1)
        word = np.searchsorted(self.before, wanted) - 1
        left = (wanted - self.before[word]).astype(np.uint64)
        upto = self.ends[word] * _LOW  # in each byte of a word: the ends up to it, 8 at most
        reached = ((upto | _HIGH) - left * _LOW) & _HIGH  # bytes with `left` ends or more
        return np.where(nth > 0, 8 * word + 9 - np.bitwise_count(reached), 0)


def _hashes(seed: int) -> list[Column]:
    """h1 to h4: four numbers of 32 bits from the sha256 of ``seed:doc_id`` (no doc_id: ``null``)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    digest = F.sha2(name, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _cut(batch: pa.RecordBatch, cut_share: int, suffix_first: int) -> pa.RecordBatch:
    texts = text_bytes(batch.column("text"))
    h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy() for i in range(1, 5))
    edge = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=edge[1:])
    units = UnitEnds(b"".join(texts))
    rank = units.rank(edge)
    n = np.diff(rank)
    one, two = h1 % (n + 1), h2 % (n + 1)
    first, second = np.minimum(one, two), np.maximum(one, two)
    a = units.select(rank[:-1] + first) - edge[:-1]
    b = units.select(rank[:-1] + second) - edge[:-1]
    marked = pc.match_substring_regex(batch.column("text"), MARK_PATTERN).to_numpy(zero_copy_only=False)
    plain = (n == 0) | marked.astype(bool) | (h3 % 100 >= cut_share)
    form = np.where(plain, "plain", np.where(h4 % 100 < suffix_first, "spm", "psm"))
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    out = []
    for text, kind, i, j in zip(texts, form.tolist(), a.tolist(), b.tolist()):
        if kind == "plain":
            out.append(text)
        elif kind == "psm":
            out.append(b"".join((p, text[:i], s, text[j:], m, text[i:j])))
        else:
            out.append(b"".join((s, text[j:], p, text[:i], m, text[i:j])))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()),
         pa.array(first, pa.int64(), mask=plain), pa.array(second - first, pa.int64(), mask=plain),
         pa.array(out, pa.binary()).cast(pa.string())],
        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, seed: int, cut_share: int = CUT_SHARE,
                   suffix_first: int = SUFFIX_FIRST_SHARE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    ``n``: code points of the text; ``prefix_chars`` and ``middle_chars``: those of
    the first two parts, null where the text is left whole.  ``form``: ``plain``
    (the text itself), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix,
    middle).  Cuts and form follow from ``seed`` and doc_id alone, so repeated
    rows come out alike; a null doc_id counts as the word ``null``.  A null text
    is empty; empty texts and texts that hold a mark stay plain.  Long texts are
    worked on whole, by themselves; other columns go; an empty table gives none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", STEP_BYTES):
                yield _cut(part, cut_share, suffix_first)

    rows = texts_of(docs, *_hashes(seed))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                                "output string")


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`fill_in_middle` cut, from its output and form.

    No part of a cut text holds a mark, and none arises where a part meets a
    mark (marks begin with their only ``<`` and end with their only ``>``), so the
    three marks found are those that were put in.
    """
    parts = F.split(output, MARK_PATTERN, -1)
    first, second, middle = (F.get(parts, i) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, middle, second))
             .when(form == "spm", F.concat(second, middle, first))
             .otherwise(output))
