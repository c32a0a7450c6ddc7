"""Document fingerprints by randomised edit embedding.

All texts share one random walk rule: at step j of the walk, character c is
read again or left behind by a random bit that depends on (j, c) alone.  The
sequence of characters read at steps 0, 1, 2, ... is the embedding; after an
edit two walks soon read the same characters at the same steps again, so texts
at a small edit distance have embeddings at a small Hamming distance.

A fingerprint holds a random hex digit of the character read at sampled steps.
The steps are drawn octave by octave, each octave half as densely as the one
above it within a text's length, and the draws nest: texts of unlike length
share sample steps.  Texts that agree in a band of sampled digits are
candidates; the share of equal digits verifies them.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import slices, texts_of, written
from rillet.llm.components import components
from rillet.llm.words import mix

#: Classes of characters and period of the walk's random bits.
CLASSES, PERIOD_BITS = 256, 12
#: Samples in a text's highest octave.
SAMPLES = 128
#: Bands, and sampled digits of a band.
BANDS, BAND_DIGITS = 24, 6
SEED = 20240229
SLICE = 1 << 22
#: Walks with fewer texts side by side go text by text.
FEW = 24
PAD = ord("-")
_DIGITS = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


@functools.cache
def _dwell() -> np.ndarray:
    """[class, step]: steps until the walk leaves a character of the class."""
    period = 1 << PERIOD_BITS
    leaves = np.random.default_rng(SEED).random((CLASSES, period)) < 0.5
    leaves[:, -1] = True
    out = np.empty((CLASSES, period), dtype=np.uint8)
    wait = np.zeros(CLASSES, dtype=np.int64)
    for j in range(period - 1, -1, -1):
        wait = np.where(leaves[:, j], 1, np.minimum(wait + 1, 255))
        out[:, j] = wait
    return out


def _class_of(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint32(2654435761) >> np.uint32(24)).astype(np.uint8)


def walk(classes: np.ndarray, offsets: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For every character the step at which the walk has left it.

    Texts lie end to end (``offsets``); ``start`` is each text's first step.
    Texts are walked side by side, the longest last on their own.
    """
    flat, low = _dwell().ravel(), (1 << PERIOD_BITS) - 1
    out = np.empty(len(classes), dtype=np.int64)
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    at, steps, lengths = offsets[:-1][order], start[order].astype(np.int64), lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = len(lengths) - np.cumsum(np.bincount(lengths, minlength=longest + 1))
    i = 0
    for n in active[:longest].tolist():
        if n < FEW:
            break
        here, now = at[:n] + i, steps[:n]
        now += flat[(classes[here].astype(np.int64) << PERIOD_BITS) | (now & low)]
        out[here] = now
        i += 1
    rows = [r.tobytes() for r in _dwell()]
    for k in range(int(np.searchsorted(-lengths, -i))):
        begin, end, j = int(at[k]) + i, int(at[k] + lengths[k]), int(steps[k])
        left = []
        for c in classes[begin:end].tobytes():
            j += rows[c][j & low]
            left.append(j)
        out[begin:end] = left
    return out


@functools.cache
def _draw(octave: int) -> np.ndarray:
    """Sample steps of an octave, of which shorter lists are prefixes."""
    rng = np.random.default_rng([SEED, octave])
    if octave <= 12:
        return (1 << octave) + rng.permutation(1 << octave)[:SAMPLES]
    return (1 << octave) + rng.integers(0, 1 << octave, SAMPLES)


def _drawn(octave: int, top: int) -> int:
    return min(SAMPLES >> (top - octave), 1 << octave) if octave <= top else 0


@functools.cache
def sample_steps(top: int) -> np.ndarray:
    """Sample steps of texts whose walk ends in octave ``top``."""
    return np.concatenate([[0], *(_draw(o)[:_drawn(o, top)] for o in range(top + 1))]).astype(np.int64)


@functools.cache
def _nested(short: int, top: int) -> np.ndarray:
    """Where the samples of octave ``top`` are among those of ``short`` (-1: beyond its end)."""
    places, begin = [0], 1
    for o in range(top + 1):
        n, own = _drawn(o, top), _drawn(o, short)
        places += [begin + i if i < own else -1 for i in range(n)]
        begin += own
    return np.array(places)


def digits_of(codes: np.ndarray, left: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The fingerprints of texts from their code points and walks: two hex digits
    of the top octave, then a digit per sample (``-`` beyond the end)."""
    n = len(offsets) - 1
    ends = np.where(np.diff(offsets) > 0, left[np.maximum(offsets[1:] - 1, 0)], 0) if len(left) else np.zeros(n, int)
    tops = [max(0, int(e).bit_length() - 1) for e in ends]
    steps = [sample_steps(t) for t in tops]
    sizes = np.array([len(s) for s in steps])
    step, row = np.concatenate(steps), np.repeat(np.arange(n), sizes)
    out = np.full(len(step), PAD, dtype=np.uint8)
    inside = step < ends[row]
    if inside.any():
        text = np.repeat(np.arange(n), np.diff(offsets))
        at = np.searchsorted((text << 41) + left, (row[inside] << 41) + step[inside], side="right")
        h = mix(codes[at].astype(np.uint64) << np.uint64(42) ^ step[inside].astype(np.uint64))
        out[inside] = _DIGITS[(h & np.uint64(15)).astype(np.int64)]
    raw, cut = out.tobytes().decode("ascii"), np.cumsum(sizes).tolist()
    return [f"{t:02x}{raw[a:b]}" for t, a, b in zip(tops, [0, *cut], cut)]


def _common(a: str, b: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Both fingerprints' digits at the sample steps of the longer text."""
    tops = int(a[:2], 16), int(b[:2], 16)
    top, both = max(tops), []
    for fp, own in zip((a, b), tops):
        digits = np.frombuffer(fp[2:].encode("ascii"), dtype=np.uint8)
        if own < top:
            places = _nested(own, top)
            digits = np.where(places < 0, PAD, digits[np.maximum(places, 0)])
        both.append(digits)
    return top, both[0], both[1]


def likeness(a: str, b: str) -> float:
    """Share of equal digits where at least one text goes on, less what chance
    gives (1 in 16): 1 for equal fingerprints, about 0 for unlike texts."""
    _, x, y = _common(a, b)
    there = (x != PAD) | (y != PAD)
    n = int(there.sum())
    equal = int(((x == y) & there).sum()) / n if n else 1.0
    return max(0.0, (equal - 1 / 16) / (15 / 16))


@functools.cache
def _bands(top: int, bands: int = BANDS) -> np.ndarray:
    """Samples of each band, from the octaves that a text of octave ``top`` fills."""
    rng = np.random.default_rng([SEED, 7, top])
    return rng.integers(0, len(sample_steps(top)) - _drawn(top, top), (bands, BAND_DIGITS))


def bands_for(least: float) -> int:
    """Bands at which texts of likeness ``least`` whose differences are spread evenly
    fail to meet once in a thousand; ``BANDS`` at least, of which more are a continuation."""
    if least < 0.25:
        raise ValueError("texts of a likeness below 0.25 would need more than 10,000 bands")
    met = (1 / 16 + min(least, 1.0) * 15 / 16) ** BAND_DIGITS
    return BANDS if met >= 1 else max(BANDS, math.ceil(math.log(0.001) / math.log1p(-met)))


def band_keys(fp: str, bands: int = BANDS) -> list[str]:
    """Keys at which near texts meet: sampled digits at the text's own octave and,
    for a partner just over an octave's end, at the next."""
    top = int(fp[:2], 16)
    digits = np.frombuffer(fp[2:].encode("ascii"), dtype=np.uint8)
    places = _nested(top, top + 1)
    higher = np.where(places < 0, PAD, digits[np.maximum(places, 0)])
    out = []
    for t, d in ((top, digits), (top + 1, higher)):
        out += [f"{t:02x}{k:02x}{band.tobytes().decode('ascii')}" for k, band in enumerate(d[_bands(t, bands)])
                if (band != PAD).all()]
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def _fingerprinted(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], list[str]]:
    codes = [_codes(t) for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(c) for c in codes]))).astype(np.int64)
    flat = np.concatenate(codes) if codes else np.zeros(0, "<u4")
    left = walk(_class_of(flat), offsets, np.zeros(len(codes), np.int64))
    return codes, np.split(left, offsets[1:-1]), digits_of(flat, left, offsets)


_FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
           "bands_edited"]
_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, bands_edited int")


def _compared(ids: list, texts: list[str]) -> list[tuple]:
    """A row for each text but the last, which is only the next one's partner."""
    codes, left, fps = _fingerprinted(texts)
    keep = [len(c) - len(c) // 3 for c in codes[:-1]]
    tails = [codes[i + 1][:len(codes[i]) // 3] for i in range(len(keep))]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in tails]))).astype(np.int64)
    begin = np.array([left[i][k - 1] if k else 0 for i, k in enumerate(keep)], dtype=np.int64)
    # The edited text's walk goes on from where its kept part ends.
    flat = np.concatenate(tails) if tails else np.zeros(0, "<u4")
    more = np.split(walk(_class_of(flat), offsets, begin), offsets[1:-1])
    e_codes = [np.concatenate((codes[i][:k], tails[i])) for i, k in enumerate(keep)]
    e_left = [np.concatenate((left[i][:k], more[i])) for i, k in enumerate(keep)]
    offsets = np.concatenate(([0], np.cumsum([len(c) for c in e_codes]))).astype(np.int64)
    edited = digits_of(np.concatenate(e_codes), np.concatenate(e_left), offsets) if keep else []
    rows = []
    for i, e in enumerate(edited):
        sha = hashlib.sha256(e_codes[i].tobytes().decode("utf-32-le").encode()).hexdigest()
        met = len(set(band_keys(fps[i])) & set(band_keys(e)))
        rows.append((ids[i], len(codes[i]), sha, fps[i], e, likeness(fps[i], e), likeness(fps[i], fps[i + 1]), met))
    return rows


def compare_with_next(docs: DataFrame) -> DataFrame:
    """One row per document, compared with an edited text and the next document.

    The next document is that of the next smaller doc_id (after the smallest:
    the largest; rows without doc_id come last; rows that share one are ordered
    by a hash of their text).  The edited text has the last third of a text's
    code points replaced by as many (or all) first ones of the next document.
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (likeness of the fingerprint to the edited text's
    and the next document's), bands_edited (bands shared with the edited text).
    A null text is empty; an empty text is like empty texts only; a single row
    is its own next; an empty table gives none; other columns are not looked at.

    Texts are range-sorted once; a task reads its range in order.  The last row
    of a range and the first of the following one, a pair per task, are matched
    afterwards.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ordered = texts_of(docs).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for b in batches:
            for piece in slices(b, "text", SLICE):
                ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
                if held is None:
                    yield _batch([(None,) * 8], "head", part, ids[0], texts[0])
                else:
                    ids, texts = [held[0], *ids], [held[1], *texts]
                yield _batch(_compared(ids, texts), "row", part)
                held = ids[-1], texts[-1]
        if held is not None:
            yield _batch([(None,) * 8], "tail", part, *held)

    done = written(ordered.mapInArrow(run, f"kind string, part long, {_SCHEMA}, edge_id long, edge_text string"),
                   "edit-fingerprints")
    heads = done.filter("kind = 'head'").select("part", "edge_id", "edge_text")
    # One row per task.
    following = heads.select("part", F.coalesce(
        F.lead("part").over(Window.orderBy("part")),
        F.min("part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))).alias("next"))
    ends = (done.filter("kind = 'tail'").select("part", "edge_id", "edge_text").join(following, "part")
            .join(heads.select(F.col("part").alias("next"), F.col("edge_text").alias("next_text")), "next")
            .select("edge_id", "edge_text", "next_text"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, text, after in zip(*(c.to_pylist() for c in b.columns)):
                yield _rows(_compared([doc_id, None], [text, after]))

    return done.filter("kind = 'row'").select(*_FIELDS).unionByName(ends.mapInArrow(finish, _SCHEMA))


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32()]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _FIELDS)


def _batch(rows: list[tuple], kind: str, part: int, edge_id: int | None = None,
           edge_text: str | None = None) -> pa.RecordBatch:
    b, n = _rows(rows), len(rows)
    arrays = [pa.array([kind] * n, pa.string()), pa.array([part] * n, pa.int64()), *b.columns,
              pa.array([edge_id] * n, pa.int64()), pa.array([edge_text] * n, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "part", *_FIELDS, "edge_id", "edge_text"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every document; a null text is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for piece in slices(b, "text", SLICE):
                fps = _fingerprinted(piece.column("text").to_pylist())[2]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(fps, pa.string())],
                                                 ["doc_id", "fingerprint"])

    return texts_of(docs).mapInArrow(run, "doc_id long, fingerprint string")


def near_groups(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc_id, fingerprint, group_id): documents joined over verified band matches.

    Distinct fingerprints that agree in a band are linked by a likeness of
    ``least``.  Each is compared with the band's least fingerprint first; then
    those of a band that are not joined yet are compared with one another, so
    two near texts that share a band are always in one group (the work grows
    with the square of the unlike texts of a band).  There are as many bands as
    ``least`` needs (:func:`bands_for`): a pair at that likeness, its
    differences spread evenly, shares none once in a thousand; pairs whose
    differences are not, or whose walks end two octaves apart, may be missed.
    group_id is the smallest doc_id of the linked documents.
    """
    bands = bands_for(least)
    fps = written(fingerprints(docs), "fingerprints")
    classes = fps.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).withColumn(
        "node", F.xxhash64("fingerprint"))

    @F.udf("array<string>", useArrow=True)
    def keys(fp):
        return band_keys(fp, bands)

    @F.udf("double", useArrow=True)
    def like(a, b):
        return likeness(a, b)

    banded = written(classes.select("fingerprint", F.explode(keys("fingerprint")).alias("key")), "bands")
    leaders = banded.groupBy("key").agg(F.min("fingerprint").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    def near(pairs: DataFrame) -> DataFrame:
        return (pairs.distinct().filter(like("a", "b") >= least)
                .select(F.xxhash64("a").alias("u"), F.xxhash64("b").alias("v")))

    pairs = banded.join(leaders, "key").filter("fingerprint <> leader")
    links = written(near(pairs.select(F.col("fingerprint").alias("a"), F.col("leader").alias("b"))), "leader-links")
    joined = (banded.join(leaders.select("key"), "key").withColumn("node", F.xxhash64("fingerprint"))
              .join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node")))
    joined = written(joined.select("key", "fingerprint", "label"), "joined")
    other = joined.select("key", F.col("fingerprint").alias("b"), F.col("label").alias("other"))
    rest = joined.withColumnRenamed("fingerprint", "a").join(other, "key").filter("a < b and label <> other")
    links = links.unionByName(near(rest.select("a", "b")))
    labelled = classes.join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = labelled.groupBy("label").agg(F.min("least").alias("group_id"))
    return fps.join(labelled.join(groups, "label").select("fingerprint", "group_id"), "fingerprint").select(
        "doc_id", "fingerprint", "group_id")
