"""A quality classifier: a generalised additive model with pairwise terms.

Numbers that describe a text are cut into bins.  Boosting goes round the
features in turn; each turn fits a tree of a few leaves to one feature alone
and adds a little of it to that feature's table (a number per bin).  The pairs
of features whose residuals leave most to gain then get tables over two
features in the same way.  A text's score is the sum of its bins' numbers.

The fit takes a bounded sample of labelled rows (``most_rows``, chosen by a
hash of doc_id) to the driver; features and scores of all texts are computed
by the executors.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import slices, text_bytes, texts_of

SLICE = 1 << 20
#: Rows of the fit at most; bins of a feature, alone and in a pair.
MOST_ROWS, BINS, PAIR_BINS = 20_000, 64, 12
ROUNDS, PAIR_ROUNDS, RATE, PAIRS = 150, 100, 0.1, 10
#: Prior weight of a leaf, in rows' second derivatives.
SMOOTHING = 2.0
THRESHOLD = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "stop": b".,;:?", "shout": b"!", "symbol": b"#$%&*+/<=>@[\\]^_`{|}~", "space": b" \t\r\v\f", "line": b"\n",
    "high": bytes(range(128, 256)),
}
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_members), _i] = 1.0

FEATURES = (*_CLASSES, "log_bytes", "log_words", "word_bytes", "longest_word", "distinct_words", "top_word",
            "distinct_pairs", "repeated_lines", "line_words", "entropy", "shouted_words", "odd_ends",
            "short_words", "top_pair")


def features(text: bytes) -> list[float]:
    """Numbers that describe a whole text; an empty text gives zeros."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    shares = (counts @ _CLASS_OF / n).tolist()
    p = counts[counts > 0] / n
    words = text.split()
    m = max(len(words), 1)
    known = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lengths = {w: len(w) for w in known}
    lines = [x for x in text.split(b"\n") if x]
    shouted = sum(k for w, k in known.items() if w.isupper() and lengths[w] > 1)
    odd = sum(k for w, k in known.items() if not (w[-1:].isalnum() or w[-1] > 127 or w[-1] in b".,;:?"))
    short = sum(k for w, k in known.items() if lengths[w] <= 3)
    return [*shares, np.log1p(n), np.log1p(len(words)), sum(lengths[w] * k for w, k in known.items()) / m,
            float(max(lengths.values(), default=0)), len(known) / m, max(known.values(), default=0) / m,
            len(pairs) / max(m - 1, 1), 1 - len(set(lines)) / max(len(lines), 1), m / max(len(lines), 1),
            float(-(p * np.log2(p)).sum()), shouted / m, odd / m, short / m,
            max(pairs.values(), default=0) / max(m - 1, 1)]


@dataclass
class Model:
    """Bin edges of each feature, a table per feature and one per chosen pair."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row: bins looked up and added."""
        total = np.full(len(x), self.base)
        for j, (edges, t) in enumerate(zip(self.edges, self.tables)):
            total += t[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), t in zip(self.pairs, self.pair_tables):
            total += t[np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                       np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SMOOTHING)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of consecutive bins (sums of first and
    second derivatives) into two leaves."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return float(gains[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """The value of each bin under a tree of ``leaves`` leaves, grown best first."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b]), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.empty(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + SMOOTHING)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree over a table that cuts the rows once and each side's columns once."""
    best, out = -1.0, np.zeros_like(g)
    total = _gain(g.sum(), h.sum())
    for at in range(1, len(g)):
        gain, halves = -total, []
        for side in (slice(0, at), slice(at, None)):
            gs, hs = g[side].sum(axis=0), h[side].sum(axis=0)
            more, cut = _best_cut(gs, hs)
            gain += _gain(gs.sum(), hs.sum()) + max(more, 0.0)
            halves.append((side, cut, gs, hs))
        if gain > best:
            best, out = gain, np.zeros_like(g)
            for side, cut, gs, hs in halves:
                for cols in (slice(0, cut), slice(cut, None)):
                    out[side, cols] = gs[cols].sum() / (hs[cols].sum() + SMOOTHING)
    return best, out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, rate: float = RATE,
        n_pairs: int = PAIRS) -> Model:
    """Boosted tables for labels 0/1; without both labels the score is constant."""
    rate_of_ones = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    if not 0 < y.sum() < len(y):
        empty = [np.zeros(0)] * x.shape[1]
        return Model(base, empty, [np.zeros(1)] * x.shape[1], empty, [], [])
    edges = [_edges(c, BINS) for c in x.T]
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), base)
    for _ in range(rounds):
        for b, t in zip(bins, tables):
            p = 1 / (1 + np.exp(-total))
            step = rate * _tree(np.bincount(b, y - p, len(t)), np.bincount(b, p * (1 - p), len(t)))
            t += step
            total += step[b]
    pair_edges = [_edges(c, PAIR_BINS) for c in x.T]
    cells = [np.searchsorted(e, c, side="right") for e, c in zip(pair_edges, x.T)]

    def sums(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        wide = len(pair_edges[b]) + 1
        shape = (len(pair_edges[a]) + 1, wide)
        at = cells[a] * wide + cells[b]
        return (np.bincount(at, y - p, shape[0] * wide).reshape(shape),
                np.bincount(at, p * (1 - p), shape[0] * wide).reshape(shape))

    ranked = sorted(((_pair_tree(*sums(a, b))[0], a, b) for a, b in itertools.combinations(range(x.shape[1]), 2)),
                    reverse=True)
    pairs = [(a, b) for gain, a, b in ranked[:n_pairs] if gain > 0]
    pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in pairs]
    for _ in range(pair_rounds):
        for (a, b), t in zip(pairs, pair_tables):
            step = rate * _pair_tree(*sums(a, b))[1]
            t += step
            total += step[cells[a], cells[b]]
    return Model(base, edges, tables, pair_edges, pairs, pair_tables)


def held_out(doc_id: Column) -> Column:
    """Rows that no fit sees: crc32 of doc_id as text, modulo 5, is 0 (null: seen by none, held out by none)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """Fit on at most ``most_rows`` labelled documents, those with the least hash
    of doc_id among the rows that are not held out."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    sample = (usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t) for t in text_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), pa.array(x, pa.list_(pa.float64()))],
                                             ["doc_id", "quality", "x"])

    # The sample is bounded, so it may be broadcast; a doc_id that many rows share is bounded again.
    rows = (texts_of(docs).join(F.broadcast(sample), "doc_id")
            .mapInArrow(run, "doc_id long, quality int, x array<double>")
            .orderBy("doc_id", "quality", "x").limit(most_rows).toPandas())
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["quality"].to_numpy(dtype=float))


def score_column(model: Model):
    """A function of the text column: probability of label 1 (null: as empty)."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        x = np.array([features((t or "").encode()) for t in text]).reshape(len(text), len(FEATURES))
        return pd.Series(model.score(x))

    return score


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from ``threshold``).

    A null text is scored as an empty one; repeated rows are scored each; an
    empty table gives none; columns other than doc_id and text are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text", SLICE):
                x = np.array([features(t) for t in text_bytes(part.column("text"))])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    scored = texts_of(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
