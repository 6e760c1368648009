"""Quality scores by a generalised additive model with pairwise interactions.

Features of a text (``FEATURES``) are cut into bins at quantiles of the
training texts.  Shallow trees are boosted in turn, one feature after the
other with a small step, and add up to one lookup table per feature; then the
pairs with the largest gain get a table of their own the same way.  A score is
the logistic of the sum of the looked-up values: one addition per table, for
whole batches.

The model is fitted on at most ``SAMPLE`` labelled texts, taken by the order of
a hash of their ids.  Null and empty texts have all features zero and are
scored like others.  Labels of one kind only, or none, give every text their
rate (one half for none).  Repeated documents and labels count as often as
they occur; rows of null label are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import column, gathered, keep_where, quoted
from footfall.llm.tokens import bytes_of
from footfall.llm.words import U, Words, mixed

SAMPLE = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS, PAIR_ROUNDS = 150, 60
PAIRS = 8
RATE = 0.1
TEXT_BYTES = 8 << 20
THRESHOLD = 0.3

FEATURES = [
    "log_words", "word_length", "upper", "digit", "symbol", "bang", "bar", "stop", "comma", "high", "lines",
    "distinct", "top", "repeat", "distinct_3", "mixed_words",
]


def _byte_classes() -> np.ndarray:
    """Class of each byte: upper, lower, digit, symbol, bang, bar, stop, comma, high, line, space, other."""
    out = np.full(256, 11, np.uint8)
    out[65:91], out[97:123], out[48:58], out[128:] = 0, 1, 2, 8
    for i, chars in ((3, b"#$%&*<>{}[]\\^~@=+_"), (4, b"!?"), (5, b"|"), (6, b".:;"), (7, b","), (9, b"\n"), (10, b" \t\r")):
        out[list(chars)] = i
    return out


CLASS = _byte_classes()


def features(texts: pa.Array) -> np.ndarray:
    """(texts, FEATURES)."""
    n = len(texts)
    texts = texts.fill_null("").cast(pa.large_string())
    raw, at = bytes_of(texts)
    size = np.diff(at)
    some = np.flatnonzero(size)
    counts = np.zeros((n, 12))
    if len(some):
        kind = CLASS[raw]
        for c in range(12):
            counts[some, c] = np.add.reduceat(kind == c, at[:-1][some], dtype=np.int64)
    words = Words(texts)
    code, at = words.code, words.at
    many = np.diff(at)
    row = np.repeat(np.arange(n), many)
    distinct, top, repeat, three = np.zeros(n), np.zeros(n), np.zeros(n), np.ones(n)
    if len(code):
        vocabulary = int(code.max()) + 1
        key, times = np.unique(row * vocabulary + code, return_counts=True)
        owner = key // vocabulary
        distinct = np.bincount(owner, minlength=n).astype(float)
        np.maximum.at(top, owner, times.astype(float))
        again = (code[1:] == code[:-1]) & (row[1:] == row[:-1])
        repeat = np.bincount(row[1:][again], minlength=n).astype(float)
        inside = row[2:] == row[:-2]
        if inside.any():
            wide = code.astype(np.uint64)
            triple = mixed(mixed(mixed(wide[:-2] + U(1)) + wide[1:-1]) + wide[2:])[inside]
            owner = row[2:][inside]
            order = np.lexsort((triple, owner))
            triple, owner = triple[order], owner[order]
            new = np.concatenate([[True], (triple[1:] != triple[:-1]) | (owner[1:] != owner[:-1])])
            three = np.bincount(owner[new], minlength=n) / np.maximum(np.bincount(owner, minlength=n), 1)
            three[many < 3] = 1.0
    w = np.maximum(many, 1)
    letters = np.maximum(counts[:, 0] + counts[:, 1] + counts[:, 8], 1)
    chars = np.maximum(size, 1)
    out = np.stack(
        [
            np.log1p(many), (chars - counts[:, 9] - counts[:, 10]) / w, counts[:, 0] / letters, counts[:, 2] / chars,
            counts[:, 3] / w, counts[:, 4] / w, counts[:, 5] / w, counts[:, 6] / w, counts[:, 7] / w,
            counts[:, 8] / letters, counts[:, 9] / w, distinct / w, top / w, repeat / w, three, counts[:, 11] / w,
        ],
        axis=1,
    )
    out[size == 0] = 0.0
    return out


@dataclass
class Model:
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        for (f, g), table in zip(self.pairs, self.pair_tables):
            a = np.searchsorted(self.pair_edges[f], x[:, f], "right")
            out += table[a, np.searchsorted(self.pair_edges[g], x[:, g], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _stump(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Best cut of a row of bins and its gain; the cut stands before the returned bin."""
    if len(g) < 2:
        return 0, 0.0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    best = int(gain.argmax())
    return best + 1, float(gain[best])


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of two levels over the bins of one feature, as a value per bin."""
    out = np.zeros(len(g))
    cut, _ = _stump(g, h)
    for a, b in ((0, cut), (cut, len(g))):
        if b <= a:
            continue
        inner, _ = _stump(g[a:b], h[a:b])
        for c, d in ((a, a + inner), (a + inner, b)):
            if d > c:
                out[c:d] = _leaf(g[c:d].sum(), h[c:d].sum())
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """One cut per feature, four leaves, and what it gains."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def corners(c):
        total, rows, cols = c[-1, -1], c[:-1, -1:], c[-1:, :-1]
        a = c[:-1, :-1]
        return a, cols - a, rows - a, total - rows - cols + a

    gs, hs = corners(cg), corners(ch)
    if not gs[0].size:
        return np.zeros_like(g), 0.0
    gain = sum(_gain(x, y) for x, y in zip(gs, hs)) - _gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[i + 1 :, : j + 1] = _leaf(gs[0][i, j], hs[0][i, j]), _leaf(gs[1][i, j], hs[1][i, j])
    out[: i + 1, j + 1 :], out[i + 1 :, j + 1 :] = _leaf(gs[2][i, j], hs[2][i, j]), _leaf(gs[3][i, j], hs[3][i, j])
    return out, float(gain.max())


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on the logistic loss."""
    m = Model()
    rate = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
    if not len(y) or y.min() == y.max():
        rate = min(max(y.mean() if len(y) else 0.5, 1e-6), 1 - 1e-6)
        m.base = float(np.log(rate / (1 - rate)))
        return m
    m.base = float(np.log(rate / (1 - rate)))
    m.edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(m.edges)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    margin = np.full(len(y), m.base)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, len(m.tables[f])), np.bincount(b, h, len(m.tables[f])))
            m.tables[f] += step
            margin += step[b]
    m.pair_edges = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(m.pair_edges)]
    shape = [len(e) + 1 for e in m.pair_edges]

    def grid(f, g, v):
        return np.bincount(coarse[f] * shape[g] + coarse[g], v, shape[f] * shape[g]).reshape(shape[f], shape[g])

    g0, h0 = slopes()
    gains = {
        (f, g): _pair_tree(grid(f, g, g0), grid(f, g, h0))[1] for f in range(x.shape[1]) for g in range(f + 1, x.shape[1])
    }
    m.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    m.pair_tables = [np.zeros((shape[f], shape[g])) for f, g in m.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (f, g) in enumerate(m.pairs):
            s, h = slopes()
            step = RATE * _pair_tree(grid(f, g, s), grid(f, g, h))[0]
            m.pair_tables[k] += step
            margin += step[coarse[f], coarse[g]]
    return m


def train(
    docs: DataFrame, labels: DataFrame, use: Column, sample: int = SAMPLE, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "quality",
) -> Model:
    """Fit on at most ``sample`` rows of ``labels`` for which ``use`` holds (a column of the label table)."""
    known = labels.filter(use).select(quoted(id_col).alias("i"), quoted(label_col).cast("int").alias("y")).dropna()
    n = known.count()
    share = 1 << 30 if n <= sample else int((1 << 30) * sample / n)
    # hashed, so the same rows at every run; the limit makes the bound strict
    known = known.filter(F.pmod(F.xxhash64("i"), F.lit(1 << 30)) < share).limit(sample)
    texts = docs.select(quoted(id_col).alias("doc"), quoted(text_col).alias("text"))
    names = [f"f{i}" for i in range(len(FEATURES))]

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in gathered(batches, TEXT_BYTES):
            x = features(column(t, "text"))
            yield pa.RecordBatch.from_arrays([*x.T, column(t, "y")], [*names, "y"])

    rows = texts.join(F.broadcast(known), F.col("doc") == F.col("i")).select("text", "y")
    measured = rows.mapInArrow(measure, ", ".join(f"{c} double" for c in names) + ", y int").limit(sample).toPandas()
    order = np.lexsort(measured.to_numpy().T) if len(measured) else []
    data = measured.to_numpy(dtype=float)[order]
    return fit(data[:, :-1], data[:, -1])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in gathered(batches, TEXT_BYTES):
            s = model.score(features(column(t, "text")))
            yield pa.RecordBatch.from_arrays([column(t, "doc_id"), pa.array(s)], ["doc_id", "score"])

    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows that score ``threshold`` or more, with the columns of ``docs``."""
    return keep_where(docs, text_col, TEXT_BYTES, lambda texts: model.score(features(texts)) >= threshold)
