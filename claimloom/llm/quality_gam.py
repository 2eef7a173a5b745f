"""Text quality by an additive model of binned features and pairs of features, boosted feature by feature."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.text import utf8

#: The model is fitted on at most so many labelled rows, the first by a hash of their id.
MAX_TRAINING_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 12, 10
CYCLES, PAIR_CYCLES, RATE, RIDGE = 150, 60, 0.1, 2.0
ACCEPT = 0.3

FEATURES = (
    "log_words", "word_length", "unique_words", "top_word", "repeat_pairs", "repeat_lines", "line_words", "upper", "symbols", "pipes",
    "exclaims", "digits", "marks", "non_ascii", "short_words", "long_words", "packed", "sentences", "caps_words", "marked_words",
)
_UPPER, _DIGITS, _SYMBOLS, _MARKS = bytes(range(65, 91)), b"0123456789", b"#*$%&<>@^~=+\\{}[]_", b".,;:?!"
_SPACES = b" \t\n\x0b\x0c\r"


def features(text: bytes | None) -> list[float]:
    """Numbers from the whole text, none of them from anything else."""
    text = text or b""
    words = text.split()
    n, size = len(words), max(1, len(text))
    count = lambda letters: (len(text) - len(text.translate(None, letters))) / size
    if not n:
        return [0.0] * len(FEATURES)
    lower = text.lower().split()
    seen = Counter(lower)
    pairs = list(zip(lower, lower[1:]))
    lines = [s for line in text.split(b"\n") if (s := line.strip(_SPACES))]
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        len(seen) / n,
        max(seen.values()) / n,
        1 - len(set(pairs)) / max(1, len(pairs)),
        1 - len(set(lines)) / max(1, len(lines)),
        min(n / len(lines), 1000.0),
        count(_UPPER),
        count(_SYMBOLS),
        count(b"|"),
        count(b"!"),
        count(_DIGITS),
        count(_MARKS),
        sum(1 for b in text if b > 127) / size if not text.isascii() else 0.0,
        sum(1 for w in words if len(w) <= 3) / n,
        sum(1 for w in words if len(w) > 12) / n,
        len(zlib.compress(text, 1)) / size,
        (text.count(b". ") + text.count(b".\n") + 1) / n,
        sum(1 for w in words if w.isupper() and len(w) > 1) / n,
        sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128 and w[-1] not in _MARKS) / n,
    ]


@dataclass
class Model:
    """Lookup tables: a score is the intercept and one number per feature and per pair of features."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.pair_edges)]
            for (a, b), table in zip(self.pairs, self.pair_tables):
                total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g**2 / (h + RIDGE)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best place to cut a row of bins in two: (gain, first bin of the right part; 0: none)."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return (float(gains[at]), at + 1) if gains[at] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of up to four leaves over one feature's bins, as a value per bin."""
    _, at = _cut(g, h)
    parts = [(0, at), (at, len(g))] if at else [(0, len(g))]
    cuts = []
    for a, b in parts:
        _, c = _cut(g[a:b], h[a:b])
        cuts += [(a, a + c), (a + c, b)] if c else [(a, b)]
    out = np.zeros(len(g))
    for a, b in cuts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree of depth two over a grid, one cut along each feature: (gain, values)."""
    best, out = 0.0, np.zeros_like(g)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        down_g, down_h = np.cumsum(gg, axis=0), np.cumsum(hh, axis=0)
        for i in range(len(gg) - 1):
            gain, values = 0.0, np.zeros_like(gg)
            for rows, pg, ph in ((slice(0, i + 1), down_g[i], down_h[i]), (slice(i + 1, None), down_g[-1] - down_g[i], down_h[-1] - down_h[i])):
                _, c = _cut(pg, ph)
                for cols in (slice(0, c), slice(c, None)) if c else (slice(None),):
                    sg, sh = pg[cols].sum(), ph[cols].sum()
                    gain += sg**2 / (sh + RIDGE)
                    values[rows, cols] = sg / (sh + RIDGE)
            if gain > best:
                best, out = gain, values.T.copy() if flip else values
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: in turn each feature's table takes a small step towards a shallow tree of the residuals.

    The main tables come first; then the pairs with the largest gain on what is left are boosted likewise.
    Without rows, or with one class only, every score is the smoothed share of that class.
    """
    base = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(base / (1 - base))), [], [], [], [], [])
    if len(y) == 0 or y.min() == y.max():
        return Model(model.intercept, [np.empty(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), [], [], [])
    k = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(k)]
    bins = [np.searchsorted(model.edges[j], x[:, j], side="right") for j in range(k)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)
    for _ in range(CYCLES):
        for j in range(k):
            p = 1 / (1 + np.exp(-total))
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(bins[j], y - p, size), np.bincount(bins[j], p * (1 - p), size))
            model.tables[j] += step
            total += step[bins[j]]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(k)]
    coarse = [np.searchsorted(model.pair_edges[j], x[:, j], side="right") for j in range(k)]

    def grids(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)
        p = 1 / (1 + np.exp(-total))
        cell = coarse[a] * shape[1] + coarse[b]
        both = (np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p)))
        return (cell, *both)

    ranked = sorted(((_pair_tree(*grids(a, b)[1:])[0], a, b) for a in range(k) for b in range(a)), reverse=True)
    model.pairs = [(a, b) for gain, a, b in ranked[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_CYCLES):
        for i, (a, b) in enumerate(model.pairs):
            cell, g, h = grids(a, b)
            step = RATE * _pair_tree(g, h)[1]
            model.pair_tables[i] += step
            total += step.ravel()[cell]
    return model


def id_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(label, text) of at most ``max_rows`` labelled documents, the first by a hash of the id.

    The chosen ids have a known bound (9 bytes each), so they are broadcast and texts do not move.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    chosen = chosen.select("doc_id", F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """The model for ``labels`` (doc_id, quality). Features are computed in tasks; at most ``max_rows`` of them reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([features(t) for t in utf8(batch.column(1))], pa.list_(pa.float64()))], names=["label", "x"]
            )

    rows = training_rows(docs, labels, "quality", max_rows).mapInArrow(run, "label int, x array<double>").toArrow()
    y = rows.column("label").to_numpy().astype(np.float64)
    x = np.array(rows.column("x").to_pylist(), dtype=np.float64).reshape(len(y), len(FEATURES))
    order = np.lexsort((*x.T, y))  # sums do not depend on the order in which tasks end
    return fit(x[order], y[order])


def quality_score(model: Model, text: Column) -> Column:
    """Score from 0 to 1 of a text column; null and empty texts have the features of no words."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([features(t.encode() if t else None) for t in batch], dtype=np.float64).reshape(len(batch), len(FEATURES))
            yield pd.Series(model.score(x))

    return score(text.cast("string"))


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """doc_id, score (higher: better), predicted (score >= 0.3) of every row of ``docs``.

    ``held_out`` is a condition on ``labels``: rows for which it holds teach
    nothing. Null labels and labels without a document teach nothing either; a
    document labelled twice counts twice. Rows are scored one by one, so repeats
    and other columns do not matter; an empty table gives no rows.
    """
    teach = labels if held_out is None else labels.where(~held_out)
    model = fit_quality(docs, teach, max_rows)
    scored = docs.select("doc_id", quality_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
