"""Quality classifier: a generalised additive model with pairwise interactions.

A document's features are cut into bins. Cyclic gradient boosting goes round
the features, each time fitting a shallow tree of at most four leaves to the
current residuals of one feature alone, and adds it to that feature's look-up
table; then the pairs of features that explain most of what is left get tables
in the same way, by trees with one cut on either axis. A score is the sum of
the look-ups, through the logistic function.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadlens.llm.common import held_out, id_and_text, slices, training_sample

FEATURES = ("log_words", "word_length", "upper", "digits", "symbols", "bars", "marks", "distinct", "adjacent", "trigrams", "same_lines", "ended_lines")
_ENDS = tuple(c.encode() for c in (".", "!", "?", ":", ";", '"', "”", "»", "…"))


def features(text: bytes) -> list[float]:
    """Of one whole text; all zero if it has no word."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper = int(of[65:91].sum())
    letters = upper + int(of[97:123].sum()) + int(of[192:].sum())  # a byte from 192 starts a character
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    return [
        float(np.log1p(n)),
        (len(text) - int(of[[9, 10, 11, 12, 13, 32]].sum())) / n,
        upper / max(1, letters),
        int(of[48:58].sum()) / n,
        int(of[list(b"#*$%&<>")].sum()) / n,
        int(of[124]) / n,
        int(of[list(b"!?")].sum()) / n,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:], strict=False))) / (n - 2) if n > 2 else 0.0,
        1 - len(set(lines)) / len(lines),
        sum(x.endswith(_ENDS) for x in lines) / len(lines),
    ]


def _leaf(g, h):
    return g / (h + 1.0)


def _gain(g, h):
    return g * g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best gain, and the bin that starts the right side (0: no cut)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return float(gains[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values by bin of a tree with two levels of cuts."""
    _, middle = _cut(g, h)
    sides = [(0, middle), (middle, len(g))] if middle else [(0, len(g))]
    out = np.zeros(len(g))
    for a, b in sides:
        gain, at = _cut(g[a:b], h[a:b])
        for c, d in [(a, a + at), (a + at, b)] if at and gain > 0 else [(a, b)]:
            out[c:d] = _leaf(g[c:d].sum(), h[c:d].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values by cell of the best tree with one cut on either axis."""
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def corners(c):
        a = c[:-1, :-1]
        return a, c[:-1, -1:] - a, c[-1:, :-1] - a, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + a

    gains = sum(_gain(x, y) for x, y in zip(corners(cg), corners(ch), strict=True)) - _gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    out = np.zeros(g.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = _leaf(g[rows, cols].sum(), h[rows, cols].sum())
    return float(gains[i, j]), out


@dataclass
class Gam:
    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)], axis=1)

    def logits(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for i, table in enumerate(self.tables):
            out += table[bins[:, i]]
        for i, j, table in self.pairs:
            out += table[bins[:, i], bins[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(self.bins(x)), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, most_bins: int = 32, rounds: int = 60, n_pairs: int = 6, pair_rounds: int = 20, rate: float = 0.3) -> Gam:
    """Boost a model on features x and labels y (0 or 1). Without rows, or with one class, the score is constant."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, most_bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    model = Gam(edges, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), [np.zeros(len(e) + 1) for e in edges], [])
    if len(np.unique(y)) < 2:
        return model
    bins = model.bins(x)
    logits = model.logits(bins)

    def residuals():
        p = 1 / (1 + np.exp(-logits))
        return y - p, p * (1 - p)

    def sums(cells, shape, g, h):
        size = int(np.prod(shape))
        return np.bincount(cells, g, size).reshape(shape), np.bincount(cells, h, size).reshape(shape)

    for _ in range(rounds):
        for i, table in enumerate(model.tables):
            step = rate * _tree(*sums(bins[:, i], table.shape, *residuals()))
            table += step
            logits += step[bins[:, i]]
    shapes = {(i, j): (len(model.tables[i]), len(model.tables[j])) for i, j in combinations(range(x.shape[1]), 2)}
    cell = {(i, j): bins[:, i] * s[1] + bins[:, j] for (i, j), s in shapes.items()}
    left = residuals()
    chosen = sorted(shapes, key=lambda p: -_quadrants(*sums(cell[p], shapes[p], *left))[0])[:n_pairs]
    model.pairs = [(i, j, np.zeros(shapes[i, j])) for i, j in chosen]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            step = rate * _quadrants(*sums(cell[i, j], table.shape, *residuals()))[1]
            table += step
            logits += step[bins[:, i], bins[:, j]]
    return model


def _of_batch(part: pa.RecordBatch) -> np.ndarray:
    return np.array([features(t or b"") for t in part.column("text").cast(pa.binary()).to_pylist()], np.float64).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0, rows: int = 20_000) -> Gam:
    """Fit on at most ``rows`` labelled documents outside the held-out fold; only their features come to the driver."""

    def run(batches):
        for whole in batches:
            for part in slices(whole, "text"):
                x = _of_batch(part)
                yield pa.RecordBatch.from_arrays([part.column("label"), *[pa.array(c) for c in x.T]], names=["label", *FEATURES])

    sample = training_sample(docs, labels, label, folds, fold, rows).select("label", "text")
    got = sample.mapInArrow(run, "label int, " + ", ".join(f"{f} double" for f in FEATURES)).toArrow().sort_by([(f, "ascending") for f in ("label", *FEATURES)])
    x = np.stack([np.asarray(got.column(f), np.float64) for f in FEATURES], axis=1).reshape(-1, len(FEATURES))
    return fit(x, np.asarray(got.column("label"), np.float64))


def classify(df: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0, threshold: float = 0.3, rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 from ``threshold`` on).

    A score depends on the text alone. A null text counts as empty; a text
    without words has all features zero and is scored as such. A null id is not
    held out and has no label. Repeated rows each give a row, an empty table
    none. Columns other than id and text aren't looked at; texts are read whole.
    """
    docs = id_and_text(df, id_col, text_col)
    model = train(docs, labels, label, folds, fold, rows)

    def run(batches):
        for whole in batches:
            for part in slices(whole, "text"):
                score = model.score(_of_batch(part))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def select_good(df: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0, threshold: float = 0.3, rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, all columns, that score ``threshold`` or more; cases as in classify()."""
    model = train(id_and_text(df, id_col, text_col), labels, label, folds, fold, rows)
    at = df.columns.index(text_col)

    def run(batches):
        for whole in batches:
            for part in slices(whole, whole.schema.names[at]):
                texts = part.column(at).cast(pa.binary()).to_pylist()
                x = np.array([features(t or b"") for t in texts], np.float64).reshape(-1, len(FEATURES))
                yield part.filter(pa.array(model.score(x) >= threshold))

    return df.mapInArrow(run, df.schema)
