"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text is lower-cased and its white space made single spaces. Its n-grams of 3
to 5 characters are hashed to ``BUCKETS``; a feature is that an n-gram occurs at
least once, twice or three times. Over the training documents, a feature's ratio
is r = log(share among label 1 / share among label 0), smoothed by one. The
features that tell the labels apart best are kept, and a logistic regression
is fitted to the presences times r.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import checkpointed, held_out, id_and_text, slices, training_sample

BUCKETS = 1 << 20
SIZES = (3, 4, 5)
#: A feature is an n-gram that occurs at least so often; feature id: level index * BUCKETS + bucket.
LEVELS = (1, 2, 3)
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def grams(text: str) -> np.ndarray:
    """Bucket of each n-gram of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    chars = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, h = [], chars
    for n in range(2, max(SIZES) + 1):
        if len(chars) < n:
            break
        h = (h[:-1] * _STEP) + chars[n - 1 :]
        if n in SIZES:
            mixed = (h ^ (h >> np.uint64(31))) * _MIX + np.uint64(n)
            out.append((mixed * _MIX >> np.uint64(44)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def features(text: str) -> np.ndarray:
    """Ids of the features that a text has."""
    buckets, counts = np.unique(grams(text), return_counts=True)
    return np.concatenate([k * BUCKETS + buckets[counts >= least] for k, least in enumerate(LEVELS)])


@dataclass
class Linear:
    ids: np.ndarray
    weights: np.ndarray
    base: float

    def scorer(self):
        buckets, of = np.unique(self.ids % BUCKETS, return_inverse=True)
        least = np.array(LEVELS)[self.ids // BUCKETS]
        slot = np.full(BUCKETS, -1, np.int16)
        slot[buckets] = np.arange(len(buckets))

        def score(text: str) -> float:
            found = slot[grams(text)]
            counts = np.bincount(found[found >= 0], minlength=len(buckets))
            z = self.base + float(self.weights[counts[of] >= least].sum())
            return 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))

        return score


def logistic(cells: np.ndarray, starts: np.ndarray, y: np.ndarray, r: np.ndarray, penalty: float = 1e-3, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights of features r times presence, and the base, by Adam on all rows. cells: the features of row after row."""
    n, m = len(y), len(r)
    row = np.repeat(np.arange(n), np.diff(np.append(starts, len(cells))))
    w, b = np.zeros(m), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    mean, square = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(row, (w * r)[cells], n)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.append(np.bincount(cells, error[row], m) * r / n + penalty * w, error.mean())
        mean += 0.1 * (grad - mean)
        square += 0.01 * (grad * grad - square)
        step = 0.05 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        w -= step[:-1]
        b -= step[-1]
    return w * r, b


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, fold: int = 2, rows: int = 8_000, keep: int = 4_096) -> Linear:
    """Fit on at most ``rows`` labelled documents outside the held-out fold and the ``keep`` best features."""
    sample = checkpointed(training_sample(docs, labels, label, folds, fold, rows).select("doc_id", "label", "text").repartition(4, "doc_id"))
    totals = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    base = float(np.log((pos + 0.5) / (neg + 0.5)))
    if not pos or not neg:
        return Linear(np.zeros(0, np.int64), np.zeros(0), base)

    def count(batches):
        n = np.zeros((2, len(LEVELS) * BUCKETS), np.int32)
        for whole in batches:
            for part in slices(whole, "text"):
                for y, text in zip(part.column("label").to_pylist(), part.column("text").to_pylist(), strict=True):
                    n[y, features(text or "")] += 1
        some = np.flatnonzero(n.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[1, some].astype(np.int64)), pa.array(n[0, some].astype(np.int64))], names=["id", "pos", "neg"])

    share = pos / (pos + neg)
    counts = sample.select("label", "text").mapInArrow(count, "id long, pos long, neg long").groupBy("id").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    telling = F.pow(F.col("pos") - (F.col("pos") + F.col("neg")) * share, 2) / (F.col("pos") + F.col("neg"))
    best = counts.where("pos + neg >= 2").orderBy(telling.desc(), "id").limit(keep).collect()
    ids = np.array([r.id for r in best], np.int64)
    r = np.log((np.array([x.pos for x in best]) + 1.0) / (pos + 2)) - np.log((np.array([x.neg for x in best]) + 1.0) / (neg + 2))

    def present(batches):
        slot = np.full(len(LEVELS) * BUCKETS, -1, np.int16)
        slot[ids] = np.arange(len(ids))
        for whole in batches:
            for part in slices(whole, "text"):
                found = [slot[features(t or "")] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array([np.sort(f[f >= 0]).tobytes() for f in found], pa.binary())], names=["doc_id", "label", "cells"])

    got = sample.mapInArrow(present, "doc_id long, label int, cells binary").toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    cells = [np.frombuffer(c, np.int16) for c in got.column("cells").to_pylist()]
    starts = np.cumsum([0, *map(len, cells)])[:-1]
    weights, base = logistic(np.concatenate(cells).astype(np.int64), starts, np.asarray(got.column("label"), np.float64), r)
    return Linear(ids, weights, base)


def classify(df: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, fold: int = 2, threshold: float = 0.3, rows: int = 8_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 from ``threshold`` on).

    A score depends on the text alone. A null text counts as empty; a text
    without words has no feature and gets the base score, and so does every
    text if the training rows hold one label only. A null id is not held out and has no
    label. Repeated rows each give a row, an empty table none. Columns other
    than id and text aren't looked at; texts are read whole.
    """
    docs = id_and_text(df, id_col, text_col)
    model = train(docs, labels, label, folds, fold, rows)

    def run(batches):
        score_of = model.scorer()
        for whole in batches:
            for part in slices(whole, "text"):
                score = np.array([score_of(t or "") for t in part.column("text").to_pylist()], np.float64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
