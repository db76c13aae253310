"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

X are the vectors as rows, centred. From a random unit vector v, the process

    alpha u  = X v - beta u(before),    beta v(next) = X' u - alpha v

gives orthonormal u and v with X V = U B, B upper bidiagonal. Every new u and v
is orthogonalised against all before it, twice. The SVD of the small B gives
the singular values of X and, multiplied by V, its right singular vectors:
the components. Run for as many steps as there are dimensions it is exact;
where it breaks down early (rank, repeated singular values) it goes on with a
random vector orthogonal to all before.

Only X is distributed. A u has a row's length for each vector, but lies in
the columns of X: it is kept as the w with u = X w. A step is one pass over
X that computes, in every task, its rows' part of X w and of X' (X w), whose sums
over all tasks also hold the products with all earlier u, U' u = W' X' X w. The
driver has d numbers a step, and d vectors of d numbers in all.

Vectors lie in blocks in the checkpoint folder, whose rows hold up to 4 MB each;
every pass reads them from there, so that a lost executor costs one pass of its tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import checkpointed

BLOCK_BYTES = 4 << 20
#: Scaled components from here on aren't whole numbers that sums can hold exactly.
LARGEST = float(2**40)
#: Singular values below this share of the largest are none.
RANK = 1e-9


def integer_blocks(df: DataFrame, scale: float, shift: int, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """Blocks (ids, x) of the vectors that take part, x = floor(scale * c) + shift row by row as 8-byte integers, and their dimension."""
    values = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), values.alias("v"))
    # a null entry, NaN and infinity all fail the comparison
    rows = rows.where(F.coalesce(F.size("v") > 0, F.lit(False)) & F.forall("v", lambda c: F.coalesce(F.abs(c * scale) < LARGEST, F.lit(False))))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    step = max(1, BLOCK_BYTES // (8 * max(d, 1)))

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(scale * batch.column("v").flatten().to_numpy(zero_copy_only=False)).astype("<i8") + shift
            for at in range(0, batch.num_rows, step):
                ids = batch.column("id").slice(at, step)
                offsets = pa.array([0, len(ids)], pa.int32())
                yield pa.record_batch([pa.ListArray.from_arrays(offsets, ids), pa.array([x[at * d : (at + step) * d].tobytes()], pa.binary())], names=["ids", "x"])

    return checkpointed(rows.where(F.size("v") == d).mapInArrow(block, "ids array<long>, x binary")), d


@dataclass
class Centre:
    """Sums of n vectors by dimension; a block's rows less their mean."""

    n: int
    sums: list[int]

    def times_n(self, x: bytes) -> np.ndarray:
        """n * x - sums, exact: 8-byte integers, or Python's where these could overflow."""
        rows = np.frombuffer(x, "<i8").reshape(-1, len(self.sums))
        bound = self.n * int(np.abs(rows).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if bound < 2**62 else object
        return rows.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def __call__(self, x: bytes) -> np.ndarray:
        return (self.times_n(x) / self.n).astype(float)


def _summed(blocks: DataFrame, of: Callable[[bytes], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of the array of doubles that ``of`` gives for one; added up in each task, then by cell."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column("x").to_pylist():
                total = of(x) if total is None else total + of(x)
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["j", "s"])

    rows = blocks.mapInArrow(part, "j int, s double").groupBy("j").agg(F.sum("s").alias("s")).collect()
    return np.array([r.s for r in sorted(rows, key=lambda r: r.j)])


def _totals(blocks: DataFrame, d: int) -> Centre:
    """The number of vectors and their sums, exact at every size."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("x").to_pylist():
                rows = np.frombuffer(x, "<i8").reshape(-1, d)
                yield pa.record_batch([pa.array(np.arange(-1, d, dtype=np.int32)), pa.array([len(rows), *rows.sum(0).tolist()], pa.int64())], names=["j", "s"])

    rows = blocks.mapInArrow(part, "j int, s long").groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    found = {r.j: int(r.s) for r in rows}
    return Centre(found.get(-1, 0), [found.get(j, 0) for j in range(d)])


def bidiagonalise(multiply: Callable[[np.ndarray], tuple[np.ndarray, float]], d: int, steps: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (as columns) and singular values, largest first, of the X that ``multiply`` knows.

    multiply(w): X' u and u'u of u = X w.
    """
    rng = np.random.default_rng(seed)
    v_all, w_all, y_all, b = np.zeros((d, steps)), np.zeros((d, steps)), np.zeros((d, steps)), np.zeros((steps, steps))

    def fresh(j: int) -> np.ndarray:
        v = rng.standard_normal(d)
        for _ in range(3):
            v -= v_all[:, :j] @ (v_all[:, :j].T @ v)
            v /= np.linalg.norm(v)
        return v

    v, beta, scale = fresh(0), 0.0, 0.0
    for j in range(steps):
        v_all[:, j] = v
        w = v - beta * w_all[:, j - 1] if j else v.copy()
        y, square = multiply(w)
        for _ in range(2):
            along = w_all[:, :j].T @ y  # U' u
            w -= w_all[:, :j] @ along
            y -= y_all[:, :j] @ along
            square -= float(along @ along)
        alpha = float(np.sqrt(max(square, 0.0)))
        scale = max(scale, alpha, beta)
        if alpha > 1e-13 * scale:
            w_all[:, j], y_all[:, j], b[j, j] = w / alpha, y / alpha, alpha
            r = y_all[:, j] - alpha * v
        else:
            r = np.zeros(d)
        for _ in range(2):
            r -= v_all[:, : j + 1] @ (v_all[:, : j + 1].T @ r)
        beta = float(np.linalg.norm(r))
        if j + 1 == steps:
            break
        if beta > 1e-13 * scale:
            v, b[j, j + 1] = r / beta, beta
        else:
            v, beta = fresh(j + 1), 0.0
    _, values, right = np.linalg.svd(b)
    return v_all @ right.T, values


@dataclass
class Whitening:
    centre: Centre
    components: np.ndarray  # d x k
    values: np.ndarray  # singular values of the centred rows
    explained: np.ndarray
    identity_error: float

    def __call__(self, x: bytes) -> np.ndarray:
        """Whitened rows of a block."""
        return self.centre(x) @ self.components * (np.sqrt(self.centre.n) / self.values)


def fit(blocks: DataFrame, d: int, components: int, steps: int | None, seed: int) -> Whitening:
    """``steps`` below the dimension gives the largest components by Lanczos' approximation; none: all, exact."""
    centre = _totals(blocks, d)
    total = 0.0

    def multiply(w: np.ndarray) -> tuple[np.ndarray, float]:
        nonlocal total

        def of(x: bytes) -> np.ndarray:
            rows = centre(x)
            u = rows @ w
            return np.append(rows.T @ u, [u @ u, np.vdot(rows, rows)])

        *y, square, total = _summed(blocks, of)
        return np.array(y), square

    vectors, values = bidiagonalise(multiply, d, min(steps or d, d), seed) if centre.n else (np.zeros((d, 0)), np.zeros(0))
    k = min(components, int(np.sum(values > RANK * max(values, default=0.0))))
    fitted = Whitening(centre, vectors[:, :k] / np.linalg.norm(vectors[:, :k], axis=0), values[:k], values[:k] ** 2 / total if k else values[:0], 0.0)
    if k:
        mean = _summed(blocks, lambda x: fitted(x).sum(0)) / centre.n

        def products(x: bytes) -> np.ndarray:
            z = fitted(x) - mean
            return (z.T @ z).ravel()

        fitted.identity_error = float(np.abs(_summed(blocks, products).reshape(k, k) / centre.n - np.eye(k)).max())
    return fitted


def whiten(df: DataFrame, components: int = 32, scale: float = 64.0, shift: int = 1_000_000, steps: int | None = None, seed: int = 13, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Entries become x = floor(scale * c) + shift. deviation: the sum over the
    dimensions of (n * x - sum)**2, exact, null where a long can't hold it. whitened: x less
    the mean, on the component, over the root of its eigenvalue, so that the
    columns have covariance 1. explained: the eigenvalue's share of all.
    identity_error: the largest entry of the whitened covariance less 1.

    Vectors take no part that are null or empty or hold a null or non-finite
    entry, or one whose scaled value is 2**40 or more; nor do those of other
    than the most frequent dimension (of the largest of these, in a tie).
    Repeated rows count each and give rows each; a null id stays null. Components
    without variance can't be whitened: a table of rank r gives r components at
    most, one of equal vectors, or an empty one, no rows. Among equal eigenvalues
    the components are one choice of many. Other columns aren't looked at.
    """
    blocks, d = integer_blocks(df, scale, shift, id_col, vector_col)
    fitted = fit(blocks, d, components, steps, seed)
    k, n = len(fitted.values), fitted.centre.n
    names = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column("ids"), batch.column("x").to_pylist(), strict=True):
                ids, away = ids.values, fitted.centre.times_n(x)
                if away.dtype != object and int(np.abs(away).max(initial=0)) ** 2 * max(d, 1) >= 2**63:
                    away = away.astype(object)
                deviation = [s if s < 2**63 else None for s in (away * away).sum(1).tolist()]
                m = len(ids)
                columns = [
                    ids.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(fitted(x).ravel()), pa.array(np.tile(fitted.explained, m)), pa.array(np.full(m * k, fitted.identity_error)),
                ]
                made = pa.record_batch(columns, names=names)
                for at in range(0, m * k, 1 << 16):
                    yield made.slice(at, 1 << 16)

    return blocks.mapInArrow(rows, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
