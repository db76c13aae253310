import math

import numpy as np
import pytest

from roadlens.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def _brute(vectors, k, scale=64, shift=1_000_000):
    x = np.floor(scale * np.array(vectors, float)).astype(int) + shift
    n, sums = len(x), x.sum(0)
    c = (n * x - sums) / n
    e, w = np.linalg.eigh(c.T @ c / n)
    e, w = e[::-1], w[:, ::-1]
    k = min(k, int((e > e[0] * 1e-14).sum()))
    return c @ w[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum(), ((n * x - sums) ** 2).sum(1)


def _table(made, k):
    rows = sorted(made.collect(), key=lambda r: (r.vec_id, r.component))
    return np.array([r.whitened for r in rows]).reshape(-1, k), np.array([r.explained for r in rows[:k]]), [r.deviation for r in rows[::k]], rows


def test_as_an_eigendecomposition(frame):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((500, 20)) @ np.diag(np.geomspace(5, 0.05, 20)) @ rng.standard_normal((20, 20)) + rng.standard_normal(20) * 30
    made = whitening.whiten(frame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA).repartition(3), components=8)
    got, explained, deviation, rows = _table(made, 8)
    want, share, exact = _brute(vectors, 8)
    got = got * np.sign((got * want).sum(0))
    assert np.abs(got - want).max() < 1e-8 and np.abs(explained / share - 1).max() < 1e-10 and deviation == exact.tolist()
    assert {r.n for r in rows} == {500} and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-10


def test_low_rank_and_equal_eigenvalues(frame):
    rng = np.random.default_rng(2)
    flat = np.vstack([s * np.eye(6)[i] for i in range(3) for s in (1.0, -1.0)] * 5)  # three equal eigenvalues, rank 3
    got, explained, _, rows = _table(whitening.whiten(frame([(i, v.tolist()) for i, v in enumerate(flat)], SCHEMA), components=32), 3)
    assert np.abs(got.T @ got / len(flat) - np.eye(3)).max() < 1e-10 and np.allclose(explained, 1 / 3) and max(r.component for r in rows) == 3
    few = rng.standard_normal((3, 10))  # fewer vectors than dimensions: rank 2
    assert {r.component for r in whitening.whiten(frame([(i, v.tolist()) for i, v in enumerate(few)], SCHEMA)).collect()} == {1, 2}
    same = frame([(i, [0.5] * 4) for i in range(9)], SCHEMA)
    assert whitening.whiten(same).count() == 0 and whitening.whiten(same.limit(1)).count() == 0 and whitening.whiten(same.limit(0)).count() == 0


def test_vectors_that_take_no_part(frame):
    rng = np.random.default_rng(3)
    good = [(i, rng.standard_normal(4).tolist()) for i in range(40)]
    bad = [(90, None), (91, [1.0, None, 1.0, 1.0]), (92, [math.nan] * 4), (93, [1.0, math.inf, 1.0, 1.0]), (94, []), (95, [1.0] * 5), (96, [1.0, 1.0, 1.0, 1e300])]
    made = whitening.whiten(frame(good + bad + [(None, good[0][1]), good[1]], SCHEMA), components=2)
    rows = made.collect()
    assert len(rows) == 2 * 42 and {r.n for r in rows} == {42} and sum(r.vec_id is None for r in rows) == 2 and sum(r.vec_id == 1 for r in rows) == 4
    want, _, exact = _brute([v for _, v in good] + [good[0][1], good[1][1]], 2)
    got = {(r.vec_id, r.component): r.whitened for r in rows}
    assert all(abs(abs(got[i, 1]) - abs(want[i, 0])) < 1e-10 for i in range(40)) and {r.deviation for r in rows} == set(exact.tolist())


def test_large_numbers_stay_exact(frame):
    vectors = [[float(2**30 + i), float(i * i), -float(2**33)] for i in range(50)]
    rows = whitening.whiten(frame([(i, v) for i, v in enumerate(vectors)], SCHEMA), components=1).collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((50 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in rows} == want
    huge = [[float(2**33) * (-1) ** i, 0.0] for i in range(50)]  # the exact sum is beyond a long
    assert {r.deviation for r in whitening.whiten(frame([(i, v) for i, v in enumerate(huge)], SCHEMA)).collect()} == {None}


@pytest.mark.parametrize("steps", [12, 30])
def test_few_steps_find_the_largest(steps):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 30)) @ np.diag([50, 30, 20, *[0.1] * 27])
    calls = []

    def multiply(w):
        calls.append(1)
        u = x @ w
        return x.T @ u, float(u @ u)

    vectors, values = whitening.bidiagonalise(multiply, 30, steps, 1)
    assert np.allclose(values[:3], np.linalg.svd(x)[1][:3]) and len(calls) == steps
    assert np.abs(vectors.T @ vectors - np.eye(steps)).max() < 1e-12


def test_blocks_are_split(frame, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 4 * 7)
    rng = np.random.default_rng(8)
    df = frame([(i, rng.standard_normal(4).tolist()) for i in range(60)], SCHEMA)
    blocks, d = whitening.integer_blocks(df, 64.0, 0, "vec_id", "embedding")
    assert d == 4 and all(len(r.ids) <= 7 and len(r.x) == 32 * len(r.ids) for r in blocks.collect()) and blocks.count() >= 9
