import math
import random

import pytest

from roadlens.llm import topk


def _brute(rows, queries, k):
    def whole(x):
        return None if x is None or any(v is None or not math.isfinite(v) for v in x) else [math.floor(256 * v) for v in x]

    vectors = [(i, whole(x)) for i, x in rows if i is not None]
    out = []
    for i, q in queries:
        q = whole(q)
        if i is None or q is None:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, x, strict=False)), j) for j, x in vectors if x is not None and j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("block, chunk", [(8192, 1024), (16, 3)])
def test_best_are_those_of_brute_force(frame, monkeypatch, block, chunk):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "CHUNK", chunk)
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(300)]
    rows += [(i, rows[10][1]) for i in range(300, 360)]  # ties
    rows += [(400, None), (401, [1.0, None]), (402, [math.nan] * 12), (403, [math.inf] * 12), (404, [0.0] * 12), (405, []), (406, [0.5]), (None, [1.0] * 12), (12, rows[13][1])]
    df = frame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id % 20 = 0"))
    want = _brute(rows, [r for r in rows if r[0] is not None and r[0] % 20 == 0], 5)
    assert sorted(map(tuple, got.collect())) == want
    assert topk.top_k(df.limit(0), df).count() == 0 and topk.top_k(df, df.limit(0)).count() == 0


def test_large_numbers_stay_exact(frame):
    rows = [(i, [float(2**40 + i), -float(2**41)]) for i in range(4)]
    df = frame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df, k=2).collect()
    assert all(r.score == -(2**63) or abs(r.score) < 2**63 for r in got) and len(got) == 8
    fewer = topk.top_k(frame([(0, [0.1]), (1, [0.2])], "vec_id long, embedding array<double>"), df.limit(1), k=5)
    assert fewer.count() <= 5


def test_an_id_that_many_rows_share_fills_no_block(frame, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    lists = topk.Lists

    class Counted(lists):
        def __init__(self, ids, vectors):
            assert len(ids) < 120, "a block holds far more than its share"
            super().__init__(ids, vectors)

    monkeypatch.setattr(topk, "Lists", Counted)
    rows = [(7, [0.5, 0.25])] * 400 + [(i, [0.01 * i, -0.5]) for i in range(100, 400)]
    df = frame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, df.where("vec_id in (7, 100)").distinct()).collect()))
    assert got == _brute(rows, [rows[0], rows[400]], 5)
