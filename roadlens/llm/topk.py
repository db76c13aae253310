"""Exact top-k by inner product, with Fagin's threshold algorithm.

Vectors are dealt to blocks of bounded size by their place in the stored table,
so that rows of one id, or copies of one vector, fill no block. In a block, each dimension has a
list of its vectors sorted by that component. A query reads the lists of its
non-zero dimensions in step, from the end where its weight gains most, scores
each vector it meets on all dimensions, and keeps the k best. After each round,
a vector not yet met scores at most the sum of weight times the component
reached in each list. Once that bound is below the kth best score the block is
done: an equal bound goes on, for an unmet vector could tie with a smaller id.

Queries come in chunks of bounded size; every chunk meets every block in a task
of its own, and only k rows a query and block go on to be merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import stored

#: Rows of a block and queries of a chunk.
BLOCK, CHUNK = 8_192, 1_024
#: Entries read from each list in the first round; each later round reads twice as many.
FIRST = 64
EXACT = 2**53


class Lists:
    """The sorted lists of one block, and the vectors for random access."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        # one list for each dimension and end; ties come by id either way
        self.rising = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)
        self.falling = np.argsort(-self.vectors, axis=0, kind="stable").astype(np.int32)

    def top(self, own: int | None, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) of the block, by score, then id; the row with id ``own`` is left out."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        weights = query[used]
        up, down = used[weights > 0], used[weights < 0]
        met = np.zeros(n, bool)
        if own is not None:
            met[self.ids == own] = True
        best_scores, best_rows = np.zeros(0, query.dtype), np.zeros(0, np.int64)
        done, step = 0, FIRST
        while done < n:
            upto = min(n, done + step) if len(used) else n
            here = np.full(n, not len(used))
            here[self.falling[done:upto, up]] = True
            here[self.rising[done:upto, down]] = True
            new = np.flatnonzero(here & ~met)
            met |= here
            scores = np.concatenate([best_scores, self.vectors[new] @ query])
            rows = np.concatenate([best_rows, new])
            order = np.lexsort((rows, -scores))[:k]  # rows are in the order of ids
            best_scores, best_rows = scores[order], rows[order]
            if met.all():
                break
            if len(best_scores) == k:
                ends = ((up, self.falling[upto - 1, up]), (down, self.rising[upto - 1, down]))
                if sum((query[d] * self.vectors[rows_, d]).sum() for d, rows_ in ends) < best_scores[-1]:
                    break
            done, step = upto, step * 2
        return [(int(s), int(self.ids[r])) for s, r in zip(best_scores, best_rows, strict=True)]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled up with zeros; float64 where sums stay exact, else Python's integers."""
    rows = column.to_pylist()
    largest = max((abs(x) for r in rows for x in r), default=0)
    out = np.zeros((len(rows), width), np.float64 if largest * largest * max(width, 1) < EXACT else object)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best rows of ``vectors`` but its own, fewer if there are fewer.

    A component x counts as floor(scale * x), x as double; a score is the inner
    product, a whole number. Ties go to the smaller id. A vector that is null, or holds
    a null or a component that isn't finite, takes no part, nor does one with a null id;
    one that is shorter than another counts as filled up with zeros. A component or score beyond a
    long stops at the nearest long. Rows with the same id are each a candidate
    to others; a query counts once, and of queries with the same id and
    different vectors the k best of all answers stay. An empty table gives no
    rows; other columns aren't looked at.
    """

    def clean(df: DataFrame) -> DataFrame:
        x = F.col(vector_col).cast("array<double>")
        finite = F.forall("x", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))  # NaN is above infinity here
        whole = F.transform("x", lambda v: F.floor(v * scale).cast("long"))
        return df.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull() & finite).select("id", whole.alias("x"))

    candidates, asked = clean(vectors), clean(queries).distinct()
    place = F.monotonically_increasing_id()
    candidates = stored(candidates.withColumn("place", F.xxhash64(place)), "topk")  # written, so that a lost task deals its rows alike
    n, n_asked = candidates.count(), asked.count()
    blocks, chunks = max(1, -(-n // BLOCK)), max(1, -(-n_asked // CHUNK))
    left = candidates.select(F.pmod("place", F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "id", "x")
    right = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("id", "x"), F.lit(chunks)).cast("int").alias("chunk"), "id", "x")

    def search(block: pa.Table, chunk: pa.Table) -> pa.Table:
        out = []
        if len(block) and len(chunk):
            width = max(len(x) for t in (block, chunk) for x in t.column("x").to_pylist())
            a, b = _matrix(block.column("x"), width), _matrix(chunk.column("x"), width)
            if a.dtype != b.dtype or a.dtype != object and np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1) >= EXACT:
                a, b = a.astype(object), b.astype(object)
                to_int = np.frompyfunc(int, 1, 1)
                a, b = to_int(a), to_int(b)
            lists = Lists(np.asarray(block.column("id"), np.int64), a)
            for q, vector in zip(chunk.column("id").to_pylist(), b, strict=True):
                out += [(q, i, max(-(2**63), min(2**63 - 1, s))) for s, i in lists.top(q, vector, k)]
        columns = zip(*out, strict=True) if out else [[]] * 3
        return pa.Table.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    found = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
