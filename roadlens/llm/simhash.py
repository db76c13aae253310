"""SimHash near-dedup with the generalised pigeonhole principle.

A text's fingerprint has a bit set where over half of its shingles' hashes
have. Fingerprints within ``max_distance`` bits are linked, and documents
belong together along links.

Search, over the distinct fingerprints only:

1. The 64 bits are split into parts that group correlated bits, by counts over
   all fingerprints.
2. Part i gets a threshold t(i) >= -1 such that the sum of t(i) + 1 is
   max_distance + 1: then two fingerprints within max_distance agree up to
   t(i) bits in some part i with t(i) >= 0. Which part gets how much is settled
   by dynamic programming on the candidates estimated for each part and
   threshold. A split into one part more is tried as well.
3. Each fingerprint probes its parts' buckets with the values up to t(i) flips
   away, and every pair that meets is verified on all bits.
4. A bucket of over ``BUCKET`` fingerprints would make too many pairs. Its
   members are linked another exact way: each is written under every value
   up to ceil(max_distance / 2) flips away; whoever shares such a value is
   joined to its least member. This is linear in the members and loses no link.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import checkpointed, fresh, id_and_text, row_key, slices
from roadlens.llm.components import components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Larger buckets are searched by shared neighbours.
BUCKET = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of lower-cased words; signed, as Spark's long. No word: 0."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 1 << 16):
        hashes = np.array([digest(s, seed) for s in shingles[at : at + (1 << 16)]], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(shingles), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(df: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the two parts of its row_key, and its fingerprint as a long."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [fingerprint(t or b"", shingle, seed) for t in batch.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key_id"), batch.column("key_text"), pa.array(found, pa.int64())], names=["doc_id", "key_id", "key_text", "print"])

    given = id_and_text(df, id_col, text_col)
    key_id, key_text = row_key("doc_id", "text")
    return given.select("doc_id", key_id.alias("key_id"), key_text.alias("key_text"), "text").mapInArrow(run, "doc_id long, key_id long, key_text long, print long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bit_counts(prints: DataFrame) -> np.ndarray:
    """64 x 64: how many fingerprints have both bits; 4,096 sums whatever the input."""

    def run(batches):
        total = np.zeros((64, 64))
        for batch in batches:
            values = np.asarray(batch.column("print"), np.int64)
            for at in range(0, len(values), 1 << 16):
                bits = np.unpackbits(values[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
                total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096, dtype=np.int32)), pa.array(total.ravel().astype(np.int64))], names=["cell", "n"])

    made = np.zeros(4096)
    for row in prints.select("print").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        made[row.cell] = row.n
    return made.reshape(64, 64)


def _parts(counts: np.ndarray, n: int, m: int) -> list[int]:
    """m masks of nearly equal width; each takes the bits most correlated with those it has."""
    p = counts.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = np.abs(counts / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    free, masks = set(range(64)), []
    for k in range(m):
        width = (64 - (64 - len(free))) // (m - k)
        part = [max(sorted(free), key=lambda b: correlation[b, sorted(free)].sum())]
        free.remove(part[0])
        while len(part) < width:
            part.append(max(sorted(free), key=lambda b: correlation[b, part].sum()))
            free.remove(part[-1])
        masks.append(sum(1 << b for b in part))
    return masks


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t(i) >= -1 with sum of t(i) + 1 = total at the least cost; costs[i][t + 1] is part i's at t."""
    best: list[tuple[float, list[int]] | None] = [(0.0, [])] + [None] * total
    for cost in costs:
        now: list[tuple[float, list[int]] | None] = [None] * (total + 1)
        for used, so_far in enumerate(best):
            for share in range(total - used + 1):
                if so_far is not None and share < len(cost):
                    there = (so_far[0] + cost[share], [*so_far[1], share - 1])
                    if now[used + share] is None or there[0] < now[used + share][0]:
                        now[used + share] = there
        best = now
    assert best[total] is not None
    return best[total]


def _plan(prints: DataFrame, n: int, max_distance: int) -> list[tuple[int, int]]:
    """(mask, threshold) of the parts to probe."""
    counts = _bit_counts(prints)
    choices = [_parts(counts, n, m) for m in (max_distance + 1, max_distance + 2)]
    masks = sorted({mask for choice in choices for mask in choice})
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]))
    met = prints.select(keys.alias("k")).groupBy("k.part", "k.key").count().groupBy("part").agg(F.sum(F.expr("count * (count - 1.0) / 2")).alias("pairs"))
    pairs = {masks[r.part]: float(r.pairs) for r in met.collect()}

    def costs(mask: int) -> list[float]:
        width = bin(mask).count("1")
        values = [sum(comb(width, j) for j in range(t + 1)) for t in range(max_distance + 1)]
        return [0.0, *[(pairs.get(mask, 0.0) + n) * v for v in values]]

    found = [(*allocate([costs(m) for m in choice], max_distance + 1), choice) for choice in choices]
    _, thresholds, chosen = min(found, key=lambda x: x[0])
    return [(m, t) for m, t in zip(chosen, thresholds, strict=True) if t >= 0]


def _flips(bits: list[int], most: int) -> list[tuple[int, int]]:
    """(mask, number of bits) of each way to flip up to ``most`` of the bits."""
    return [(_signed(sum(1 << b for b in c)), k) for k in range(most + 1) for c in combinations(bits, k)]


def links(prints: DataFrame, max_distance: int = 2) -> DataFrame:
    """(a, b) over distinct values of ``print``: enough pairs within max_distance that what is reachable is the same."""
    n = prints.count()
    probes = []
    for part, (mask, t) in enumerate(_plan(prints, n, max_distance)):
        ways = _flips([b for b in range(64) if mask >> b & 1], t)
        key = F.col("print").bitwiseAND(F.lit(_signed(mask)))
        if len(ways) == 1:
            probes.append(prints.select(F.lit(part).alias("part"), key.alias("key"), "print", F.lit(0).alias("flips")))
        else:
            way = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.lit(k).alias("k")) for m, k in ways]))
            probes.append(prints.select("print", key.alias("key"), way.alias("w")).select(F.lit(part).alias("part"), F.col("key").bitwiseXOR(F.col("w.m")).alias("key"), "print", F.col("w.k").alias("flips")))
    probes = reduce(DataFrame.union, probes)
    met = probes.groupBy("part", "key").agg(F.count("*").alias("n")).where("n > 1")
    probes = checkpointed(probes.join(met, ["part", "key"]))

    few = probes.where(F.col("n") <= BUCKET)
    a = few.where("flips = 0").select("part", "key", F.col("print").alias("a"))
    b = few.select("part", "key", F.col("print").alias("b"), "flips")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    verified = a.join(b, ["part", "key"]).where(((F.col("flips") > 0) & (F.col("a") != F.col("b")) | (F.col("a") < F.col("b"))) & near).select("a", "b")

    hot = probes.where(F.col("n") > BUCKET).select("print").distinct()
    ways = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(k).alias("k")) for m, k in _flips(list(range(64)), (max_distance + 1) // 2)])
    around = hot.select("print", F.explode(ways).alias("w"))
    around = around.select(F.col("print").bitwiseXOR(F.col("w.m")).alias("key"), "print", F.col("w.k").alias("k"))
    centre = around.groupBy("key").agg(F.min(F.when(F.col("k") <= max_distance // 2, F.col("print"))).alias("a"), F.count("*").alias("n")).where("n > 1 and a is not null")
    shared = around.join(centre, "key").where("print <> a").select("a", F.col("print").alias("b"))
    return verified.union(shared).distinct()


def near_duplicates(df: DataFrame, shingle: int = 3, max_distance: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable, its own included).

    A null or empty text, or one without words, has fingerprint
    zero and is linked like any other. Repeated rows each give a row, with the
    same result. A null id never is a component's id, unless the component has
    no other. An empty table gives no rows; other columns aren't looked at.
    """
    return _grouped(df, shingle, max_distance, seed, id_col, text_col).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, shingle: int = 3, max_distance: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of df, all columns, of each group of near_duplicates().

    The one with the least id stays, one with a null id only where there is no
    other; among rows with that id, the one with the least hash of its text.
    Of rows alike in id and text, any one.
    """
    groups = _grouped(df, shingle, max_distance, seed, id_col, text_col)
    a, b, c, d = fresh(df, "key_id", "key_text", "first_id", "first_text")
    first = groups.groupBy("root").agg(F.min(F.struct("key_id", "key_text")).alias("f")).select(F.col("f.key_id").alias(c), F.col("f.key_text").alias(d))
    key_id, key_text = row_key(id_col, text_col)
    kept = df.withColumn(a, key_id).withColumn(b, key_text).join(first, (F.col(a) == F.col(c)) & (F.col(b) == F.col(d)))
    return kept.dropDuplicates([a, b]).select(*df.columns)


def _grouped(df: DataFrame, shingle: int, max_distance: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """fingerprints(), with root, one fingerprint of the group, and component_id."""
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance must be 0, 1 or 2: beyond, the neighbours of a value are too many to list")
    documents = checkpointed(fingerprints(df, shingle, seed, id_col, text_col))
    prints = checkpointed(documents.groupBy("print").agg(F.min("doc_id").alias("first_id")))
    found = checkpointed(links(prints.select("print"), max_distance))
    roots = components(found, "a", "b")
    named = prints.join(roots, prints["print"] == roots["node"], "left")
    named = named.select("print", "first_id", F.coalesce("root", "print").alias("root"))
    classes = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return documents.join(named.join(classes, "root").select("print", "root", "component_id"), "print")
