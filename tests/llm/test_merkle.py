import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from roadlens.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, lower=False):
    values = [*row[:4], row[4].translate({c: c + 32 for c in range(65, 91)}) if lower and row[4] is not None else row[4]]
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _climb(digests):
    """Root, and for each leaf its (left, right) siblings by level."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // 8 * 8 : i // 8 * 8 + 8]
            paths[k].append((run[: i % 8], run[i % 8 + 1 :]))
        at = [i // 8 for i in at]
        level = [_h(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return level[0], paths


def brute(rows, tampered=lambda i: False):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    trees, names = {}, sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is None, r[0] or 0, _leaf(r)))
        trees[g] = _climb([_leaf(r) for r in groups[g]])
    root, above = _climb([trees[g][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for row, path in zip(groups[g], trees[g][1], strict=True):
            path = path + above[k]
            folded = _leaf(row, row[0] is not None and tampered(row[0]))
            for left, right in path:
                folded = _h(*left, folded, *right)
            out.append((row[0], _leaf(row), trees[g][0], root, "".join(d for left, right in path for d in left + right), folded, folded == root))
    return sorted(out, key=str)


def _got(df, **more):
    return sorted(map(tuple, merkle.manifest(df, **more).select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()), key=str)


def _row(rng, i, lang):
    text = rng.choice(["", None, "Some Text", "all lower", "ÄÖ Ünicode", "é" * 2000, f"Text {rng.random()}"])
    return (i, rng.choice([None, "src", "a:1", ""]), lang, rng.choice([None, 0, 17]), text)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 9}, {"en": 75, "de": 8, None: 3, "": 1, "fr": 64}, {f"l{k}": 1 + k % 3 for k in range(20)}])
def test_as_brute_force(frame, sizes):
    rng = random.Random(len(sizes))
    ids = iter(rng.sample(range(-500, 5000), sum(sizes.values())))
    rows = [_row(rng, next(ids), g) for g, n in sizes.items() for _ in range(n)]
    rng.shuffle(rows)
    tampered = lambda i: zlib.crc32(str(i).encode()) % 3 == 0
    df = frame(rows, SCHEMA).repartition(5)
    assert _got(df, tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0) == brute(rows, tampered)
    assert all(r[-1] for r in _got(df))


def test_ties_null_ids_and_repeated_rows(frame):
    rng = random.Random(4)
    rows = [_row(rng, 5, "en") for _ in range(20)] + [(1, "s", "en", 3, "same")] * 30 + [_row(rng, None, "en") for _ in range(5)] + [(None, None, None, None, None)] * 2
    assert _got(frame(rows, SCHEMA)) == brute(rows)


def test_many_groups_are_joined_without_broadcast(frame, monkeypatch):
    monkeypatch.setattr(merkle, "FEW_GROUPS", 2)
    rng = random.Random(6)
    rows = [_row(rng, i, rng.choice(["a", "b", None, "d"])) for i in range(60)]
    assert _got(frame(rows, SCHEMA)) == brute(rows)


def test_empty_table(frame):
    assert merkle.manifest(frame([(1, "s", "en", 1, "t")], SCHEMA).limit(0)).count() == 0


def test_a_hot_group_is_spread(spark, many_partitions):
    rows = spark.range(4000).select(F.lit("en").alias("g"), F.col("id").alias("doc_id"), F.lit("x").alias("digest"))
    made = merkle.ranked(rows, [F.col("g"), F.col("doc_id")])
    assert sorted((r.doc_id, r["rank"], r.n) for r in made.collect()) == [(i, i, 4000) for i in range(4000)]
    same = merkle.ranked(rows.withColumn("doc_id", F.lit(1)), [F.col("g"), F.col("doc_id")])
    assert sorted(r["rank"] for r in same.collect()) == list(range(4000))
