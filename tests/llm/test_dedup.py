import hashlib
import random

import pytest
import xxhash

from roadlens.llm import simhash, substring_dedup
from roadlens.llm.components import components


def _fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _groups(prints, distance):
    """least id reachable, by brute force"""
    ids = sorted(prints)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if bin(prints[a] ^ prints[b]).count("1") <= distance and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


@pytest.fixture(scope="module")
def near():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One"), (5, "two words")]
    for i in range(6, 90):
        w = list(base) if i % 3 else [rng.choice(words) for _ in range(80)]
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w)))
    return [*rows, (90, rows[10][1]), (90, rows[10][1])]


@pytest.mark.parametrize("bucket, distance", [(64, 2), (1, 2), (1, 1)])
def test_groups_are_those_of_brute_force(frame, near, monkeypatch, bucket, distance):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    got = simhash.near_duplicates(frame(near).repartition(3), max_distance=distance).collect()
    prints = {i: _fingerprint(t) for i, t in near}
    root = _groups(prints, distance)
    assert len(got) == len(near)
    for r in got:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == root[r.doc_id]


def test_one_of_each_keeps_one_row_a_group(frame, near):
    kept = simhash.one_of_each(frame([*near, (None, "no id here"), (None, "no id here")]))
    root = _groups({i: _fingerprint(t) for i, t in near}, 2)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(root.values()))
    assert kept.where("doc_id is null").count() == 1 and "print" in kept.columns
    assert simhash.near_duplicates(frame([]), max_distance=2).count() == 0


def test_thresholds_take_the_cheapest_split():
    cost, thresholds = simhash.allocate([[0, 10, 50, 90], [0, 1, 3, 90], [0, 11, 50, 90]], 3)
    assert sum(t + 1 for t in thresholds) == 3 and thresholds == [0, 1, -1] and cost == 13


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 300)] + [(7, 7), (None, 3), (100, 101)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 5 for i in range(200, 300)}


def _without_repeats(rows, size=20):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            if window in seen:
                gone[k : k + size] = [True] * size
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("common, most", [(512, 1 << 27), (1, 1 << 27), (512, 0), (1, 0)])
def test_repeats_are_those_of_brute_force(frame, monkeypatch, common, most):
    monkeypatch.setattr(substring_dedup, "COMMON", common)
    monkeypatch.setattr(substring_dedup, "MOST_BITS", most)  # 0: anchors are joined
    rng = random.Random(3)
    base = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(300)]
    rows = [(500, None), (501, ""), (502, "a b c")]
    for i in range(120):
        w = []
        for _ in range(rng.randint(0, 5)):
            a = rng.randint(0, 280)
            w += base[a : a + rng.randint(5, 90)] + [str(rng.random())] * rng.randint(0, 30)
        if i % 7 == 0:
            w = ["ab"] * rng.randint(0, 120)
        if i % 11 == 0:
            w = (["x", "y", "z"] * 60)[: rng.randint(0, 170)]
        rows.append((i, "\n".join(w)))
    want = _without_repeats(rows)
    got = substring_dedup.remove_repeats(frame([*rows, rows[5], rows[5]]).repartition(3)).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id]


def test_repeats_of_odd_rows(frame):
    text = " ".join(map(str, range(40)))
    got = substring_dedup.remove_repeats(frame([(None, text), (7, text), (None, text)])).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 0), (True, 40), (True, 40)]
    assert substring_dedup.remove_repeats(frame([])).count() == 0
    long = " ".join(map(str, range(30_000)))
    assert [r.n_removed for r in substring_dedup.remove_repeats(frame([(1, f"{long} {long}")])).collect()] == [30_000]


def test_rows_of_one_id_are_told_apart_beyond_32_bits(frame, spark):
    # two texts under a null id whose 32-bit hashes are equal: the second repeats the first's passage
    from pyspark.sql import functions as F

    passage = " ".join(f"w{k}" for k in range(30))
    many = spark.range(400_000).select(F.concat(F.lit(f"{passage} t"), F.col("id").cast("string")).alias("text"))
    hit = many.groupBy(F.hash("text", F.lit(True)).alias("h")).agg(F.collect_list("text").alias("t")).where("size(t) > 1").orderBy("h").first()
    got = substring_dedup.remove_repeats(frame([(None, t) for t in hit.t[:2]])).collect()
    assert sorted(r.n_removed for r in got) == [0, 30]


def test_a_range_beyond_its_text_is_an_error():
    import pyarrow as pa

    ranges = pa.array([[{"start": 5, "run": 1}]], pa.list_(pa.struct([("start", pa.int64()), ("run", pa.int64())])))
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["a b c"]), ranges], names=["doc_id", "text", "ranges"])
    with pytest.raises(ValueError):
        list(substring_dedup._kept([batch], 20))


def test_words_are_compared_whole(frame, monkeypatch):
    # hashes of all words equal: only the words themselves tell the windows apart
    monkeypatch.setattr(substring_dedup, "_hashes", lambda text: substring_dedup.np.full(len((text or b"").split()), 7, substring_dedup.np.uint64))
    texts = [b" ".join(b"%c%d" % (c, k) for k in range(30)) for c in b"ab"]
    anchors, first, runs = substring_dedup._segments(substring_dedup._hashes(texts[0]), 20)
    import pyarrow as pa

    found = [[{"anchor": int(x.view("i8")), "start": int(f), "run": int(r), "common": False} for x, f, r in zip(anchors, first, runs, strict=True)]] * 2
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("start", pa.int64()), ("run", pa.int64()), ("common", pa.bool_())]))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([1, 2]), pa.array([1, 2]), pa.array([t.decode() for t in texts]), pa.array(found, kind)], names=["id", "th", "tl", "text", "found"])
    pieces = pa.Table.from_batches(list(substring_dedup._pieces_of([batch], 20, 1)))
    assert pieces.num_rows and substring_dedup._shard(pieces, 20).num_rows == 0


@pytest.mark.parametrize("few", [100_000, 0])
def test_repeated_ids_and_the_largest_id(frame, monkeypatch, few):
    monkeypatch.setattr(substring_dedup, "FEW_IDS", few)
    a, b = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows = [(1, a), (2, f"{a} x"), (2, f"y {b}"), (2, f"{b} z"), (3, b), (2**63 - 1, f"{a} q"), (None, f"{a} q")]
    got = substring_dedup.remove_repeats(frame(rows)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got if r.doc_id != 2) == [(0, 31), (1, 0), (3, 30), (2**63 - 1, 30)]
    assert sorted(r.n_removed for r in got if r.doc_id == 2) == [0, 30, 30]


def test_windows_of_many_words(frame):
    passage = " ".join(f"w{k}" for k in range(1200))
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(frame([(1, passage), (2, f"x {passage} y"), (3, " ".join(passage.split()[:290]))]), size=300).collect()}
    assert got == {1: 0, 2: 1200, 3: 0}
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(frame([(1, passage)]), size=70_000)


def test_many_rows_alike_are_one_document(frame, spark):
    from pyspark.sql import functions as F

    text = " ".join(f"w{k}" for k in range(400))
    alike = spark.range(0, 5_000, numPartitions=4).select(F.lit(3).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    got = substring_dedup.remove_repeats(alike.unionByName(frame([(9, f"x {text}")]).select("doc_id", "text")))
    assert {(r.doc_id, r.n_removed, r["count"]) for r in got.groupBy("doc_id", "n_removed").count().collect()} == {(3, 0, 5_000), (9, 400, 1)}


def test_copies_are_dealt_to_all_shards():
    import pyarrow as pa

    text = " ".join(f"w{k}" for k in range(60))
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array([-1] * 400), pa.array([0] * 400), pa.array([text] * 400)], names=["id", "th", "tl", "text"])
    filters = substring_dedup.np.full((2, 16), 2**64 - 1, substring_dedup.np.uint64)
    filters[1] = 0
    pieces = pa.Table.from_batches(list(substring_dedup._pieces_of([batch], 20, 64, substring_dedup._filtered(filters))))
    dealt = [s for s, w in zip(*(pieces.column(c).to_pylist() for c in ("shard", "words")), strict=True) if w is None]
    assert len(dealt) >= 399 and max(dealt.count(s) for s in set(dealt)) < len(dealt) / 16


def test_the_filter_holds_every_anchor(spark):
    rng = substring_dedup.np.random.default_rng(4)
    anchors = rng.integers(-(2**63), 2**63 - 1, 3_000)
    again = spark.createDataFrame([(int(a), i % 3 == 0) for i, a in enumerate(anchors)], "anchor long, common boolean")
    filters = substring_dedup._filters(again, 1 << 16)
    repeated, common = substring_dedup._told(filters, anchors.view(substring_dedup.np.uint64))
    assert repeated.all() and common[::3].all() and common.mean() < 0.4
    others = substring_dedup._told(filters, rng.integers(0, 2**63 - 1, 3_000).astype(substring_dedup.np.uint64))[0]
    assert others.mean() < 0.08


def test_words_of_a_batch_are_those_of_each_text():
    import pyarrow as pa

    rng = random.Random(6)
    texts = [None, "", " \t", "a", "a b", "\x0bé  ü\n", "b", "x" * 50 + " y", *("".join(rng.choice("ab \n\u00a0") for _ in range(rng.randint(0, 40))) for _ in range(300))]
    words = substring_dedup.Words(pa.array([*texts, "q"])[:-1])
    split = [(t or "").encode().split() for t in texts]
    assert words.doc.tolist() == [i for i, w in enumerate(split) for _ in w]
    flat = [w for ws in split for w in ws]
    assert [words.data[a:b].tobytes() for a, b in zip(words.first, words.end, strict=True)] == flat
    known = {}
    assert all(known.setdefault(w, h) == h for w, h in zip(flat, words.hashes.tolist(), strict=True)) and len(set(known.values())) == len(known)
    bytes_of = words.travelling()
    for i, ws in enumerate(split):
        if ws:
            assert bytes_of(int(words.base[i]), len(ws)) == b" ".join(substring_dedup._travelling(ws))


def test_hashes_do_not_depend_on_place():
    import pyarrow as pa

    long = "z" * (3 * substring_dedup.BLOCK)
    text = " ".join([*(f"w{k % 1000}" for k in range(200_000)), long, "tail", long])
    hashes = substring_dedup.Words(pa.array([text])).hashes
    assert len(hashes) == 200_003 and (hashes[:1000] == hashes[199_000:200_000]).all() and hashes[200_000] == hashes[200_002] != hashes[200_001]
