"""Removal of repeated passages by FM-index.

A window of ``size`` consecutive words goes if the same words also start
earlier in the corpus: in a smaller doc_id, or earlier in the same document. A
word covered by such a window is removed.

One index over all documents, or every document streamed past every shard's
index, would not scale. So windows are dealt to shards by what they contain:

1. Each window names its *anchor*, the least hash among its runs of ``SEED``
   words. Equal windows name equal anchors. Neighbouring windows mostly share
   theirs, so a document falls into segments of at most ``size - SEED + 1``
   windows each.
2. Anchors that occur once in the corpus can't lie in a repeated window; their
   segments are done. (Occurrences are counted, not sampled.) The repeated ones
   reach the texts as a filter of bits, whose false hits only cost a way to a shard;
   where they are too many for its bound, by a join.
3. The remaining segments go to the shard of their anchor. An anchor that
   occurs very often would overload its shard, so its segments are cut into
   single windows, each dealt by a hash of its words. Copies of a segment are
   merged before they travel: all but the earliest are removed whole.
4. A shard builds a compressed FM-index over its distinct segments: suffix
   order to ``size`` words, Burrows-Wheeler transform, wavelet matrix with
   packed bits. The segments are streamed through it by backward search, all
   their windows at a time. The matching statistics end at ``size`` words;
   a window whose interval shrinks to one row occurs once and leaves early. For
   the intervals left, the earliest start in the interval decides.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import NO_ID, checkpointed, id_and_text, slices, stored

#: Words of an anchor.
SEED = 8
#: Segments of an anchor with more occurrences than this are cut into single windows.
COMMON = 512
#: Bytes of text for each shard of the index.
SHARD = 4 << 20
#: Bytes of text that are cut into segments at a time.
PART = 1 << 20
#: Segments that a task merges at a time before it hands them on.
MERGED = 40_000

#: Bits of the filter for each repeated anchor, and the most bits that it may have; beyond, anchors are joined.
BITS, MOST_BITS = 16, 1 << 27

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_PLACE = np.uint64((1 << 24) - 1)
#: Up to so many repeated ids are broadcast, so that rows of other ids travel without a digest.
FEW_IDS = 100_000
#: Words of more bytes than this travel as a digest of 128 bits; all others as they are.
LONG = 40


def _travelling(words: list[bytes]) -> list[bytes]:
    """The words, long ones as a line feed, which no word holds, and their digest."""
    return [w if len(w) <= LONG else b"\n" + xxhash.xxh3_128_hexdigest(w).encode() for w in words]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes whose words are hashed at a time.
BLOCK = 1 << 18


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    bases = (int(_A), pow(int(_A), -1, 1 << 64))
    return tuple(np.multiply.accumulate(np.array([1, *[x] * (2 * BLOCK)], np.uint64)) for x in bases)


class Words:
    """The words of a column of texts, in one sequence: hashes, document (row), first byte and byte after the last."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.binary()), b"")
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        self.data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        self.space = _IS_SPACE[self.data]
        first, last = ~self.space, ~self.space
        first[1:] &= self.space[:-1]
        last[:-1] &= self.space[1:]
        some = np.diff(ends) > 0  # a text's edge ends a word, too
        first[ends[:-1][some]] = ~self.space[ends[:-1][some]]
        last[ends[1:][some] - 1] = ~self.space[ends[1:][some] - 1]
        self.first, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(ends[1:], self.first, side="right")
        #: The first word of each document.
        self.base = np.searchsorted(self.doc, np.arange(len(texts)))
        self.hashes = self._hashed()

    def _hashed(self) -> np.ndarray:
        up, down = _powers()
        out = np.empty(len(self.first), np.uint64)
        edges = np.unique(np.append(np.searchsorted(self.first, np.arange(0, len(self.data), BLOCK)), len(self.first)))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            low = int(self.first[a])
            high = min(int(self.end[b - 1]), low + 2 * BLOCK)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((self.data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
            first, end = self.first[a:b] - low, np.minimum(self.end[a:b] - low, high - low)
            out[a:b] = (sums[end] - sums[first]) * down[first]
            if self.end[b - 1] > high:  # a word of more bytes than a block
                out[b - 1] = xxhash.xxh3_64_intdigest(self.data[self.first[b - 1] : self.end[b - 1]].tobytes())
        out ^= out >> np.uint64(31)
        return out * _B

    def travelling(self):
        """A function of a first word and a number of words: their bytes as they travel."""
        keep = ~self.space
        keep[1:] |= ~self.space[:-1]
        at = np.zeros(len(keep) + 1, np.int32)
        np.cumsum(keep, out=at[1:], dtype=np.int32)
        clean = np.where(self.space, np.uint8(32), self.data)[keep].tobytes()
        first, end = at[self.first].tolist(), at[self.end].tolist()
        long = np.concatenate([[0], np.cumsum(self.end - self.first > LONG)]).tolist()

        def of(a: int, n: int) -> bytes:
            piece = clean[first[a] : end[a + n - 1]]
            return b" ".join(_travelling(piece.split(b" "))) if long[a + n] != long[a] else piece

        return of


def _hashes(text: bytes | None) -> np.ndarray:
    return Words(pa.array([text], pa.binary())).hashes


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A + b * _B
    x ^= x >> np.uint64(29)
    return x * _C


def _segments(words: np.ndarray, size: int, doc: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each segment; no window lies in two documents (``doc``, of each word)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    seeds, reach = words, 1
    while reach < SEED:  # a power of two
        seeds = _mixed(seeds[:-reach], seeds[reach:])
        reach *= 2
    across = size - SEED + 1
    # the hash above, the place below, so that one minimum gives both; of equals the last
    least, have = seeds & ~_PLACE | _PLACE - np.arange(len(seeds), dtype=np.uint64) & _PLACE, 1
    while have * 2 <= across:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < across:
        least = np.minimum(least[: len(least) - (across - have)], least[across - have :])
    low = (_PLACE - least & _PLACE).astype(np.int64)
    at = np.arange(n) + (low - np.arange(n)) % (int(_PLACE) + 1)
    doc = np.zeros(len(words), np.int64) if doc is None else doc
    whole = doc[:n] == doc[size - 1 :]
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:n] != doc[: n - 1]) | (whole[1:] != whole[:-1])]))
    runs = np.diff(np.concatenate([first, [n]]))
    first, runs = first[whole[first]], runs[whole[first]]
    return seeds[at[first]], first, runs


class WaveletMatrix:
    """Rank over a sequence of small integers; one packed bit vector a level, with running counts."""

    def __init__(self, values: np.ndarray, largest: int):
        self.levels = []
        self.n = len(values)
        for shift in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            bits = (values >> shift & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed))]).astype(np.int32)
            zeros = self.n - int(bits.sum())
            self.levels.append((shift, packed, ones, zeros))
            values = np.concatenate([values[~bits], values[bits]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        start = np.zeros_like(end)
        for shift, packed, ones, zeros in self.levels:
            one = (symbol >> shift & 1).astype(bool)
            low, high = (ones[i >> 6] + np.bitwise_count(packed[i >> 6] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))) for i in (start, end))
            start = np.where(one, zeros + low, start - low)
            end = np.where(one, zeros + high, end - high)
        return end - start


class FmIndex:
    """Backward search for patterns of up to ``most`` symbols in a text of symbols >= 0."""

    def __init__(self, text: np.ndarray, most: int):
        n = len(text)
        rank, reach = text.astype(np.int64), 1
        while True:
            following = np.full(n, -1, np.int64)
            following[: max(0, n - reach)] = rank[reach:]
            key = rank * (n + 2) + following + 1 if reach > 1 else rank * (int(rank.max(initial=0)) + 2) + following + 1
            self.order = np.argsort(key, kind="stable")
            step = np.concatenate([[False], np.diff(key[self.order]) != 0])[:n]
            rank = np.empty(n, np.int64)
            rank[self.order] = np.cumsum(step)
            reach *= 2
            if reach > most or rank.max(initial=0) == n - 1:
                break
        self.largest = int(text.max(initial=0))
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.largest + 1))])
        self.bwt = WaveletMatrix(text[self.order - 1], self.largest)  # the row of the whole text wraps to its last symbol

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the patterns that get this symbol in front."""
        return self.below[symbol] + self.bwt.rank(symbol, low), self.below[symbol] + self.bwt.rank(symbol, high)


def _repeated(contents: list[np.ndarray], owner: np.ndarray, size: int) -> list[np.ndarray]:
    """For each distinct segment (its words), which of its windows start earlier elsewhere.

    owner: rows of (id, two halves of the text's digest, first word) of the segments.
    """
    sizes = np.array([len(c) for c in contents])
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    n = int((sizes + 1).sum())
    _, codes = np.unique(np.concatenate(contents), return_inverse=True)
    text = np.zeros(n, np.int64)  # 0 ends each segment
    inside = np.ones(n, bool)
    inside[starts + sizes] = False
    text[inside] = codes + 1
    index = FmIndex(text, size + 1)

    segment = np.repeat(np.arange(len(sizes)), sizes + 1)
    offset = np.arange(n) - starts[segment]
    windows = np.flatnonzero(offset <= sizes[segment] - size)
    by_place = np.lexsort((owner[segment[windows], 3] + offset[windows], owner[segment[windows], 2], owner[segment[windows], 1], owner[segment[windows], 0]))
    place = np.full(n, n, np.int64)  # of the windows, in the order that decides
    place[windows[by_place]] = np.arange(len(windows))

    here = windows
    last = text[here + size - 1]
    low, high = index.below[last], index.below[last + 1]
    for k in range(size - 2, -1, -1):
        more = high - low > 1  # a single row is the window itself
        here, low, high = here[more], low[more], high[more]
        if not len(here):
            break
        low, high = index.extend(text[here + k], low, high)
    more = high - low > 1
    here, low, high = here[more], low[more], high[more]
    later = np.zeros(n, bool)
    if len(here):
        rows = np.append(place[index.order], n)
        lows, which = np.unique(low, return_inverse=True)
        highs = np.zeros_like(lows)
        highs[which] = high
        least = np.minimum.reduceat(rows, np.stack([lows, highs], axis=1).ravel())[::2]
        later[here] = place[here] > least[which]
    return [later[a : a + s - size + 1] for a, s in zip(starts, sizes, strict=True)]


def _slots(anchors: np.ndarray, bits: int) -> np.ndarray:
    """An anchor's bit in a filter of so many bits, a power of two. Anchors are least hashes, so they are mixed again."""
    return (_mixed(anchors, anchors) >> np.uint64(65 - bits.bit_length())).astype(np.int64)


def _filters(again: DataFrame, bits: int) -> np.ndarray:
    """Bits of the repeated anchors and of the common ones, in rows of 64-bit words; bits / 4 bytes for the driver."""

    def words(batches):
        for part in batches:
            slots = _slots(part.column("anchor").to_numpy(zero_copy_only=False).view(np.uint64), bits)
            common = part.column("common").to_numpy(zero_copy_only=False).astype(bool)
            at = np.concatenate([slots, slots[common] + bits])
            value = np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(value)], names=["word", "value"])

    found = again.mapInArrow(words, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    out = np.zeros(2 * bits // 64, np.int64)
    out[np.asarray(found.column("word"), np.int64)] = np.asarray(found.column("value"), np.int64)
    return out.view(np.uint64).reshape(2, -1)


def _told(filters: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which anchors may be repeated, and which may be common: every one that is, and a few more."""
    slots = _slots(anchors, filters.shape[1] * 64)
    repeated, common = (filters[:, slots >> 6] >> (slots & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
    return repeated, common


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


_PIECE = pa.schema([("shard", pa.int64()), ("id", pa.int64()), ("th", pa.int64()), ("tl", pa.int64()), ("start", pa.int64()), ("run", pa.int64()), ("words", pa.binary())])
_RANGE = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("tl", pa.int64()), ("start", pa.int64()), ("run", pa.int64())])


def _joined(part: pa.RecordBatch, words: Words, size: int) -> list[list]:
    """Row, first word, windows, anchor and commonness of the segments whose anchors are repeated, in order: as joined."""
    found = part.column("found")
    ends = found.offsets.to_numpy()
    start, run, anchor, common = (found.values.field(c).to_numpy(zero_copy_only=False)[ends[0] : ends[-1]] for c in ("start", "run", "anchor", "common"))
    row = np.repeat(np.arange(len(part)), np.diff(ends))
    first = words.base[row] + start
    order = np.argsort(first, kind="stable")
    return [c[order].tolist() for c in (row, first, run, anchor, common)]


def _filtered(filters: np.ndarray):
    """The same, by the filter."""

    def of(part: pa.RecordBatch, words: Words, size: int) -> list[list]:
        anchor, first, run = _segments(words.hashes, size, words.doc)
        repeated, common = _told(filters, anchor)
        return [c[repeated].tolist() for c in (words.doc[first], first, run, anchor.view(np.int64), common)]

    return of


def _pieces_of(batches, size: int, shards: int, segments_of=_joined):
    """Segments that wait for a shard's index, and, without words, ranges of windows that are later copies."""
    merged: dict[bytes, tuple] = {}
    out: list[tuple] = []

    def batch():
        rows = [*out, *((shard, *place, run, words) for words, (place, run, shard) in merged.items())]
        out.clear()
        merged.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECE.types, strict=True)], schema=_PIECE) if rows else None

    def add(words: bytes, place: tuple, run: int, shard: int):
        known = merged.get(words)
        if known is None:
            merged[words] = (place, run, shard)
        elif known[0] != place:  # a repeated row is no copy of itself
            first, second = sorted((known[0], place))
            merged[words] = (first, run, shard)
            if out and out[-1][1:4] == second[:3] and out[-1][4] + out[-1][5] == second[3]:
                out[-1] = (*out[-1][:5], out[-1][5] + run, None)
            else:
                out.append((hash(second) % shards, *second, run, None))  # dealt evenly; no shard needs it

    for whole in batches:
        for part in slices(whole, "text", PART):
            words = Words(part.column("text"))
            segments = segments_of(part, words, size)
            if not segments[0]:
                continue
            keys = list(zip(*(part.column(c).to_pylist() for c in ("id", "th", "tl")), strict=True))
            base, bytes_of = words.base.tolist(), words.travelling()
            for row, first, run, anchor, common in zip(*segments, strict=True):
                key, start = keys[row], first - base[row]
                if common:
                    for k in range(run):
                        window = bytes_of(first + k, size)
                        add(window, (*key, start + k), 1, xxhash.xxh3_64_intdigest(window) % shards)
                else:
                    add(bytes_of(first, run + size - 1), (*key, start), run, anchor % shards)
                if len(merged) + len(out) > MERGED and (made := batch()):
                    yield made
    if made := batch():
        yield made


def _shard(table: pa.Table, size: int) -> pa.Table:
    """Ranges of windows to remove, of the segments of one shard."""
    ranges: list[tuple] = []
    merged: dict[bytes, tuple] = {}
    for *place, run, words in zip(*(table.column(c).to_pylist() for c in ("id", "th", "tl", "start", "run", "words")), strict=True):
        place = tuple(place)
        if words is None:
            ranges.append((*place, run))
        elif (known := merged.get(words)) is None or known == place:
            merged[words] = place
        else:
            merged[words] = min(known, place)
            ranges.append((*max(known, place), run))
    if len(merged) > 1 or merged and next(iter(merged)).count(b" ") >= size:
        codes: dict[bytes, int] = {}
        contents = [np.array([codes.setdefault(w, len(codes)) for w in words.split(b" ")], np.int64) for words in merged]
        owner = np.array(list(merged.values()), np.int64)
        for (*key, start), flags in zip(merged.values(), _repeated(contents, owner, size), strict=True):
            ranges += [(*key, start + a, b) for a, b in _runs(flags)]
    columns = zip(*ranges, strict=True) if ranges else [[]] * 5
    return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _RANGE.types, strict=True)], schema=_RANGE)


def _kept(batches, size: int):
    for whole in batches:
        for part in slices(whole, "text"):
            n_words, n_removed, digests, texts = [], [], [], []
            for text, ranges in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("ranges").to_pylist(), strict=True):
                words = (text or b"").split()
                if ranges:
                    cover = np.zeros(len(words) + 1, np.int64)
                    for r in ranges:
                        end = r["start"] + r["run"] + size - 1
                        if end > len(words):
                            raise ValueError(f"words {r['start']} to {end} of a text of {len(words)} words: not the text they were found in")
                        cover[r["start"]] += 1
                        cover[end] -= 1
                    kept = [w for w, c in zip(words, np.cumsum(cover).tolist(), strict=False) if not c]
                else:
                    kept = words
                texts.append(b" ".join(kept))
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(texts[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def remove_repeats(df: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and kept_text (the words left, joined by one space).

    A null text has no words. Rows with the same id are ordered by a 127-bit
    digest of their texts; rows alike in id and that digest are one document, and
    each gets that document's result. Words are compared as they are, those of more than
    ``LONG`` bytes by a 128-bit digest. Rows with a null id come after all others. An empty
    table gives no rows; other columns aren't looked at. Texts are read whole.
    """
    if size < SEED:
        raise ValueError(f"size must be at least {SEED}")
    if size - SEED + 1 > 65535:
        raise ValueError(f"size must be at most {65535 + SEED - 1}: a segment's number of windows travels in 16 bits")
    given = id_and_text(df, id_col, text_col)
    digest = F.md5(F.concat(F.when(F.col("doc_id").isNull(), "n").otherwise(""), F.coalesce("text", F.lit(""))).cast("binary"))
    halves = [F.conv(F.substring(digest, start, 16), 16, -10).cast("long") for start in (1, 17)]
    first = F.shiftrightunsigned(halves[0], 1)
    # of null ids 0 or more, so that they come after the largest id too
    halves = [F.when(F.col("doc_id").isNull(), first).otherwise(-1 - first).alias("th"), halves[1].alias("tl")]
    docs = given.select("doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), *halves)
    # an id that one row has is all its identity: constants take no room on the way
    several = checkpointed(given.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("several")))
    n_several, (n_bytes, n_null) = several.count(), given.agg(F.sum(F.octet_length("text")), F.count_if(F.col("doc_id").isNull())).first()
    if n_several <= FEW_IDS:
        needed = F.col("doc_id").isNull() | F.col("several").isNotNull()
        marked = given.join(F.broadcast(several), F.col("doc_id") == F.col("several"), "left")
        docs = marked.select("doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), *(F.when(needed, h).otherwise(F.lit(none)).cast("long").alias(n) for h, n, none in zip(halves, ("th", "tl"), (-1, 0), strict=True)), needed.alias("needed"))
    else:
        docs = docs.withColumn("needed", F.lit(True))
    # rows alike in id and text are one document here, and get its result in the last join
    distinct = docs.select("id", "th", "tl", "text")
    if n_several or n_null:
        alike = stored(docs.where("needed").groupBy("id", "th", "tl").agg(F.min("text").alias("text")), "distinct")
        distinct = docs.where("not needed").select("id", "th", "tl", "text").unionByName(alike)
    shards = max(16, -(-(n_bytes or 0) // SHARD))

    def anchors(batches):
        for whole in batches:
            for part in slices(whole, "text", PART):
                words = Words(part.column("text"))
                yield pa.RecordBatch.from_arrays([pa.array(_segments(words.hashes, size, words.doc)[0].view(np.int64))], names=["anchor"])

    def segments(batches):
        for whole in batches:
            for part in slices(whole, "text", PART):
                words = Words(part.column("text"))
                anchor, first, run = _segments(words.hashes, size, words.doc)
                rows = words.doc[first]
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), *(part.column(c).take(pa.array(rows)) for c in ("id", "th", "tl")), pa.array(first - words.base[rows] << 16 | run)], names=["anchor", "id", "th", "tl", "place"])

    # written first: counted anchors are asked for twice
    counted = distinct.select("text").mapInArrow(anchors, "anchor long").groupBy("anchor").agg(F.count("*").alias("n"))
    again = checkpointed(counted.where("n > 1").select("anchor", (F.col("n") > COMMON).alias("common")))
    piece = ", ".join(f"{f.name} {'binary' if f.name == 'words' else 'long'}" for f in _PIECE)
    bits = 1 << max(10, (again.count() * BITS - 1).bit_length())
    if bits <= MOST_BITS:
        # the texts stay where they are: each worker looks its segments' anchors up
        filters = df.sparkSession.sparkContext.broadcast(_filters(again, bits))
        pieces = distinct.mapInArrow(lambda batches: _pieces_of(batches, size, shards, _filtered(filters.value)), piece)
    else:
        places = distinct.mapInArrow(segments, "anchor long, id long, th long, tl long, place long")
        found = places.join(again, "anchor").groupBy("id", "th", "tl").agg(F.collect_list(F.struct("anchor", F.shiftright("place", 16).alias("start"), F.col("place").bitwiseAND(65535).alias("run"), "common")).alias("found"))
        pieces = distinct.join(found, ["id", "th", "tl"]).mapInArrow(lambda batches: _pieces_of(batches, size, shards), piece)
    ranges = pieces.groupBy("shard").applyInArrow(lambda t: _shard(t, size), "id long, th long, tl long, start long, run long")
    ranges = ranges.groupBy("id", "th", "tl").agg(F.collect_list(F.struct("start", "run")).alias("ranges"))
    return docs.join(ranges, ["id", "th", "tl"], "left").select("doc_id", "text", "ranges").mapInArrow(lambda batches: _kept(batches, size), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
