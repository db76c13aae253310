"""Token counts: exact counts at every prefix of a text, by dynamic programming.

``counts[i]`` is the number of tokens of ``text[:i]`` as the tokenizer gives
them. The last token of a prefix is the one piece that ends there, is left
whole by the merges and may follow the last token of the prefix before it
(see ``bpe``); its count is that earlier prefix's count plus one. Words repeat,
so their tables are kept in a bounded memo, and a document's table is its
words' tables shifted by running totals.

Truncation and budget questions are then look-ups: ``tokens_at`` and
``longest_within``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.bpe import LONE, Memo, Pieces, pieces
from roadlens.llm.common import id_and_text, slices

class PrefixCounts:
    def __init__(self, of: Pieces):
        self.of = of
        #: Part of a normalised text -> int32 bytes: the count at each of its prefixes, from length 1.
        self.parts = Memo(self.of_part)

    def of_part(self, s: str) -> bytes:
        ends, side, meets = self.of.ends, self.of.side, self.of.side_by_side
        counts, lasts = [0], [0]
        for end in range(1, len(s) + 1):
            start = end - 1
            piece = s[start:end]
            known = ends.get(piece)
            if known is None or known < 0:  # a character that is no piece counts its bytes
                i = LONE + ord(piece)
                left = lasts[start]
                fits = side.get(left << 21 | i) if start else True
                if meets(left, i) if fits is None else fits:
                    counts.append(counts[start] + len(piece.encode()))
                    lasts.append(i)
                    continue
            while known is not None:
                if known >= 0:
                    left = lasts[start]
                    fits = side.get(left << 21 | known) if start else True
                    if meets(left, known) if fits is None else fits:
                        counts.append(counts[start] + 1)
                        lasts.append(known)
                        break
                if not start:
                    break
                start -= 1
                piece = s[start:end]
                known = ends.get(piece)
        return np.array(counts[1:], np.int32).tobytes()

    def table(self, text: str) -> np.ndarray:
        """Counts at the prefixes 0..len(text) of a text."""
        if not text:
            return np.zeros(1, np.int32)
        known = self.parts
        parts = [known[x] for x in self.of.parts.findall(self.of.normalise(text))]
        inner = np.frombuffer(b"".join(parts), np.int32)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        totals = inner[np.cumsum(sizes) - 1]
        counts = inner + np.repeat(np.cumsum(totals) - totals, sizes)
        if self.of.prefix:  # its first entry is the added mark alone: the empty text has no token
            counts[0] = 0
            return counts
        return np.concatenate([np.zeros(1, counts.dtype), counts])


@lru_cache(maxsize=2)
def _counter(model: bytes) -> PrefixCounts:
    return PrefixCounts(pieces(model))


def token_counts(df: DataFrame, model: bytes, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", keep_prefixes: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit, cut_at, and prefix_counts if asked for.

    ``model`` is the content of a SentencePiece BPE model file. ``cut_at`` is
    the longest prefix, in code points, of at most ``limit`` tokens;
    ``prefix_counts`` is an array of len(text) + 1 counts.

    A null text counts as empty: no bytes, no tokens, a table of one zero. A
    null id stays null. Repeated rows each give a row, an empty table none.
    Other columns of the input aren't looked at. Texts of any length are read
    whole; a batch holds a few MB of text or one text.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_at long" + ", prefix_counts array<int>" * keep_prefixes

    def count(batches):
        counter = _counter(model)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                n, cuts, tables = [], [], []
                for text in texts:
                    table = counter.table(text)
                    n.append(int(table[-1]))
                    cuts.append(len(text) if n[-1] <= limit else int(np.flatnonzero(table <= limit)[-1]))
                    if keep_prefixes:
                        tables.append(pa.array(table, pa.int32()))
                columns = [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()), pa.array(cuts, pa.int64())]
                names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_at"]
                if keep_prefixes:
                    ends = np.cumsum([0, *map(len, tables)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(tables)))
                    names.append("prefix_counts")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return id_and_text(df, id_col, text_col).mapInArrow(count, schema)


def tokens_at(prefix_counts: Column, length: Column | int) -> Column:
    """Tokens of the first ``length`` code points; null beyond the text."""
    return F.get(prefix_counts, F.lit(length) if isinstance(length, int) else length)


def longest_within(prefix_counts: Column, budget: int) -> Column:
    """The longest prefix, in code points, of at most ``budget`` tokens."""
    return F.array_max(F.transform(prefix_counts, lambda n, i: F.when(n <= budget, i).otherwise(0)))
