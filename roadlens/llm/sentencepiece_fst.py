"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Three machines over the tropical semiring (min, +), see ``fst``:

* the normaliser: writes a leading mark, maps a space to the mark and copies
  every other character;
* the pieces: reads the characters of a piece and writes its id; a character
  that is no piece is written as it is, and stands for the ids of its bytes;
* the language model over what the pieces write. A unigram model has one state,
  and an arc weighs a piece's score, negated. A BPE model's scores order merges
  and are no costs to add up: there the states are pieces, and the arc from one
  piece to the next weighs 0 if merging leaves the two side by side, infinity if
  not, so that one path of finite weight remains, the library's (see ``bpe``).

The first two are composed once per worker process and model; the result is
composed lazily with each input and with the language model, and its shortest
path is the encoding. Words repeat and no piece reaches from a word to the space
after it, so the path of a text is that of its parts, and those of late are kept
in a bounded memo.

Decoding is the inverse: ids write their spellings, the leading space goes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadlens.llm.bpe import BYTE, CONTROL, LONE, NORMAL, PAIRS, SPACE_MARK, UNKNOWN, Memo, Pieces, pieces
from roadlens.llm.common import id_and_text, slices
from roadlens.llm.fst import BEGIN, Search, compose, normaliser, spelling_machine

#: The library's distance of a character without a piece below the lowest score.
UNKNOWN_PENALTY = 10.0


class Merges:
    """Language model of a BPE model: may two pieces stand side by side?"""

    remembers = True

    def __init__(self, of: Pieces):
        self.of = of
        self.known: dict[int, float] = {}

    def weight(self, left: int, symbol: int) -> float:
        if len(self.known) > PAIRS:
            self.known.clear()
        fits = left == BEGIN or self.of.side_by_side(left, symbol)
        made = self.known[left << 21 | symbol] = 0.0 if fits else math.inf
        return made


class Scores:
    """Language model of a unigram model: the sum of the scores, negated."""

    remembers = False

    def __init__(self, scores: dict[int, float]):
        self.known = {BEGIN << 21 | i: -x for i, x in scores.items()}
        self.unknown = UNKNOWN_PENALTY - min(scores.values(), default=0.0)

    def weight(self, left: int, symbol: int) -> float:
        return self.known.get(left << 21 | symbol, self.unknown)


class Unigram:
    """Pieces of a unigram model with byte fallback and the identity normaliser; those of a BPE model are in ``bpe``."""

    def __init__(self, m):
        norm, train = m.normalizer_spec, m.trainer_spec
        if not train.byte_fallback or any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in m.pieces):
            raise ValueError("only models with byte fallback and without user-defined pieces are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or train.treat_whitespace_as_suffix:
            raise ValueError("only the identity normaliser that keeps and escapes spaces is supported")
        self.prefix = SPACE_MARK if norm.add_dummy_prefix else ""
        self.id = {p.piece: i for i, p in enumerate(m.pieces) if p.type == NORMAL}
        self.scores = {i: p.score for i, p in enumerate(m.pieces) if p.type == NORMAL}
        self.byte_id = [0] * 256
        self.spelling = [b""] * len(m.pieces)
        for i, p in enumerate(m.pieces):
            if p.type == BYTE:
                self.byte_id[int(p.piece[3:5], 16)] = i
                self.spelling[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == NORMAL:
                self.spelling[i] = p.piece.replace(SPACE_MARK, " ").encode()

    def ids_of(self, i: int) -> list[int]:
        return [self.byte_id[b] for b in chr(i - LONE).encode()] if i >= LONE else [i]


def independent_parts(spelled: Iterable[str]) -> re.Pattern:
    """Cuts a text into parts that no piece reaches out of: words, with the spaces before them.

    A word is of letters or of other characters. Letters that some piece joins to
    others count as others, and so do letters joined to those. The mark counts as a space. If a piece reaches from a
    word to the space after it, the text is one part.
    """
    pairs = {p[k : k + 2] for p in spelled for k in range(len(p) - 1)}
    if any(b == SPACE_MARK != a for a, b in pairs):
        return re.compile(".+", re.S)
    pairs = {x for x in pairs if SPACE_MARK not in x}
    letters = {c for x in pairs for c in x if re.match(r"[^\W\d_]", c)}
    joined: set[str] = set()
    while more := {c for x in pairs for c in x if c in letters and not letters.issuperset(x)}:
        joined |= more
        letters -= more
    space, joined = f" {SPACE_MARK}", re.escape("".join(sorted(joined)))
    return re.compile(rf"[{space}]*(?:[^\W\d_{joined}]+|(?:[\d_{joined}]|[^\w{space}])+)|[{space}]+", re.S)


class Encoder:
    def __init__(self, of: Pieces | Unigram):
        self.of = of
        if isinstance(of, Unigram):
            spelled, language = of.id.items(), Scores(of.scores)
        else:  # pieces that merging takes apart are on no path
            spelled, language = ((p, i) for p, i in of.id.items() if of.ends[p] >= 0), Merges(of)
        self.search = Search(compose(normaliser(bool(of.prefix)), spelling_machine(spelled)), language)
        self.split = independent_parts(of.id)
        #: A part after the first -> int32 bytes of its ids.
        self.parts = Memo(self.ids)

    def ids(self, part: str, whole: bool = False) -> bytes:
        path = self.search.path(part, whole)
        if path and max(path) >= LONE:
            path = [i for x in path for i in self.of.ids_of(x)]
        return np.array(path, np.int32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        parts = self.split.findall(text)
        if not parts:
            return np.zeros(0, np.int32)
        known = self.parts
        return np.frombuffer(b"".join([self.ids(parts[0], whole=True), *[known[x] for x in parts[1:]]]), np.int32)

    def decode(self, ids: list[int]) -> str:
        spelling = self.of.spelling
        if ids and not (min(ids) >= 0 and max(ids) < len(spelling)):
            ids = [i for i in ids if 0 <= i < len(spelling)]
        made = b"".join(map(spelling.__getitem__, ids)).decode("utf-8", "replace")
        return made[1:] if self.of.prefix and made.startswith(" ") else made


@lru_cache(maxsize=2)
def _encoder(model: bytes) -> Encoder:
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    m.ParseFromString(model)
    return Encoder(Unigram(m) if m.trainer_spec.model_type == 1 else pieces(model))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays])))


def encode(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", check: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens and token_ids, and round_trip (does decoding give the text?) if asked for.

    A null or empty text has no ids. A null id stays null, repeated rows each
    give a row, an empty table none; other columns aren't looked at. Texts of
    any length are read whole. round_trip is false where a text holds the mark
    that stands for a space, which no SentencePiece model can tell from one.
    """
    schema = "doc_id long, n_tokens long, token_ids array<int>" + ", round_trip boolean" * check

    def run(batches):
        encoder = _encoder(model)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids = [encoder.encode(t) for t in texts]
                columns = [batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), _lists(ids)]
                if check:
                    columns.append(pa.array([encoder.decode(x.tolist()) == t for x, t in zip(ids, texts, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "token_ids", "round_trip"][: len(columns)])

    return id_and_text(df, id_col, text_col).mapInArrow(run, schema)


def with_tokens(df: DataFrame, model: bytes, text_col: str = "text", out: str = "token_ids") -> DataFrame:
    """All columns of df and the ids of one of them. A column that is named like ``out`` is replaced."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    df = df.drop(out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches):
        encoder = _encoder(model)
        for whole in batches:
            for batch in slices(whole, text_col):
                ids = _lists([encoder.encode(t or "") for t in batch.column(text_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, out])

    return df.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def decode(df: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Per row: doc_id and text. Null or no ids give an empty text; unknown ids write nothing."""
    from pyspark.sql import functions as F

    def run(batches):
        encoder = _encoder(model)
        for batch in batches:
            texts = [encoder.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    picked = df.select(F.col(id_col).cast("long").alias("doc_id"), F.expr(f"filter(`{ids_col}`, x -> x is not null)").alias("ids"))
    return picked.mapInArrow(run, "doc_id long, text string")
