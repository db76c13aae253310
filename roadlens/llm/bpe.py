"""The pieces of a SentencePiece BPE model, and which of them may stand side by side.

Merging pairs by score gives each string one canonical split. A sequence of
pieces is canonical exactly if each piece is left whole by the merges and each
pair of neighbours, merged alone, comes out as that pair. So the split of a
string follows from the splits of its prefixes, without merging it again: the
token counts and the encoder here both build on that.
"""

from __future__ import annotations

import re
from functools import lru_cache

SPACE_MARK = "▁"
#: Above every id; ids and code points stay below 2 ** 21 together.
LONE = 1 << 19
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

#: Entries that a worker process keeps of words' results: two generations of this many.
MEMO = 350_000
#: Entries that it keeps of pairs of pieces before it starts afresh.
PAIRS = 400_000
#: Parts longer than this aren't kept: they hardly repeat.
SHORT = 48


class Memo(dict):
    """part -> make(part), with the parts of late; those not asked for in two generations go."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.older: dict = {}

    def __missing__(self, part: str):
        made = self.older.get(part)
        if made is None:
            made = self.make(part)
        if len(part) <= SHORT:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[part] = made
        return made


class Pieces:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        m.ParseFromString(model)
        norm, train = m.normalizer_spec, m.trainer_spec
        if train.model_type != 2 or not train.byte_fallback or any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in m.pieces):
            raise ValueError("only BPE models with byte fallback and without user-defined pieces are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or train.treat_whitespace_as_suffix:
            raise ValueError("only the identity normaliser that keeps and escapes spaces is supported")
        self.prefix = SPACE_MARK if norm.add_dummy_prefix else ""
        self.score = {p.piece: p.score for p in m.pieces if p.type == NORMAL}
        self.id = {p.piece: i for i, p in enumerate(m.pieces) if p.type == NORMAL}
        self.byte_id = [0] * 256
        self.spelling = [b""] * len(m.pieces)
        for i, p in enumerate(m.pieces):
            if p.type == BYTE:
                self.byte_id[int(p.piece[3:5], 16)] = i
                self.spelling[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == NORMAL:
                self.spelling[i] = p.piece.replace(SPACE_MARK, " ").encode()
        crossing = any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in self.score)
        #: No merge reaches from a word to the space after it, so such parts are independent.
        self.parts = re.compile(".+" if crossing else f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+", re.S)
        #: Every end of a piece: for the pieces that the merges leave whole their id, -1 for the others.
        self.ends: dict[str, int] = {p[k:]: -1 for p in self.score for k in range(len(p))}
        self.ends.update((p, self.id[p]) for p in self.score if self.merge(p) == [p])
        #: (id << 21 | id) -> whether merging leaves the two as they are; a character without an id has LONE + its code.
        self.side: dict[int, bool] = {}
        self._piece = {i: p for p, i in self.id.items()}

    def normalise(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE_MARK) if text else ""

    def merge(self, s: str) -> list[str]:
        """The canonical split of a short string: best score first, then leftmost."""
        parts = list(s)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                v = self.score.get(parts[i] + parts[i + 1])
                if v is not None and (best is None or v > best):
                    best, at = v, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def spelled(self, i: int) -> str:
        return chr(i - LONE) if i >= LONE else self._piece[i]

    def side_by_side(self, left: int, right: int) -> bool:
        """Callers look in ``side`` first."""
        if len(self.side) > PAIRS:
            self.side.clear()
        a, b = self.spelled(left), self.spelled(right)
        known = self.side[left << 21 | right] = self.merge(a + b) == [a, b]
        return known

    def ids_of(self, i: int) -> list[int]:
        """A piece's id, or the ids of its bytes where the model lacks it."""
        return [self.byte_id[b] for b in chr(i - LONE).encode()] if i >= LONE else [i]


@lru_cache(maxsize=2)
def pieces(model: bytes) -> Pieces:
    """One per worker process and model."""
    return Pieces(model)
