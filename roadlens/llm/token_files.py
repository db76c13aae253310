"""Token ids in Arrow files: equal-length sequences and masks, read at random without copying.

Documents are dealt by ranges of their ids, sorted, encoded where they lie and
packed, one file a partition, in ascending order from file to file. A file is in
Arrow's random-access stream format; its record batches hold ``batch_rows``
sequences each, the last one fewer, in three fixed-size-list columns:

* ``ids``: ``length`` token ids, 2 bytes each where the vocabulary allows it, else 4;
* ``mask``: whether a place holds a token; only the end of a file's last sequence doesn't;
* ``ends``: whether a place holds the last token of its document.

Buffers aren't compressed, so a memory-mapped file gives a sequence as a view of
its bytes: sequence i of a file is row i % batch_rows of batch i // batch_rows.
A second file beside it, ``documents``, has the ids of its documents in their
order. The manifest, a Parquet table, has one row a file.

Files go to the folder given, which driver and executors share, by Arrow's own
filesystems. Each is written under a name of its own and then renamed, so a task
that is run again, after an executor is lost, leaves the same file.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import checkpointed, id_and_text, slices

#: Words of more bytes are encoded each time; from so many words on, a worker forgets all and starts anew.
LONG_WORD = 64
WORDS = 3 << 18

MANIFEST = "part int, documents long, tokens long, sequences long, length int, batch_rows int"


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """Arrow's filesystem for a folder, and the folder's path in it."""
    if local := re.match("file:/+", folder):
        return fs.LocalFileSystem(), f"/{folder[local.end():]}"
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def file_name(folder: str, kind: str, part: int) -> str:
    return f"{folder}/{kind}-{part:07d}.arrow"


class Encoder:
    """Texts to ids by the tokenizers library, without added special tokens, truncation or padding.

    ``by_words``: the vocabulary drops white space, so that no token reaches
    over it and a text's ids are those of its words one after the other. New
    words then go through the library's normaliser and pre-tokenizer together,
    and their pieces through its model; what words and pieces give is remembered.
    A word that holds an added token's string goes through the whole library.
    """

    def __init__(self, vocabulary: bytes, by_words: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.by_words = by_words
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_pieces(self, words: list[str]) -> list[bytes]:
        """The ids of words without added tokens."""
        normalised = self.tokenizer.normalizer.normalize_str(" ".join(words)) if self.tokenizer.normalizer else " ".join(words)
        ends = [len(w) for w in normalised.split(" ")]
        if len(ends) != len(words):  # some word holds white space of another kind
            return self._library(words)
        out, now, k, end = [], [], 0, ends[0]
        pieces, tokenize, size = self.pieces, self.tokenizer.model.tokenize, self.dtype.itemsize
        for piece, (_, stop) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normalised):
            while stop > end:
                out.append(b"".join(now))
                now, k = [], k + 1
                end += 1 + ends[k]
            ids = pieces.get(piece)
            if ids is None:
                ids = b"".join([t.id.to_bytes(size, "little") for t in tokenize(piece)])
                if len(piece) <= LONG_WORD:
                    pieces[piece] = ids
            now.append(ids)
        out.append(b"".join(now))
        return out + [b""] * (len(words) - len(out))

    def _learn(self, words: list[bytes]) -> None:
        plain, special = [], []
        for word in words:
            (special if self.added.search(text := word.decode()) else plain).append(text)
        for some, encode in ((special, self._library), (plain, self._by_pieces)):
            for at in range(0, len(some), 1024):
                part = some[at : at + 1024]
                self.known.update(zip([w.encode() for w in part], encode(part), strict=True))

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each UTF-8 text as bytes."""
        if not self.by_words:
            yield from self._library([t.decode() for t in texts])
            return
        for memory in (self.known, self.pieces):
            if len(memory) > WORDS:
                memory.clear()
        split = [text.split() for text in texts]  # at the six ASCII white-space characters
        self._learn(list(set().union(*split).difference(self.known)))
        known = self.known
        for words in split:
            yield b"".join([known[w] for w in words])
        for w in {w for words in split for w in words if len(w) > LONG_WORD}:
            del known[w]


_encoders: dict[tuple[int, bool], Encoder] = {}


def encoder_of(vocabulary: bytes, by_words: bool) -> Encoder:
    """One encoder a worker process and vocabulary: what it remembers serves the tasks to come."""
    key = (hash(vocabulary), by_words)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary, by_words)
    return _encoders[key]


class _Writer:
    """Packs the documents of one partition into its two files."""

    def __init__(self, folder: str, part: int, length: int, batch_rows: int, dtype: np.dtype):
        self.fs, self.folder = filesystem(folder)
        self.part, self.length, self.whole = part, length, length * batch_rows
        rows = {"ids": pa.uint16() if dtype.itemsize == 2 else pa.uint32(), "mask": pa.bool_(), "ends": pa.bool_()}
        self.schema = pa.schema([pa.field(name, pa.list_(t, length), False) for name, t in rows.items()], {"length": str(length), "batch_rows": str(batch_rows)})
        self.index = pa.schema([("doc_id", pa.int64())])
        self.dtype = dtype
        self.open: list = []
        self.names: list[tuple[str, str]] = []
        self.ids: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.pending = self.tokens = self.documents = self.sequences = 0
        self.doc_ids: list[int | None] = []

    def _new(self, kind: str, schema: pa.Schema):
        name = file_name(self.folder, kind, self.part)
        self.names.append((f"{name}.{uuid.uuid4().hex}", name))
        sink = self.fs.open_output_stream(self.names[-1][0])
        self.open.append((pa.ipc.new_file(sink, schema), sink))
        return self.open[-1][0]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if not self.open:
            self.fs.create_dir(self.folder, recursive=True)
            self.out, self.docs = self._new("tokens", self.schema), self._new("documents", self.index)
        ends = np.zeros(len(ids), bool)
        ends[-1:] = True
        self.ids.append(ids)
        self.ends.append(ends)
        self.doc_ids.append(doc_id)
        self.pending += len(ids)
        self.tokens += len(ids)
        self.documents += 1
        if self.pending >= self.whole:
            self._flush(self.pending // self.whole * self.whole)
        if len(self.doc_ids) >= 1 << 16:
            self._list()

    def _list(self) -> None:
        if self.doc_ids:
            self.docs.write_batch(pa.record_batch([pa.array(self.doc_ids, pa.int64())], schema=self.index))
        self.doc_ids = []

    def _flush(self, n: int) -> None:
        ids, ends = np.concatenate(self.ids), np.concatenate(self.ends)
        self.ids, self.ends, self.pending = [ids[n:]], [ends[n:]], len(ids) - n
        for at in range(0, n, self.whole):
            self._write(ids[at : at + self.whole], ends[at : at + self.whole], min(self.whole, n - at))

    def _write(self, ids: np.ndarray, ends: np.ndarray, n: int) -> None:
        pad = -n % self.length
        columns = [np.append(ids, np.zeros(pad, self.dtype)), np.append(np.ones(n, bool), np.zeros(pad, bool)), np.append(ends, np.zeros(pad, bool))]
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(c), type=f.type) for c, f in zip(columns, self.schema, strict=True)]
        self.out.write_batch(pa.record_batch(lists, schema=self.schema))
        self.sequences += (n + pad) // self.length

    def close(self) -> None:
        if not self.open:
            return
        if self.pending:
            self._flush(self.pending)
        self._list()
        for writer, sink in self.open:
            writer.close()
            sink.close()
        for made, name in self.names:
            self.fs.move(made, name)


def write(df: DataFrame, vocabulary: bytes, folder: str, end_id: int, length: int = 2048, batch_rows: int = 64, by_words: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files of df's texts to ``folder``; returns the manifest, one row a file, in the files' order.

    Documents come by ascending id, null ids last, rows of one id by a hash of
    their texts; which of two rows alike in both comes first is open. A range
    may split rows of one id and also repeated rows, so that no partition holds
    more for them; for that, their place in the scan counts, so give a stored table.
    Each document ends with ``end_id``: a null or empty text gives that id alone.
    An empty table gives an empty manifest and no files; other columns aren't looked at.
    Texts are encoded whole, and a long one goes on through as many sequences as it takes.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("by"), F.col("place")]
    rows = id_and_text(df, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("by"), F.monotonically_increasing_id().alias("place"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary, by_words)
        end = np.array([end_id], encoder.dtype).tobytes()
        out = _Writer(folder, TaskContext.get().partitionId(), length, batch_rows, encoder.dtype)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or b"" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                    out.add(doc_id, np.frombuffer(ids + end, encoder.dtype))
        out.close()
        if out.documents:
            row = [out.part, out.documents, out.tokens, out.sequences, length, batch_rows]
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.record_batch([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=[f.split()[0] for f in MANIFEST.split(", ")])

    return checkpointed(ordered.mapInArrow(pack, MANIFEST))


def save_manifest(manifest: DataFrame, folder: str) -> None:
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")


def _opened(where: fs.FileSystem, name: str) -> pa.ipc.RecordBatchFileReader:
    """A file, mapped where it is local, else read at the places asked for."""
    return pa.ipc.open_file(pa.memory_map(name) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(name))


def _flat(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(name).flatten()


class Sequences:
    """Random access to the sequences of a folder, by their number over all files.

    ``files``: (part, sequences) of each file, in order, as the manifest has
    them. An item is (ids, mask, ends): ids a view of the file's bytes where
    that is local, the masks unpacked from their bits.
    """

    def __init__(self, folder: str, files: list[tuple[int, int]]):
        self.fs, self.folder = filesystem(folder)
        self.parts = [part for part, _ in files]
        self.first = [0]
        for _, n in files:
            self.first.append(self.first[-1] + n)
        self.readers: dict[int, tuple] = {}

    def __len__(self) -> int:
        return self.first[-1]

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        k = bisect_right(self.first, i) - 1
        if k not in self.readers:
            reader = _opened(self.fs, file_name(self.folder, "tokens", self.parts[k]))
            self.readers[k] = (reader, int(reader.schema.metadata[b"batch_rows"]))
        reader, rows = self.readers[k]
        at = i - self.first[k]
        row = reader.get_batch(at // rows).slice(at % rows, 1)
        return tuple(_flat(row, name).to_numpy(zero_copy_only=name == "ids") for name in ("ids", "mask", "ends"))


def _documents_of(where: fs.FileSystem, folder: str, part: int) -> Iterator[tuple[int | None, int, int, int]]:
    """(doc_id, start in the file, n_tokens, crc32 of the ids as little-endian 32-bit integers) of a file's documents, in order."""
    reader, index = _opened(where, file_name(folder, "tokens", part)), _opened(where, file_name(folder, "documents", part))
    doc_ids = (i for k in range(index.num_record_batches) for i in index.get_batch(k).column("doc_id").to_pylist())
    start = n = crc = 0
    for k in range(reader.num_record_batches):
        batch = reader.get_batch(k)
        ids = _flat(batch, "ids").to_numpy(zero_copy_only=True).astype("<u4")
        used = int(_flat(batch, "mask").true_count)
        ends = np.flatnonzero(_flat(batch, "ends").to_numpy(zero_copy_only=False)) + 1
        at = 0
        for stop in [*ends.tolist(), used]:
            crc, n, at = zlib.crc32(ids[at:stop], crc), n + stop - at, stop
            if stop == used and (not len(ends) or stop != ends[-1]) or not n:
                break  # the document goes on in the next batch, or there is none
            yield next(doc_ids), start, n, crc
            start, n, crc = start + n, 0, 0
    if n or next(doc_ids, "none") != "none":
        raise ValueError(f"file {part}: its documents are not those of its index")


def read_documents(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, part.

    One task a file or a few. The running sum of the files' tokens, one number
    a file, is the only thing that comes together. An empty manifest gives no rows.
    """
    before = [(r.part, r.tokens) for r in manifest.select("part", "tokens").orderBy("part").collect()]
    starts, total = {}, 0
    for part, n in before:
        starts[part], total = total, total + n
    tasks = max(1, min(len(before), 16 * spark.sparkContext.defaultParallelism))
    names = ("doc_id", "start", "n_tokens", "ids_crc32", "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = filesystem(folder)
        for batch in batches:
            for part in batch.column("part").to_pylist():
                rows: list[tuple] = []
                for doc_id, start, n, crc in _documents_of(where, path, part):
                    rows.append((doc_id, starts[part] + start, n, crc, part))
                    if len(rows) == 1 << 16:
                        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    return manifest.select("part").repartition(tasks, "part").mapInArrow(read, ", ".join(f"{n} long" for n in names))
