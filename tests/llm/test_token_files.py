import functools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from roadlens.llm import token_files
from roadlens.llm.queries import WORD_TOKENIZER, tokenizer
from roadlens.session import scratch_path

TEXTS = [
    "Plain words, and NUMBERS 123.", "", None, " \t\n ", "a b c ́combining é Å", "it's I'll WE'D  '' 's", "<|endoftext|> x<|startoftext|>y <|endoftext|", "quote \" ! id one",
    "straße ΟΔΟΣ İstanbul ﬁ", "中文 日本語 한국어 \U0001f600\U0001f468‍\U0001f469", "x" * 5000, "tab\x0bfeed\x0cend\x1cfile\x85next", "wörd " * 3000,
]


@functools.cache
def _tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def _library(text, name=WORD_TOKENIZER):
    return _tokenizer(name).encode(text or "", add_special_tokens=False).ids


def _want(rows, end_id=1, name=WORD_TOKENIZER):
    out, start = [], 0
    for i, text in rows:
        ids = np.array([*_library(text, name), end_id], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def _written(spark, df, **more):
    folder = scratch_path(spark, "token-files")
    manifest = token_files.write(df, more.pop("vocabulary", None) or tokenizer(name=WORD_TOKENIZER), folder, end_id=1, **more)
    return folder, manifest, token_files.read_documents(spark, manifest, folder)


@pytest.mark.parametrize("by_words, name", [(True, WORD_TOKENIZER), (False, WORD_TOKENIZER), (False, "byte_bpe_50k.json")])
def test_documents_read_back_are_the_librarys(spark, frame, by_words, name):
    rows = list(enumerate(TEXTS))
    *_, back = _written(spark, frame(rows), by_words=by_words, length=16, batch_rows=4, vocabulary=tokenizer(name=name))
    assert sorted(tuple(r)[:4] for r in back.collect()) == _want(rows, name=name)


def test_encoder_remembers_words_and_forgets_when_full(monkeypatch):
    monkeypatch.setattr(token_files, "WORDS", 3)
    encoder = token_files.Encoder(tokenizer(name=WORD_TOKENIZER), by_words=True)
    texts = [(t or "").encode() for t in TEXTS] * 2
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts)] == [_library(t) for t in TEXTS * 2]


def test_sequences_are_views_and_hold_the_stream(spark, frame, many_partitions):
    rows = [(i, f"document {i} " + "word " * (i % 40)) for i in range(300)]
    folder, manifest, _ = _written(spark, frame(rows), by_words=True, length=32, batch_rows=8)
    files = [(r.part, r.sequences) for r in manifest.orderBy("part").collect()]
    assert len(files) > 1 and sum(r.tokens for r in manifest.collect()) == sum(len(_library(t)) + 1 for _, t in rows)
    sequences = token_files.Sequences(folder, files)
    stream, ends = [], 0
    for i in range(len(sequences)):
        ids, mask, end = sequences[i]
        assert len(ids) == len(mask) == len(end) == 32 and not ids.flags.owndata and not ids.flags.writeable
        stream += ids[mask].tolist()
        ends += int(end.sum())
    assert stream == [t for _, text in rows for t in [*_library(text), 1]] and ends == 300
    last = sequences[len(sequences) - 1]  # without reading the others
    assert last[1].any()
    before = pa.total_allocated_bytes()
    held = [sequences[i][0] for i in range(len(sequences))]
    assert pa.total_allocated_bytes() == before and len(held) == len(sequences)
    with pytest.raises(IndexError):
        sequences[len(sequences)]


def test_null_ids_last_and_repeated_rows_split(spark, frame, many_partitions):
    rows = [(7, "the same row")] * 400 + [(None, "no id"), (None, None), (3, "a"), (3, "b"), (9, "later")]
    _, manifest, back = _written(spark, frame(rows).repartition(4), by_words=True, length=8, batch_rows=2)
    got = sorted(map(tuple, back.collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [3, 3] + [7] * 400 + [9, None, None]
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:], strict=False)) and got[0][1] == 0
    assert max(r.documents for r in manifest.collect()) < 250
    want = {(i, crc) for i, _, _, crc in _want(rows)}
    assert {(r[0], r[3]) for r in got} == want


def test_empty_table(spark, frame):
    folder, manifest, back = _written(spark, frame(TEXTS and [(1, "x")]).limit(0), by_words=True)
    assert manifest.count() == 0 and back.count() == 0 and len(token_files.Sequences(folder, [])) == 0


def test_a_file_that_lost_a_document_is_an_error(spark, frame):
    folder, manifest, _ = _written(spark, frame([(1, "a b"), (2, "c")]).coalesce(1), by_words=True, length=8)
    part = manifest.first().part
    where, path = token_files.filesystem(folder)
    name = token_files.file_name(path, "documents", part)
    with where.open_output_stream(name) as sink, pa.ipc.new_file(sink, pa.schema([("doc_id", pa.int64())])) as out:
        out.write_batch(pa.record_batch([pa.array([1], pa.int64())], names=["doc_id"]))
    with pytest.raises((ValueError, RuntimeError, StopIteration)):
        list(token_files._documents_of(where, path, part))
