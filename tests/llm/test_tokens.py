import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")

from pyspark.sql import functions as F  # noqa: E402

from roadlens.llm import fst, sentencepiece_fst, token_counts  # noqa: E402
from roadlens.llm.bpe import LONE, Pieces  # noqa: E402
from roadlens.llm.queries import tokenizer  # noqa: E402

TEXTS = [None, "", " ", "   a  b ", "the thing.\nThe end", "<s> </s> ▁x ▁▁", "😀 é你\x00", "x" * 3000, "a " * 2000, "The the." * 200]


@pytest.fixture(scope="module")
def model():
    return tokenizer()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def _random(n):
    rng = random.Random(7)
    return ["".join(rng.choice(" ▁aeths\n.,é你😀01<>-") for _ in range(rng.randint(0, 30))) for _ in range(n)] + [c * k for c in " a=\n" for k in (1, 2, 5, 17, 40)]


def test_every_prefix_count_is_the_librarys(model, library):
    counter = token_counts.PrefixCounts(Pieces(model))
    for text in _random(150):
        table = counter.table(text)
        assert table.tolist() == [len(library.encode(text[:i])) for i in range(len(text) + 1)], text


def test_encoder_is_the_librarys(model, library):
    encoder = sentencepiece_fst.Encoder(Pieces(model))
    for text in _random(600):
        ids = encoder.encode(text).tolist()
        assert ids == library.encode(text)
        assert encoder.decode(ids) == library.decode(ids)


def _unigram(pieces, prefix=True):
    """A unigram model with byte fallback, of given pieces and scores."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), *[(f"<0x{i:02X}>", 0, 6) for i in range(256)], *[(p, x, 1) for p, x in pieces]]:
        m.pieces.add(piece=piece, score=score, type=kind)
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback, m.trainer_spec.vocab_size = 1, True, len(m.pieces)
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = "identity", prefix, False, True
    return m.SerializeToString()


WORDS = [("▁", -2.0), ("a", -3.0), ("b", -3.25), ("ab", -4.5), ("▁a", -4.0), ("▁ab", -7.5), ("ba", -5.0), ("aba", -8.0), ("b.", -4.0), ("▁▁", -3.5), ("é", -6.0), ("aéb", -6.5)]


@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("more", [[], [("b▁a", -4.0)]])  # a piece over the space: the text is one part
def test_a_unigram_model_goes_by_its_scores(prefix, more):
    model = _unigram(WORDS + more, prefix)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    encoder = sentencepiece_fst._encoder(model)
    rng = random.Random(3)
    texts = ["", " ", "c", "ab", "abab. ba", "aéb 你"] + ["".join(rng.choice("aaabbb .é ▁c你\n") for _ in range(rng.randint(1, 25))) for _ in range(1500)]
    for text in texts:
        assert encoder.encode(text).tolist() == library.encode(text), text
        assert encoder.decode(encoder.encode(text).tolist()) == library.decode(library.encode(text)), text


def test_shortest_path_is_the_least_of_all_paths():
    """Against every way to spell a text, each weighed whole."""
    scores = dict(enumerate([-1.0, -1.5, -2.25, -0.75, -3.0], 10))
    spelled = dict(zip(["a", "b", "ab", "ba", "▁ab"], scores, strict=True))
    search = fst.Search(fst.compose(fst.normaliser(True), fst.spelling_machine(spelled.items())), sentencepiece_fst.Scores(scores))

    def ways(s):
        if not s:
            yield 0.0, []
        for p, i in [*spelled.items(), *[(s[:1], LONE + ord(s[0]))] * (s[:1] not in spelled)] if s else ():
            if s.startswith(p):
                yield from ((w - scores.get(i, -13.0), [i, *path]) for w, path in ways(s[len(p) :]))

    rng = random.Random(5)
    for text in ["".join(rng.choice("aab bc") for _ in range(n)) for n in range(1, 9) for _ in range(12)]:
        found = search.path(text)
        best = min(w for w, _ in ways("▁" + text.replace(" ", "▁")))
        assert -sum(scores.get(i, -13.0) for i in found) == best


def test_composition_maps_spaces_and_keeps_other_characters():
    machine = fst.compose(fst.normaliser(False), fst.spelling_machine([("▁", 7), ("a▁", 8), ("a", 9)]))
    path = fst.Search(machine, sentencepiece_fst.Scores({7: -1.0, 8: -1.0, 9: -1.0})).path
    assert path("a a▁x ") == [8, 8, LONE + ord("x"), 7]


def test_parts_are_cut_where_no_piece_reaches(model):
    cut = sentencepiece_fst.independent_parts(Pieces(model).id).findall
    assert cut("  the ab.c,\nd 12x ▁▁") == ["  the", " ab", ".", "c", ",\n", "d", " 12", "x", " ▁▁"]
    assert cut("x².") == ["x", "²."]  # a piece joins the last two
    for text in _random(300):
        assert "".join(cut(text)) == text


def test_counts_over_rows(frame, model, library):
    rows = [*enumerate(TEXTS), (None, "no id"), (3, TEXTS[3])]
    df = frame(rows)
    got = token_counts.token_counts(df, model, limit=50, keep_prefixes=True)
    got = got.withColumn("five", token_counts.tokens_at(F.col("prefix_counts"), 5)).withColumn("cut", token_counts.longest_within(F.col("prefix_counts"), 50)).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in got) == sorted((-1 if i is None else i, len(library.encode(t or ""))) for i, t in rows)
    texts = dict(rows)
    for r in got:
        text = texts[r.doc_id] or ""
        assert r.n_bytes == len(text.encode()) and r.over_limit == (r.n_tokens > 50)
        assert r.cut == r.cut_at == max(i for i, n in enumerate(r.prefix_counts) if n <= 50)
        assert r.five == (len(library.encode(text[:5])) if len(text) >= 5 else None)
    assert token_counts.token_counts(df.limit(0), model).count() == 0


def test_round_trip_over_rows(frame, model):
    df = frame([*enumerate(TEXTS), (None, "no id"), (3, TEXTS[3])])
    coded = sentencepiece_fst.encode(df, model, check=True)
    assert {r.doc_id for r in coded.where("not round_trip").collect()} == {5}  # it holds the mark itself
    back = {r.doc_id: r.text for r in sentencepiece_fst.decode(coded, model).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(TEXTS) if i != 5) and back[None] == "no id"
    wide = sentencepiece_fst.with_tokens(df, model)
    assert wide.columns == [*df.columns, "token_ids"] and wide.where("text is null").first().token_ids == []
    assert sentencepiece_fst.encode(df.limit(0), model).count() == 0
