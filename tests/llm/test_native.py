import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roadlens.llm import line_rules, mixing, pii

WORD = r"[^\x20\x09-\x0D]+"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def _base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255 or kind == "card" and not (12 <= len(digits) <= 19 and _luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def _plain(plan):
    return not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().toString())


def test_base_spans_are_those_of_the_patterns(frame):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice(["a", "@", ".", "1", "25", "+", "-", " ", "(", ")", "4111 1111 1111 1111", "b.c", "é😀", "\n", "+1 (234) 555-7713", "1.2.3.4"]) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "9" * 20_000 + " " + "a" * 50_000 + "@" + "b." * 9_000 + "c " + "1 " * 9_000 + "+1" + "(" * 9_000), (903, "x1.2.3.4 " * 700), (None, "a@b.co"), (5, rows[5][1])]
    df = frame(rows)
    found = pii.find_spans(df, pii.Model([], 0.0, [float("inf")] * 4))
    assert _plain(found)
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        assert [tuple(s) for s in r.base] == [tuple(s) for s in r.spans] == _base(r.text)
    counts = {r.doc_id: r for r in pii.summary(found).where("doc_id in (901, 903)").collect()}
    assert counts[901].spans == "" and counts[903].n_ip == 700 and counts[903].spans.startswith("ip:1:8,ip:10:17")
    assert pii.find_spans(df.limit(0)).count() == 0


def test_trees_add_looser_spans_and_redaction_covers_all(frame):
    rows = [(i, f"mail me at user{i}@mail.example.com or call +1 (234) 555-{1000 + i}; card 4111 1111 1111 1111, host 10.0.0.{i % 256}") for i in range(400)]
    rows += [(1000, "mail: jo (at) mail (dot) example (dot) com, host 10[.]0[.]0[.]7"), (1001, "no data"), (1002, None), (1003, "+1 234 555 4111 1111 1111 1111x")]
    df = frame(rows)
    model = pii.train(pii.candidates(df))
    assert any(t < float("inf") for t in model.thresholds)
    spans = {r.doc_id: r for r in pii.find_spans(df, model).collect()}
    assert len(spans[1000].spans) > len(spans[1000].base) == 0
    texts = {r.doc_id: r.text for r in pii.redact(df, model).collect()}
    assert texts[3] == "mail me at [EMAIL] or call [PHONE]; card [CARD], host [IP]"
    assert texts[1000].startswith("mail: [EMAIL], host") and texts[1001] == "no data" and texts[1002] is None
    assert not re.search("[0-9]", re.sub(r"\[\w+\]", "", texts[7]))
    assert pii.redact(df, model).columns == df.columns


def _rules(text):
    text = text or ""
    words = re.findall(WORD, text)
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + k for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), len(words) < 50 or 100 * len(repeated) > 50 * len(words))


def test_rules_count_as_brute_force(frame):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(["a ", "b ", "c. ", "é😀 ", "\n", "\t", "#", "| ", "dd ", "\x0b"]) for _ in range(rng.randint(0, 120)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "x " * 30_000), (903, "\n" * 5_000), (None, "a b c"), (7, rows[7][1])]
    got = line_rules.apply_rules(frame(rows))
    assert _plain(got)
    texts = dict(rows)
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == _rules(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_lines_go_before_documents(frame):
    good = "\n".join(" ".join(f"word{i}{k}" for k in "abcdefgh") + "." for i in range(10))
    menu = "\n".join(f"Home{i} | About{i} | Contact{i}" for i in range(30))
    got = {r.doc_id: r for r in line_rules.apply_rules(frame([(1, good), (2, f"{menu}\n{good}"), (3, f"Home | News\n{good}\nAll rights reserved.")])).collect()}
    assert got[1].kept and got[1].cleaned == good
    assert not got[2].base_failed and not got[2].kept
    assert got[3].kept and got[3].cleaned == good


def test_targets_stop_at_twice_the_size(spark):
    sizes = {"a": 100, "b": 0, "c": 1000, None: 400}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    weight, free, left, want = {"a": 3, "b": 1, "c": 2, None: 3}, set(sizes), 1.5 * 1500, {}
    while True:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * rate > 2 * sizes[s]}
        if not over:
            want |= {s: weight[s] * rate for s in free}
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        free -= over
    assert got == pytest.approx(want)


def test_mix_meets_its_targets(frame):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 90), rng.choice(["a", "b", "b", "b", "b", "c", None])) for i in range(400)]
    rows += [(900, None, "a"), (901, "w " * 5_000, "d"), (None, "w w", "a"), (None, "w w", "a"), (902, "", "e")]
    df = frame(rows, "doc_id long, text string, source string")
    weights = df.sparkSession.createDataFrame([(1, 0.0), (2, 5.0), (2, 7.0), (3, None), (4, float("nan")), (901, -1.0)], "doc_id long, weight double")
    mixed = mixing.mix(df, weights)
    assert _plain(mixed)
    got = mixed.collect()
    assert len(got) == len(rows) and sorted(map(repr, got)) == sorted(map(repr, mixing.mix(df.repartition(5), weights).collect()))
    by = {}
    for r in got:
        t = by.setdefault((r.source_size, r.target), [0, 0])
        t[0] += r.taken
        t[1] += r.size
        assert 0 <= r.taken <= 2 * r.size
    for (size, target), (taken, total) in by.items():
        assert size == total and abs(taken - target) <= 0.5
    unique = df.where("doc_id is not null")
    mixed = mixing.mix(unique)
    docs = mixing.mixed_documents(unique)
    words = {r.doc_id: r.n for r in docs.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(WORD))).alias("n")).collect()}
    assert words == {r.doc_id: r.taken for r in mixed.collect() if r.taken} and docs.columns == df.columns
    assert mixing.mix(df.limit(0)).count() == 0


def test_every_kind_has_a_threshold_at_every_size(frame):
    rng = random.Random(8)

    def card(real):
        d = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(d + c for c in "0123456789" if _luhn(d + c) == real)

    few = [(i, f"see user{i}@mail.example.com or +1 (234) 555-{1000 + i}; card {card(True)}, host 10.0.0.{i}, part {card(True).replace('4', '7', 1)}") for i in range(40)]
    for n in (0, 3, 40):
        model = pii.train(pii.candidates(frame(few[:n])))
        assert all(abs(t) < 100 for t in model.thresholds)
    rows = [*few, (1000, "host 10[.]0[.]0[.]7, mail jo (at) mail (dot) example (dot) com"), (None, "a@b.co")]
    spans = {r.doc_id: r for r in pii.find_spans(frame(rows)).collect()}
    assert {s.kind for s in spans[1000].spans} == {0, 1} and not spans[1000].base


def test_card_targets_are_matches_beyond_chance():
    def cell(lead, check):
        return tuple({"kind": 2, "digits": 16, "lead": lead, "check": check, "issuer": int(lead == 4)}.get(f, 0) for f in pii.FEATURES)

    got = pii._targets({cell(4, 1): (158, 158), cell(4, 0): (11, 0), cell(5, 1): (2, 2), cell(5, 0): (20, 0)})
    real = {(c["lead"], c["check"]): p for c, _, p in got}
    assert real == pytest.approx({(4, 0): 0, (4, 1): 158 - 11 / 9, (5, 0): 0, (5, 1): 2 - 20 / 9})
    trees, base = pii.boost(got)
    value = {k: pii.Model(trees, base, []).value(c) for c, n, p in got for k in [(c["lead"], c["check"])]}
    assert value[4, 1] > 2 and max(value[4, 0], value[5, 0], value[5, 1]) < 0


def test_numbers_inside_failed_matches_and_other_spellings_are_proposed(frame):
    want = {
        1: ("des +1 (826) 555-4081 190.137.223.204 du", "phone", "+1 (826) 555-4081"),
        2: ("des +1 (843) 555-7672 170.106.47.218 et", "phone", "+1 (843) 555-7672"),
        3: ("tel +33 1 23 45 67 89 190.1.1.1", "phone", "+33 1 23 45 67 89"),
        4: ("een 7536784127813050 4845168114407329 que", "card", "4845168114407329"),
        5: ("555-4081 4111 1111 1111 1111x", "card", "4111 1111 1111 1111"),
        6: ("build 2024.190.137.223.204", "ip", "190.137.223.204"),
        7: ("call 030 1234 5678, please", "phone", "030 1234 5678"),
        8: ("call 0049 170 1234567", "phone", "0049 170 1234567"),
        9: ("call +1/826/555-4081/ and", "phone", "+1/826/555-4081"),
        10: ("call five five five, one two three four five", "phone", "five five five, one two three four five"),
        11: ("jo at mail dot example dot com", "email", "jo at mail dot example dot com"),
        12: ("jo@mail[.]com", "email", "jo@mail[.]com"),
        13: ("10 dot 0 dot 0 dot 7", "ip", "10 dot 0 dot 0 dot 7"),
        14: ("4111/1111/1111/1111", "card", "4111/1111/1111/1111"),
        15: ("is 826 555-4081.", "phone", "826 555-4081"),
    }
    found = pii.candidates(frame([(i, t) for i, (t, *_) in want.items()]))
    for r in found.collect():
        text, kind, span = want[r.doc_id]
        got = {(pii.KINDS[c.kind], text[c.start : c.end]) for c in r.found if not c.base}
        assert (kind, span) in got, (text, got)
    clean = pii.candidates(frame([(1, "+1 (234) 555-7713 or a@b.co, 4111 1111 1111 1111 and 10.0.0.7 on 01/02/2024")])).collect()[0]
    assert not any(c.loose for c in clean.found)


def test_a_phone_that_runs_into_an_address_is_redacted_alone(frame):
    rows = [(i, f"call +1 (234) 555-{1000 + i} now") for i in range(300)]
    rows += [(1000, "des +1 (826) 555-4081 190.137.223.204 du")]
    texts = {r.doc_id: r.text for r in pii.redact(frame(rows)).collect()}
    assert texts[1000] == "des [PHONE] [IP] du"


def test_a_rest_that_rounds_to_the_whole_source_is_taken(frame):
    rows = [(1, "w w w", "a"), (2, "w w w", "a"), (3, "w w", "b"), (4, "w w", "b")]
    got = mixing.mix(frame(rows, "doc_id long, text string, source string")).collect()
    by = {r.source_size: (r.target, sum(x.taken for x in got if x.source_size == r.source_size)) for r in got}
    assert by == {6: (11.25, 11), 4: (3.75, 4)}


def test_null_ids_do_not_share_a_bin(frame):
    rows = [(None, f"{'w ' * 9}{i}", "a") for i in range(400)] + [(i, "w " * 10, "b") for i in range(400)]
    mixed = mixing.mix(frame(rows, "doc_id long, text string, source string"), source_weights=(1, 1), share=0.5)
    # of rows in the order of their texts' hashes alone, those taken would all come before those that aren't
    got = sorted((r.text_hash, r.taken) for r in mixed.where("doc_id is null").collect())
    taken = [t for _, t in got]
    assert sum(taken) == 2_000 and taken != sorted(taken, reverse=True)


def test_clean_sentences_stay(frame):
    clean = ["please look at figure dot two for this", "we met at noon dot nobody else came", "arrive at gate dot dash line", "meet me at ten dot it was late"]
    mails = [(i, f"mail user{i}@mail.example.com now") for i in range(300)]
    told = [(2000, "write to jo at mail dot example dot com please"), (2001, "jo (at) mail (dot) org")]
    texts = {r.doc_id: r.text for r in pii.redact(frame(mails + [(1000 + i, t) for i, t in enumerate(clean)] + told)).collect()}
    assert [texts[1000 + i] for i in range(len(clean))] == clean
    assert texts[2000] == "write to [EMAIL] please" and texts[2001] == "[EMAIL]" and texts[5] == "mail [EMAIL] now"
    # a model of other documents doesn't take them either
    model = pii.train(pii.candidates(frame(mails)))
    assert [r.text for r in pii.redact(frame(list(enumerate(clean))), model).orderBy("doc_id").collect()] == clean


def test_addresses_that_are_none_count_as_such():
    def cell(check):
        return tuple({"kind": 0, "separators": 1, "issuer": check}.get(f, 0) for f in pii.FEATURES)

    got = {c["issuer"]: (n, real) for c, n, real in pii._targets({cell(1): (100, 100), cell(0): (500, 0)})}
    assert got[0] == (500, 0) and got[1] == (100, pytest.approx(100 - 500 * pii.CHANCE))


def test_redaction_of_a_text_with_very_many_spans(frame):
    import time

    none = pii.Model([], 0.0, [float("inf")] * 4)
    text = "".join(f"line {i} é😀 from 10.0.{i % 256}.7 to all, " + "x" * (i % 60) + "\n" for i in range(20_000))
    start = time.time()
    got = pii.redact(frame([(1, text), (2, "a@b.co"), (3, ""), (4, None), (5, "no data"), (6, "x" * 256 + "10.0.0.7"), (7, "10.0.0.7" + "x" * 512)]), none).collect()
    texts = {r.doc_id: r.text for r in got}
    assert time.time() - start < 60
    assert texts[1] == re.sub(r"10\.0\.\d+\.7", "[IP]", text)
    assert [texts[i] for i in range(2, 8)] == ["[EMAIL]", "", None, "no data", "x" * 256 + "[IP]", "[IP]" + "x" * 512]


def test_rows_alike_are_mixed_each_on_their_own(frame):
    rows = [(None, "a b c d e f", "s")] * 2 + [(7, "g h", "s")] * 5 + [(8, None, "s"), (9, "", "t")]
    df = frame(rows, "doc_id long, text string, source string")
    taken = sum(r.taken for r in mixing.mix(df).collect())
    docs = mixing.mixed_documents(df)
    assert docs.columns == df.columns
    assert sum(len((r.text or "").split()) for r in docs.collect()) == taken == 33
    assert mixing.mixed_documents(df.limit(0)).count() == 0


def test_documents_without_weight_are_dealt_to_many_bins(frame, monkeypatch):
    seen = []
    monkeypatch.setattr(mixing, "checkpointed", lambda df, real=mixing.checkpointed: seen.append(real(df)) or seen[-1])
    rows = [(i, "w w", "a") for i in range(500)]
    df = frame(rows, "doc_id long, text string, source string")
    weights = df.select("doc_id", F.when(F.col("doc_id") < 100, 1.0).otherwise(0.0).alias("weight"))
    got = mixing.mix(df, weights, source_weights=(1,), share=0.5).collect()
    bins = Counter(r.bin for r in seen[0].where(f"bin >= {1 << 40}").collect())
    assert sum(bins.values()) == 400 and max(bins.values()) <= 3
    assert sum(r.taken for r in got) == 500 and all(r.taken == 2 for r in got if r.doc_id < 100)
