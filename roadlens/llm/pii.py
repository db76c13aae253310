"""Personal data: candidate spans, boosted trees, calibrated thresholds.

High-recall generators propose spans of four kinds, which may overlap:

* the base patterns. A match that passes its check (parts up to 255, Luhn,
  number of digits) is a base span and is always redacted;
* looser patterns, for spellings that avoid the base ones: ``name (at) host
  (dot) tld``, addresses with ``[.]`` or ``dot``, cards in dotted or spaced groups, phone
  numbers with ``00``, a trunk 0, an area code or digits as words; and the base matches that fail their check;
* numbers inside a base match that runs on into what follows it and so fails
  its check: phone numbers cut at a separator (the shortest and the longest of
  9 to 15 digits), cards at the start, in the middle or at the end of a
  run of digits, addresses after a number and a dot.

A looser span that overlaps a base span of its kind is no candidate.

Format and context features of a candidate (number of digits, separators, the
characters around it, a cue word before it, its first digit; of a card also its
Luhn result and whether it has an issuer's prefix and length, of an address
whether its last label is a suffix) go to gradient
boosted trees. They learn which base matches pass their check, which the
features don't show, so that a score says how much a span looks like the real
ones of its kind. Of cards, whose check is a feature, they learn another thing: how
many of the matches that pass are more than chance. One number in ten passes the
Luhn check by chance, so each match that fails stands for 1/9 of a match of equal
features that passes and is none. Spelled-out addresses, "at" and "dot" being words, are
counted in the same way: those whose last label is a suffix of addresses pass, the others are
none, are never redacted, and each stands for ``CHANCE`` addresses of equal features whose last word is a suffix by chance. As the features have few values, the corpus is counted
into cells of equal features first, all of it, and the trees are boosted on those counts.
Each kind's threshold is the least score from which on at least ``precision`` of the
candidates are real, each scored by trees that have not seen its document. That
share is smoothed towards the share of all kinds together from that score on, and
that one towards what the score itself says, so that every kind has a finite
threshold at every size. Candidates above it are redacted as well.

Built-in functions throughout; the trees become one expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import fresh, id_and_text, stored
from roadlens.llm.line_rules import let

KINDS = ("email", "ip", "card", "phone")
# The quantifiers are possessive and a match starts where a run starts or the last match ended:
# the same matches, found without going back, so that time and stack don't depend on a run's length.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_LABEL = "[A-Za-z0-9-]{1,63}"
_AT, _DOT = r"\x20?[(\[{<](?:at|AT|@)[)\]}>]\x20?", r"\x20?[(\[{<](?:dot|DOT|\.)[)\]}>]\x20?"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?![0-9])"
_GROUPS = r"(?:[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})"
_WIDE = r"(?:[./_: ‐-―]|\x20-\x20|\x20{2,3}|\[[.-]\])"
_PLUS = r"\+[0-9](?:[\x20().-]{0,3}[0-9])"
_NEW, _OVER = "(?<![0-9+]|[0-9][./-])", r"(?![0-9]|[./-][0-9])"
_NATIONAL = "|".join([
    rf"{_NEW}(?:\([0-9]{{3}}\)\x20?|[0-9]{{3}}[\x20./-])[0-9]{{3}}[\x20./-][0-9]{{4}}{_OVER}",
    # nine digits at least, and no date
    rf"{_NEW}(?=\(?0(?:[\x20)./-]{{0,2}}[0-9]){{8}})(?![0-9]{{2}}[./-][0-9]{{2}}[./-](?:[0-9]{{4}}|[0-9]{{2}})(?![0-9]|[./-][0-9]))(?:\(0[0-9]{{1,4}}\)[\x20./-]?|0[1-9][0-9]{{0,4}}[\x20./-])[0-9]{{2,8}}(?:[\x20./-][0-9]{{2,5}}){{0,3}}{_OVER}",
    rf"{_NEW}00[1-9](?:[\x20().-]{{0,2}}[0-9]){{7,11}}{_OVER}",
    r"(?:\+|\b(?:plus|PLUS|Plus)\x20?)[0-9](?:(?:[\x20().-]{0,3}|[/_ ‐-―]|\[[.-]\]|\x20?[(\[]?(?:dot|DOT|dash|DASH)[)\]]?\x20?)[0-9]){8,14}(?![0-9])",
    r"(?<![0-9])[0-9]{3}(?:\[[.-]\]|\x20?[(\[]?(?:dot|DOT|dash|DASH)[)\]]?\x20?)[0-9]{3}(?:\[[.-]\]|\x20?[(\[]?(?:dot|DOT|dash|DASH)[)\]]?\x20?)[0-9]{4}(?![0-9])",
])
_DIGIT = "(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
#: (kind, pattern); each pattern's matches are found on their own, so they may overlap.
LOOSE = [
    ("email", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}(?:{_AT}{_LABEL}(?:(?:{_DOT}|\x20(?:dot|DOT)\x20|\.){_LABEL}){{1,5}}|@{_LABEL}(?:(?:{_DOT}){_LABEL}){{1,5}}|\x20(?:at|AT)\x20{_LABEL}(?:(?:{_DOT}|\x20(?:dot|DOT)\x20){_LABEL}){{1,5}})"),
    ("ip", rf"(?<![0-9.\]]){_OCTET}(?!(?:\.[0-9]{{1,3}}){{3}})(?:(?:{_DOT}|\x20(?:dot|DOT)\x20|\.){_OCTET}){{3}}"),
    ("ip", rf"(?<=[0-9]\.){_OCTET}(?:\.{_OCTET}){{3}}"),
    ("card", rf"(?<![0-9]|[0-9][./_:])(?:[0-9]{{4}}(?:{_WIDE}[0-9]{{4}}){{2}}{_WIDE}[0-9]{{1,7}}|[0-9]{{4}}{_WIDE}[0-9]{{6}}{_WIDE}[0-9]{{4,5}})(?![0-9]|[./_:][0-9])"),
    ("card", rf"(?<![0-9]|[0-9][\x20-]){_GROUPS}(?![0-9])"),
    ("card", rf"(?<![0-9])(?:[0-9]{{12,19}}|{_GROUPS})(?![0-9])"),
    ("card", rf"(?<![0-9]){_GROUPS}(?![\x20-]?[0-9])"),
    ("phone", rf"{_PLUS}{{8,14}}?(?![0-9]|[.-][0-9])"),
    ("phone", rf"{_PLUS}{{8,14}}(?![0-9]|[.-][0-9])"),
    ("phone", _NATIONAL),
    ("phone", rf"(?i)\b{_DIGIT}(?:[\x20,-]{{1,2}}{_DIGIT}){{6,14}}\b"),
]
#: What the last label of a spelled-out address may be: generic ones and those of some countries, without those that are English words.
SUFFIXES = (
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "pro", "app", "dev", "cloud", "online", "shop", "site", "io", "ai", "co", "tv", "cc",
    "eu", "uk", "ie", "de", "fr", "es", "pt", "nl", "ch", "dk", "se", "fi", "pl", "cz", "sk", "hu", "ro", "bg", "gr", "tr", "ru", "ua", "lt", "lv", "ee", "hr", "rs", "si",
    "ca", "mx", "br", "ar", "cl", "pe", "ve", "au", "nz", "jp", "cn", "kr", "hk", "tw", "sg", "th", "vn", "ph", "pk", "lk", "il", "ae", "sa", "eg", "za", "ng", "ke", "ma",
)
_SUFFIX = rf"(?i)[.\x20\])}}>](?:{'|'.join(SUFFIXES)})$"
#: Of words of prose, so many are a suffix too.
CHANCE = 1 / 50
CUES = r"(?i)(?:mail|contact|phone|tel|call|fax|mobile|cell|card|visa|account|host|server|address|ip)[^\n]{0,16}$"
#: Prefixes and lengths that card issuers use.
ISSUERS = r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|(?:5[1-5]|2[2-7])[0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[689][0-9])[0-9]{11}|(?:6011|64[4-9][0-9]|65[0-9]{2}|35[2-8][0-9]|62[0-9]{2})[0-9]{12,15}|(?:50|5[6-9]|6[0-9])[0-9]{10,17})$"
FEATURES = ("kind", "digits", "separators", "before", "after", "cue", "lead", "check", "issuer")
#: Documents are dealt to so many folds for calibration; each is scored by trees of the others.
FOLDS = 5
#: Candidates that a smoothed share of real ones is worth before any is counted.
PRIOR = 4.0
_FIELDS = "struct<start:int,end:int,base:boolean,loose:boolean," + ",".join(f"{f}:int" for f in FEATURES) + ">"


def running(values: Column) -> Column:
    """Sum of the values before each of an array's; by blocks, so that n values take about n ** 1.5 steps."""

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def of(v: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / size).cast("int") - 1), lambda b: F.slice(v, b * size + 1, size))

        def shifted(bs: Column) -> Column:
            return let(F.transform(bs, total), lambda ts: F.flatten(F.transform(bs, lambda b, i: let(total(F.slice(ts, F.lit(1), i)), lambda so_far: F.transform(b, lambda _, k: so_far + total(F.slice(b, F.lit(1), k)))))))

        return let(blocks, shifted)

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(let(values, of))


def _side(c: Column) -> Column:
    return F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^\p{L}$"), 2).when(c.rlike("^[0-9]$"), 3).otherwise(4)


def _passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda t: (F.length(t) <= 3) & (F.concat(F.lit("0"), F.substring(t, 1, 3)).cast("int") <= 255)))
    if kind == "card":
        return let(F.regexp_replace(match, "[^0-9]", ""), lambda d: F.length(d).between(12, 19) & F.call_function("luhn_check", F.substring(d, 1, 19)))
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _found(text: Column, kind: str, pattern: str, loose: bool) -> Column:
    """The matches of one pattern, with places in code points and features."""

    def of(pieces: Column) -> Column:
        def placed(m: Column) -> Column:
            steps = F.transform(m, lambda x, i: F.length(x) + F.length(F.get(pieces, i)))

            def one(x: Column, i: Column, starts: Column) -> Column:
                left = F.get(pieces, i)
                start = F.get(starts, i) + F.length(left)
                digits = F.regexp_count(x, F.lit(rf"(?i){_DIGIT}")) if _DIGIT in pattern else F.length(F.regexp_replace(x, "[^0-9]", ""))
                separators = F.when(x.rlike(r"[\[(]"), 4).when(x.contains(" "), 1).when(x.contains("-"), 2).when(x.contains("."), 3).otherwise(0)
                lead = F.regexp_extract(x, r"^\D{0,3}([0-9])", 1)
                passes = _passes(kind, x)
                check, issuer = (passes, F.regexp_replace(x, "[^0-9]", "").rlike(ISSUERS)) if kind == "card" else (F.lit(False), x.rlike(_SUFFIX) if kind == "email" else F.lit(False))
                return F.struct(
                    start.alias("start"), (start + F.length(x)).alias("end"), (F.lit(False) if loose else passes).alias("base"), F.lit(loose).alias("loose"),
                    F.lit(KINDS.index(kind)).alias("kind"), F.least(digits, F.lit(20)).alias("digits"), separators.alias("separators"),
                    _side(F.right(left, F.lit(1))).alias("before"), _side(F.left(F.get(pieces, i + 1), F.lit(1))).alias("after"),
                    F.right(left, F.lit(24)).rlike(CUES).cast("int").alias("cue"), F.when(lead == "", 10).otherwise(lead.cast("int")).alias("lead"),
                    check.cast("int").alias("check"), issuer.cast("int").alias("issuer"),
                ).cast(_FIELDS)

            return let(running(steps), lambda starts: F.transform(m, lambda x, i: one(x, i, starts)))

        return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)

    return let(F.split(text, pattern, -1), of)


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, found): all candidates of each row."""
    return _with_candidates(id_and_text(df, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "found")


def _with_candidates(df: DataFrame, text_col: str, out: str) -> DataFrame:
    text, none = F.coalesce(F.col(text_col), F.lit("")), F.array().cast(f"array<{_FIELDS}>")
    lower = F.lower(text)
    at, dot, runs = lower.rlike(r"[(\[{<](?:at|@)[)\]}>]"), lower.rlike(r"[(\[{<](?:dot|\.)[)\]}>]|\sdot\s"), text.rlike(r"[0-9](?:[\x20-]?[0-9]){6}")
    base = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": runs, "phone": text.rlike(r"\+[0-9]")}
    # no match without the gate; a number's looser matches need a base match that fails, or a spelling of their own
    over = text.rlike(r"\+[0-9](?:[\x20().-]*[0-9]){15}")
    long = text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")
    gates = [at | dot, dot, text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]+\.[0-9]"), text.rlike(rf"[0-9]{{4}}{_WIDE}[0-9]{{4}}"), long, long, long, over, over, text.rlike(r"[0-9][^0-9]{0,8}[0-9][^0-9]{0,8}[0-9]{2}"), lower.rlike(rf"{_DIGIT}[\x20,-]{{1,2}}{_DIGIT}")]
    number, sure, more = fresh(df, "number", "sure", "more")
    marked = df.withColumn(number, text.rlike("[0-9]"))
    first = [F.when(gate if kind == "email" else F.col(number) & gate, _found(text, kind, BASE[kind], False)).otherwise(none) for kind, gate in base.items()]
    rest = [F.when(gate if kind == "email" or _DIGIT in pattern else F.col(number) & gate, _found(text, kind, pattern, True)).otherwise(none) for (kind, pattern), gate in zip(LOOSE, gates, strict=True)]
    marked = marked.withColumn(sure, F.concat(*first)).withColumn(more, F.array_distinct(F.concat(*rest)))
    spans = F.filter(sure, lambda s: s["base"])
    apart = F.filter(more, lambda c: ~F.exists(spans, lambda s: (s["kind"] == c["kind"]) & (s["start"] < c["end"]) & (c["start"] < s["end"])))
    return marked.withColumn(out, F.when(F.size(more) == 0, F.col(sure)).otherwise(F.concat(sure, apart))).drop(number, sure, more)


Tree = tuple  # (feature, cut, left, right) or (value,)


@dataclass
class Model:
    trees: list[Tree]
    base: float
    thresholds: list[float]

    def value(self, cell: dict[str, int]) -> float:
        def walk(t: Tree) -> float:
            return t[0] if len(t) == 1 else walk(t[2] if cell[t[0]] <= t[1] else t[3])

        return self.base + sum(map(walk, self.trees))

    def selected(self, c: Column) -> Column:
        """Whether a candidate that is no base span is redacted."""

        def walk(t: Tree) -> Column:
            return F.lit(t[0]) if len(t) == 1 else F.when(c[t[0]] <= t[1], walk(t[2])).otherwise(walk(t[3]))

        if all(math.isinf(t) for t in self.thresholds):
            return F.lit(False)
        value = sum(map(walk, self.trees), F.lit(self.base))
        address = (c["kind"] != KINDS.index("email")) | (c["issuer"] == 1)
        return address & (value >= F.get(F.array(*[F.lit(t) for t in self.thresholds]), c["kind"]))


def boost(cells: list[tuple[dict[str, int], int, float]], rounds: int = 30, depth: int = 3, rate: float = 0.3) -> tuple[list[Tree], float]:
    """Gradient boosted trees for the logistic loss. cells: features, how many candidates, how many of them real (an estimate, which may be below 0)."""
    total, real = sum(n for _, n, _ in cells), max(0.0, sum(p for *_, p in cells))
    base = math.log((real + 0.5) / (total - real + 0.5))
    z, trees = [base] * len(cells), []

    def grow(rows: list[int], g: list[float], h: list[float], level: int) -> Tree:
        sg, sh = sum(g[i] for i in rows), sum(h[i] for i in rows)
        best = (1e-6, None, 0)
        for f in FEATURES if level else ():
            sums: dict[int, list[float]] = {}
            for i in rows:
                s = sums.setdefault(cells[i][0][f], [0.0, 0.0])
                s[0] += g[i]
                s[1] += h[i]
            lg = lh = 0.0
            for v in sorted(sums)[:-1]:
                lg, lh = lg + sums[v][0], lh + sums[v][1]
                gain = lg * lg / (lh + 1) + (sg - lg) ** 2 / (sh - lh + 1) - sg * sg / (sh + 1)
                if gain > best[0]:
                    best = (gain, f, v)
        if best[1] is None:
            return (rate * sg / (sh + 1),)
        left = [i for i in rows if cells[i][0][best[1]] <= best[2]]
        right = [i for i in rows if cells[i][0][best[1]] > best[2]]
        return (best[1], best[2], grow(left, g, h, level - 1), grow(right, g, h, level - 1))

    def walk(t: Tree, cell: dict[str, int]) -> float:
        return t[0] if len(t) == 1 else walk(t[2] if cell[t[0]] <= t[1] else t[3], cell)

    for _ in range(rounds if 0 < real < total else 0):
        p = [1 / (1 + math.exp(-v)) for v in z]
        g = [c[2] - c[1] * q for c, q in zip(cells, p, strict=True)]
        h = [c[1] * q * (1 - q) for c, q in zip(cells, p, strict=True)]
        trees.append(grow(list(range(len(cells))), g, h, depth))
        z = [v + walk(trees[-1], c[0]) for v, c in zip(z, cells, strict=True)]
    return trees, base


def _targets(counts: dict[tuple, tuple[int, int]]) -> list[tuple[dict[str, int], int, float]]:
    """Cells with targets, of (candidates, passing ones) by features; for cards and addresses, passing ones beyond chance."""
    check, card, email = FEATURES.index("check"), KINDS.index("card"), KINDS.index("email")
    out: dict[tuple, list] = {}
    for key, (n, real) in sorted(counts.items()):
        cell = out.setdefault(key, [0, 0.0])
        cell[0] += n
        cell[1] += real
        if key[0] == card and not key[check] and 12 <= key[1] <= 19:
            out.setdefault((*key[:check], 1, *key[check + 1 :]), [0, 0.0])[1] -= n / 9
        if key[0] == email and not key[-1] and n > real:
            out.setdefault((*key[:-1], 1), [0, 0.0])[1] -= (n - real) * CHANCE
    return [(dict(zip(FEATURES, key, strict=True)), n, real) for key, (n, real) in sorted(out.items())]


def thresholds(scored: list[tuple[int, float, int, float]], precision: float) -> list[float]:
    """For each kind, the least score from which on the smoothed share of real ones is ``precision``; always finite.

    scored: kind, score, how many candidates, how many of them real. A kind is
    tried at its own scores and, above all of these, at the other kinds'.
    """
    sure = math.log(precision / (1 - precision)) if precision < 1 else 30.0
    tried = sorted({v for _, v, _, _ in scored} | {sure}, reverse=True)
    out = []
    for kind in range(len(KINDS)):
        ranked = sorted(((v, k == kind, n, real) for k, v, n, real in scored), reverse=True)
        highest = max((v for k, v, n, _ in scored if k == kind and n), default=-math.inf)
        own = {v for k, v, n, _ in scored if k == kind and n}
        found = max(tried[0], sure) + 1.0
        n = real = every = every_real = 0.0
        at = 0
        for t in tried:
            while at < len(ranked) and ranked[at][0] >= t:
                _, mine, m, r = ranked[at]
                every, every_real = every + m, every_real + r
                if mine:
                    n, real = n + m, real + r
                at += 1
            says = 1 / (1 + math.exp(-max(-30.0, min(30.0, t))))
            pooled = (every_real + PRIOR * says) / (every + PRIOR)
            if (t in own or t > highest) and real + PRIOR * pooled >= precision * (n + PRIOR):
                found = t
        out.append(found)
    return out


def train(found: DataFrame, precision: float = 0.98) -> Model:
    """Boost on all documents, calibrate by trees of four fifths on the fifth they haven't seen; ``found`` as candidates() gives it.

    All base matches and spelled-out addresses of all rows count; a row without an id goes to a fold by
    its text. The driver gets one row a cell and fold, of which there are at
    most 4 x 21 x 5 x 5 x 5 x 2 x 11 x 2 x 2 cells.
    """
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.col("text")).cast("binary")) % FOLDS
    address = f"c.kind = {KINDS.index('email')}"
    one = found.select(fold.cast("int").alias("fold"), F.explode("found").alias("c")).where(f"not c.loose or {address}")
    counts = one.groupBy(*[F.col(f"c.{f}").alias(f) for f in FEATURES], "fold").agg(F.count("*").alias("n"), F.sum(F.expr(f"cast(c.base or {address} and c.issuer = 1 as long)")).alias("real"))
    rows = [(r.fold, tuple(r[f] for f in FEATURES), r.n, r.real) for r in counts.collect()]

    def cells(of) -> list[tuple[dict[str, int], int, float]]:
        sums: dict[tuple, tuple[int, int]] = {}
        for k, key, n, real in rows:
            if of(k):
                had = sums.get(key, (0, 0))
                sums[key] = (had[0] + n, had[1] + real)
        return _targets(sums)

    scored = []
    for out in range(FOLDS):
        seen, unseen = cells(lambda k, out=out: k != out), cells(lambda k, out=out: k == out)
        model = Model(*boost(seen), [])
        scored += [(c["kind"], model.value(c), n, real) for c, n, real in unseen]
    return Model(*boost(cells(lambda k: True)), thresholds(scored, precision))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _spans(found: Column, chosen) -> Column:
    return F.array_sort(F.transform(F.filter(found, chosen), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))


def find_spans(df: DataFrame, model: Model | None = None, precision: float = 0.98, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text, base and spans: arrays of (start, kind, end), in code points, by start, then kind as in KINDS.

    Without a model, one is trained on df first. A null text counts as empty
    and has no span; a null id stays null and counts for training. Repeated
    rows each give a row, an empty table none; other columns aren't looked at.
    Texts of any length are read whole.
    """
    found = candidates(df, id_col, text_col)
    if model is None:
        found = stored(found, "pii")  # every pattern runs once
        model = train(found, precision)
    return found.select("doc_id", "text", _spans(F.col("found"), lambda c: c["base"]).alias("base"), _spans(F.col("found"), lambda c: c["base"] | ~c["base"] & model.selected(c)).alias("spans"))


def summary(spans: DataFrame) -> DataFrame:
    """Per row of find_spans(): doc_id, the number of base spans of each kind, and digests of the spans."""

    def of_kind(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return spans.select("doc_id", *map(of_kind, range(len(KINDS))), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


#: Code points of a block.
BLOCK = 256


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or each group of overlapping spans, replaced by its first span's kind in brackets.

    The text is cut into blocks once; what stays between two spans is taken
    from the blocks it lies in, so that time grows with the text and the spans, not their product.
    """
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("parts"))

    def of(blocks: Column) -> Column:
        def piece(a: Column, b: Column) -> Column:
            first = F.floor(a / BLOCK).cast("int")
            some = F.slice(blocks, first + 1, F.floor((b - 1) / BLOCK).cast("int") - first + 1)
            return F.when(b <= a, "").otherwise(F.substring(F.array_join(some, ""), a - first * BLOCK + 1, b - a))

        def step(done: Column, s: Column) -> Column:
            more = F.when(s["start"] < done["end"], done["parts"]).otherwise(F.concat(done["parts"], F.array(piece(done["end"], s["start"]), F.get(tags, s["kind"]))))
            return F.struct(F.greatest(done["end"], s["end"]).alias("end"), more.alias("parts"))

        return F.aggregate(spans, start, step, lambda done: F.concat(F.array_join(done["parts"], ""), piece(done["end"], F.length(text))))

    return F.when(F.size(spans) == 0, text).otherwise(let(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0)), of))


def redact(df: DataFrame, model: Model | None = None, precision: float = 0.98, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df, all columns, with the spans of find_spans() replaced in the text; a null text stays null.

    A null id and repeated rows stay as they are, an empty table stays empty;
    the other columns are handed on, whatever their names.
    """
    (found,) = fresh(df, "found")
    marked = _with_candidates(df, text_col, found)
    if model is None:
        marked = stored(marked, "pii")  # every pattern runs once
        model = train(marked.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(found).alias("found")), precision)
    spans = _spans(F.col(found), lambda c: c["base"] | ~c["base"] & model.selected(c))
    marked = marked.withColumn(found, spans)
    return marked.withColumn(text_col, redacted(F.col(text_col), F.col(found))).select(*df.columns)
