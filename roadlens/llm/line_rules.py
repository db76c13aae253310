"""Quality rules, line first.

Every line is judged on its own. It goes if it

* is navigation: cells between bars or arrows, most of them short;
* is boilerplate: a stock phrase of site furniture in a line that is short;
* is noise: at least as many symbol characters as words, or nothing but signs;
* repeats an earlier line of the document;
* is a fragment: it ends without punctuation and has fewer than
  ``fragment_words`` words.

A document of which less than ``keep_share`` of the words is left is rejected,
on top of the base rules on length and repetition. All of it is built-in
functions over the row: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import SPACE, WORD, id_and_text

SYMBOLS = "#*$%&<>|"
BOILERPLATE = (
    "accept cookies", "all rights reserved", "back to top", "click here", "cookie policy", "enable javascript", "follow us on", "log in", "lorem ipsum", "privacy policy",
    "read more", "share this", "sign up", "skip to content", "subscribe to", "terms of service", "terms of use",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text; a text without any gives an empty array."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(found: Column) -> Column:
        placed = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of_sorted(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(let(placed, of_sorted))

    return F.when(F.size(words) < 4, 0).otherwise(let(hashes, covered))


def _line_fails(line: Column, fragment_words: int) -> Column:
    """For a line that has a word."""
    n = F.regexp_count(line, F.lit(f"{WORD}+"))
    signs = F.length(line) - F.length(_without(line, SYMBOLS))
    bars = F.regexp_count(line, F.lit(r"[|»›]"))
    boilerplate = F.lower(line).rlike("|".join(BOILERPLATE)) & (n < 30)
    ended = line.rlike(rf"""[.!?:;"'”»…)]{SPACE}*$""")
    return (bars * 5 >= n) & (bars > 0) | boilerplate | (signs >= n) | ~line.rlike(r"[\p{L}\p{N}]") | ~ended & (n < fragment_words)


def apply_rules(df: DataFrame, keep_share: float = 0.5, fragment_words: int = 5, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_kept_words, cleaned.

    ``cleaned`` is the text without the lines that fail; lines without a word
    go with them. base_failed: under ``min_words`` words, or over half of the
    words in repeated 3-word windows. kept: base_failed is false and at least
    ``keep_share`` of the words are in lines that stay.

    A null text counts as empty: no words, so base_failed. A null id stays
    null, repeated rows each give a row, an empty table none; other columns
    aren't looked at. Texts are read whole. Windows are compared by a 64-bit
    hash within one document.
    """
    docs = id_and_text(df, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    whole = F.length(text)
    repeated, n_words = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).cast("long").alias("r"))), F.col("w.n")

    def lines(found: Column) -> Column:
        good = F.array_distinct(F.filter(found, lambda x: ~_line_fails(x, fragment_words)))
        return let(good, lambda g: F.struct((F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("dup"), F.array_join(g, "\n").alias("cleaned")))

    measured = docs.select(
        "doc_id",
        repeated.alias("w"),
        let(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)), lines).alias("l"),
        F.length(_without(text, " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        (whole - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
    )
    measured = measured.select("doc_id", "w", "l", "word_chars", "n_symbols", F.regexp_count("l.cleaned", F.lit(f"{WORD}+")).cast("long").alias("n_kept_words"))
    base_failed = (n_words < min_words) | (100 * F.col("w.r") > 50 * n_words)
    return measured.select(
        "doc_id", n_words.alias("n_words"), "word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), F.col("w.r").alias("n_repeat_words"),
        base_failed.alias("base_failed"), (~base_failed & (F.col("n_kept_words") >= keep_share * n_words)).alias("kept"), "n_kept_words", F.col("l.cleaned").alias("cleaned"),
    )
