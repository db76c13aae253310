"""Rows whose values may repeat, found without moving the rows.

A 64-bit hash of the values is counted, which shuffles eight bytes a row,
combined map-side. The hashes seen twice set bits of a filter, and the filter
is broadcast: it has ``bits`` bits at most, whatever the input. Rows that miss
it are single for certain; the rest, repeats and a few others, can be
treated exactly, by a shuffle in proportion to them. A filter that many
repeats have filled lets more rows through, but changes no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.operators.dedup import keep_first

#: Bits of the filter, a power of two: 262,144 words of 64 bits, 4 MB with their places.
FILTER_BITS = 1 << 24


def _hash(columns: list[str]):
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def _free(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def repeat_filter(df: DataFrame, columns: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """(_word, _bits): the filter of hashes that several rows have; ``bits`` / 64 rows at most."""
    twice = df.groupBy(_hash(columns).alias("_h")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    slot = F.col("_h").bitwiseAND(F.lit(bits - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    return twice.groupBy(F.shiftright(slot, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def flag_repeats(df: DataFrame, columns: list[str], flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with a boolean ``flag``: true for each row whose ``columns`` equal
    another row's (nulls are equal), and for those few whose hash meets their bit."""
    slot, word, held = (_free(df, name) for name in ("_slot", "_word", "_bits"))
    found = repeat_filter(df, columns, bits).toDF(word, held)
    joined = df.withColumn(slot, _hash(columns).bitwiseAND(F.lit(bits - 1))).join(
        F.broadcast(found), F.shiftright(F.col(slot), 6) == F.col(word), "left")
    hit = F.coalesce(F.getbit(F.col(held), F.col(slot).bitwiseAND(F.lit(63)).cast("int")), F.lit(0)) == 1
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], hit.alias(flag))


def keep_first_of_repeats(df: DataFrame, key: str, order_cols: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``keep_first``, for tables whose keys are mostly single:
    rows of single keys aren't shuffled. ``df`` is read three times, once its
    key alone, so it should be a stored table."""
    again = _free(df, "_again")
    flagged = flag_repeats(df, [key], again, bits)
    single = flagged.filter(~F.col(again)).drop(again)
    return single.unionByName(keep_first(flagged.filter(again).drop(again), key, order_cols))
