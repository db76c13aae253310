"""Primary-key deduplication, keep first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def keep_first(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """One row per ``key``: the first by ``order_cols``, then by the remaining
    columns (so the choice never depends on row placement).

    Written as ``min(struct(order, rest))`` per key rather than a window:
    the aggregate combines map-side, so a key holding a large share of all
    rows is reduced to one row per input partition before the shuffle
    instead of landing whole in one task.
    """
    rest = [c for c in df.columns if c != key and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest])
    best = df.groupBy(key).agg(F.min(packed).alias("_first"))
    return best.select(*[F.col(key) if c == key else F.col("_first").getField(c).alias(c)
                         for c in df.columns])


def dedup_counts(df: DataFrame, key: str) -> DataFrame:
    """One row: rows before, rows after keep-first (one per key value, null
    included), rows removed — from one key-grouped aggregate, combined
    map-side like the dedup itself."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (per_key.agg(F.sum("_n").alias("before"), F.count(F.lit(1)).alias("after"))
                   .select(F.col("before").cast("long").alias("before"), "after",
                           (F.col("before") - F.col("after")).cast("long").alias("removed")))
