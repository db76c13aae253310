"""Small intermediate results: materialize once, check size, broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from roadlens.session import broadcast_limit, ensure_checkpoint_dir


def materialize(df: DataFrame, count: bool = True) -> tuple[DataFrame, int | None]:
    """Reliable checkpoint (shared folder) + row count of the stored copy.

    Cuts lineage so later uses read the same rows (no recomputation after a
    lost executor) and gives an exact size for the broadcast decision.
    """
    ensure_checkpoint_dir(df.sparkSession)
    stored = df.checkpoint(eager=True)
    return stored, (stored.count() if count else None)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as a join keeps it: 8 a field and 8 before them, and texts at their length."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 8
             for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return sum(texts, F.lit(8 + 8 * len(df.columns))).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a materialized frame, by one aggregate."""
    return int(df.agg(F.sum(row_bytes(df)).alias("b")).first()["b"] or 0)


def broadcast_if_small(df: DataFrame, nbytes: int | None) -> DataFrame:
    """Broadcast hint only for a side measured to fit the session's broadcast threshold."""
    fits = nbytes is not None and nbytes <= broadcast_limit(df.sparkSession)
    return F.broadcast(df) if fits else df
