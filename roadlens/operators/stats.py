"""Generic aggregate helpers used by the profiles.

Wide per-column metrics are computed in ONE aggregate over all columns and
then turned into rows with ``inline(array(struct ...))`` — one scan per
profile, not one per column. Totals that later steps need stay inside the
plan as scalar subqueries (``DataFrame.scalar()``); quantiles are in ``quantiles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def rows_from_wide(wide: DataFrame, records: list[dict[str, Column]]) -> DataFrame:
    """One-row ``wide`` -> one output row per record (same field names/types)."""
    structs = [F.struct(*[expr.alias(name) for name, expr in rec.items()]) for rec in records]
    return wide.select(F.inline(F.array(*structs)))


def pct(part: Column, total: Column, digits: int) -> Column:
    return F.round(part * F.lit(100.0) / total, digits)


def value_counts(df: DataFrame, column: str, name: str = "cnt") -> DataFrame:
    """Counts per non-null value (nulls excluded, like pandas)."""
    return (df.filter(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias(name)))


def approx_quantile(c: Column, q: float | list[float], accuracy: int = 10_000) -> Column:
    """Bounded-memory quantile sketch (a data value, not interpolated)."""
    return F.percentile_approx(c, q, accuracy)
