"""Type-aware null filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def _fits(value, dtype: T.DataType) -> bool:
    if isinstance(value, bool):
        return isinstance(dtype, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(dtype, _NUMERIC)
    if isinstance(value, str):
        return isinstance(dtype, T.StringType)
    return False


def fill_columns(df: DataFrame, fills: dict[str, object],
                 current: dict[str, Column] | None = None) -> dict[str, Column]:
    """The ``fill_nulls`` replacements as expressions, applied on top of
    ``current`` (pending expressions for the same columns), if given."""
    types = {f.name: f.dataType for f in df.schema.fields}
    current = current or {}
    return {name: F.coalesce(current.get(name, F.col(name)), F.lit(value).cast(types[name]))
            for name, value in fills.items()
            if name in types and _fits(value, types[name])}


def fill_nulls(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """``coalesce(col, value)`` for each present column whose type fits.

    A value that does not fit the column's type (say ``'Unknown'`` for an int
    column) leaves the column as it is, instead of failing under ANSI or
    turning every value null. Absent columns are skipped.
    """
    replace = fill_columns(df, fills)
    return df.withColumns(replace) if replace else df
