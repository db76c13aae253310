"""Label and formatting helpers (X9, X12, X13, severity / weekday names)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadlens.schemas import (DAY_NAMES, SAMPLE_KEEP_CHARS, SAMPLE_MAX_CHARS,
                              SEVERITY_ELSE, SEVERITY_LABELS)


def severity_label(c: Column) -> Column:
    """1 Fatal, 2 Serious, anything else (null included) Slight."""
    out = None
    for code, label in SEVERITY_LABELS:
        out = (F.when(c == code, F.lit(label)) if out is None
               else out.when(c == code, F.lit(label)))
    return out.otherwise(F.lit(SEVERITY_ELSE))


def weekday_name(c: Column) -> Column:
    """1 = Sunday ... 7 = Saturday; other values -> null (no ELSE)."""
    out = None
    for i, name in enumerate(DAY_NAMES, start=1):
        out = F.when(c == i, F.lit(name)) if out is None else out.when(c == i, F.lit(name))
    return out


def monday_first_ordinal(day_of_week: Column) -> Column:
    """Sunday-first 1..7 -> Monday-first 1..7 (Monday 1, Sunday 7)."""
    return ((day_of_week + 5) % 7) + 1


def month_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def truncate_sample(c: Column) -> Column:
    """Text longer than 43 characters -> first 40 plus ``...``."""
    return F.when(F.length(c) > SAMPLE_MAX_CHARS,
                  F.concat(F.substring(c, 1, SAMPLE_KEEP_CHARS), F.lit("..."))).otherwise(c)
