"""Parsing helpers (X1-X6). All are built-in expressions, ANSI-safe."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadlens.schemas import DATE_PATTERN, HOUR_REGEX

# Strict ``H:M`` / ``HH:MM`` (each part one or two digits, hour < 24,
# minute < 60), the shape a ``%H:%M`` parser accepts.
STRICT_TIME_REGEX = r"^(\d{1,2}):(\d{1,2})$"


def parse_day_first_date(c: Column, patterns: tuple[str, ...] = (DATE_PATTERN,)) -> Column:
    """``dd/MM/yyyy`` text -> DATE; malformed -> null (never an error)."""
    parsed = [F.try_to_date(c, p) for p in patterns]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def blank_to_null(c: Column) -> Column:
    """Empty string -> null, other values unchanged."""
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def lenient_hour(c: Column, strict: bool = False) -> Column:
    """Hour from the first ``H:MM`` / ``HH:MM`` found anywhere in the text.

    No match -> null. Not range-checked (``99:99`` -> 99) unless ``strict``,
    which nulls hours above 23.
    """
    text = F.regexp_extract(c.cast("string"), HOUR_REGEX, 1)
    hour = blank_to_null(text).cast("int")
    if strict:
        hour = F.when(hour <= 23, hour)
    return hour


def strict_hour(c: Column) -> Column:
    """Hour of a value that is exactly a clock time; anything else -> null."""
    hh = F.regexp_extract(c, STRICT_TIME_REGEX, 1)
    mm = F.regexp_extract(c, STRICT_TIME_REGEX, 2)
    ok = c.rlike(STRICT_TIME_REGEX) & (hh.try_cast("int") <= 23) & (mm.try_cast("int") <= 59)
    return F.when(ok, hh.try_cast("int"))
