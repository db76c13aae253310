"""Cleaning steps (C1-C12). Each is ``DataFrame -> DataFrame`` and adds or
replaces columns in one projection; ``clean_all`` chains them in the
published order after keep-first deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.functions.fill import fill_columns, fill_nulls
from roadlens.functions.parsing import lenient_hour, parse_day_first_date
from roadlens.operators.dedup import keep_first
from roadlens.operators.repeats import keep_first_of_repeats
from roadlens.operators.small import broadcast_if_small, materialize, measured_bytes
from roadlens.schemas import (HAZARD_NONE, HAZARD_PLACEHOLDER_REGEX, KEY_COL, NIGHT,
                              NO_JUNCTION_CONTROL, SECOND_ROAD_CLASS_FILL,
                              SECOND_ROAD_NUMBER_FILL, SOURCE_ORDER_COL, TIME_PERIODS,
                              UK_LAT_BOUNDS, UK_LON_BOUNDS, UNKNOWN_FILLS, WEATHER_RULES,
                              WEEKEND_DAYS)


SOURCE_COLS = (SOURCE_ORDER_COL, "source_file", "source_block", "source_row")


def dedup_accidents(raw: DataFrame, mostly_unique: bool = False) -> DataFrame:
    """One row per accident, the first occurrence by source order
    (``copy_no``, or file path / split / line position for CSV input,
    whichever are present); source columns dropped. ``mostly_unique``: rows
    of single keys skip the shuffle; ``raw`` is then read three times."""
    order = [c for c in SOURCE_COLS if c in raw.columns]
    keep = keep_first_of_repeats if mostly_unique else keep_first
    return keep(raw, KEY_COL, order).drop(*SOURCE_COLS)


def calendar_columns() -> dict[str, F.Column]:
    """C4 expressions: parsed ``Date``; year, month, quarter, day, weekday (1 = Sunday).
    The parse repeats in each expression; subexpression elimination runs it once."""
    d = parse_day_first_date(F.col("Date"))
    return {
        "Date_Parsed": d,
        "Year_Derived": F.year(d),
        "Month_Num": F.month(d),
        "Quarter_Num": F.quarter(d),
        "Day_Num": F.dayofmonth(d),
        "DayOfWeek_Num": F.dayofweek(d),
    }


def add_calendar(df: DataFrame) -> DataFrame:
    """C4: parse ``Date``; derive year, month, quarter, day, weekday (1 = Sunday)."""
    return df.withColumns(calendar_columns())


def add_hour(df: DataFrame, strict: bool = False) -> DataFrame:
    """``Hour`` from the first clock time in ``Time``; ``Time`` is kept."""
    return df.withColumn("Hour", lenient_hour(F.col("Time"), strict=strict))


def time_period(hour) -> F.Column:
    out = None
    for lo, hi, label in TIME_PERIODS:
        cond = hour.between(lo, hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(NIGHT))


def period_weekend_columns(hour: F.Column, day_of_week: F.Column) -> dict[str, F.Column]:
    return {
        "time_period": time_period(hour),
        "is_weekend": F.coalesce(day_of_week.isin(*WEEKEND_DAYS), F.lit(False)),
    }


def add_period_weekend(df: DataFrame) -> DataFrame:
    """Period of day (null hour -> Night); weekend flag (null -> false)."""
    return df.withColumns(period_weekend_columns(F.col("Hour"), F.col("DayOfWeek_Num")))


def fill_junction_control(df: DataFrame) -> DataFrame:
    """Null ``Junction_Control`` means no junction."""
    return df.withColumn("Junction_Control",
                         F.coalesce(F.col("Junction_Control"), F.lit(NO_JUNCTION_CONTROL)))


def hazards(c: F.Column) -> F.Column:
    placeholder = F.lower(c).rlike(HAZARD_PLACEHOLDER_REGEX)
    cleaned = F.when(placeholder, F.lit(None).cast("string")).otherwise(c)
    return F.coalesce(cleaned, F.lit(HAZARD_NONE))


def clean_hazards(df: DataFrame) -> DataFrame:
    """Placeholder text (case-insensitive) -> null, then null -> 'None'."""
    return df.withColumn("Carriageway_Hazards", hazards(F.col("Carriageway_Hazards")))


def weather(c: F.Column) -> F.Column:
    out = None
    for needle, label in WEATHER_RULES:
        cond = c.contains(needle)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(c)


def consolidate_weather(df: DataFrame) -> DataFrame:
    """Ordered substring rules, first match wins, else unchanged."""
    return df.withColumn("Weather_Conditions", weather(F.col("Weather_Conditions")))


def add_lsoa_flag(df: DataFrame) -> DataFrame:
    """``lsoa_available``; the area code itself stays null."""
    return df.withColumn("lsoa_available", F.col("LSOA_of_Accident_Location").isNotNull())


def coordinate_valid(strict: bool = False) -> F.Column:
    """Both coordinates present; with ``strict`` also inside the UK box."""
    lat, lon = F.col("Latitude"), F.col("Longitude")
    ok = lat.isNotNull() & lon.isNotNull()
    if strict:
        ok = ok & lat.between(*UK_LAT_BOUNDS) & lon.between(*UK_LON_BOUNDS)
    return ok


def add_coordinate_flag(df: DataFrame, strict: bool = False) -> DataFrame:
    """C9 (C9b with ``strict``): ``is_coordinate_valid``."""
    return df.withColumn("is_coordinate_valid", coordinate_valid(strict))


def fill_second_road(df: DataFrame) -> DataFrame:
    """No second road -> 'N/A' / -1, for whichever columns are present."""
    return fill_nulls(df, {"2nd_Road_Class": SECOND_ROAD_CLASS_FILL,
                           "2nd_Road_Number": SECOND_ROAD_NUMBER_FILL})


def fill_unknowns(df: DataFrame) -> DataFrame:
    """C11: remaining nulls in dimension attributes -> explicit categories.

    Type-aware: a text fill for a numeric column (``Urban_or_Rural_Area``)
    leaves it unchanged.
    """
    return fill_nulls(df, UNKNOWN_FILLS)


def impute_speed_limit(df: DataFrame, group_col: str = "Road_Type") -> DataFrame:
    """``Speed_limit`` <= 0 -> median of the valid limits of its road type.

    The per-type medians come from one exact, map-side-combined aggregate
    (its state is a value->count map, bounded by the few distinct limits).
    That small result is checkpointed once, its bytes measured, and it is
    broadcast only within the session's threshold (else a shuffle join).
    Types without a valid limit keep their value.
    """
    medians = (df.filter(F.col("Speed_limit") > 0)
                 .groupBy(group_col)
                 .agg(F.median("Speed_limit").alias("_median_speed")))
    medians, _ = materialize(medians, count=False)
    joined = df.join(broadcast_if_small(medians, measured_bytes(medians)), on=group_col, how="left")
    fixed = F.when((F.col("Speed_limit") <= 0) & F.col("_median_speed").isNotNull(),
                   F.round(F.col("_median_speed"), 0).cast("int")).otherwise(F.col("Speed_limit"))
    return joined.withColumn("Speed_limit", fixed).select(*df.columns)


def clean_all(raw: DataFrame, strict_hour: bool = False, strict_coordinates: bool = False,
              impute_speed: bool = False, mostly_unique: bool = False) -> DataFrame:
    """The whole cleaning chain in the published order, after C8 dedup.

    The steps are composed as expressions and applied as ONE projection
    (one plan analysis, one fused codegen stage) instead of a dozen chained
    ``withColumn`` calls; each expression equals its single-step function.
    """
    df = dedup_accidents(raw, mostly_unique)
    cols = calendar_columns()
    cols["Hour"] = lenient_hour(F.col("Time"), strict=strict_hour)
    cols.update(period_weekend_columns(cols["Hour"], cols["DayOfWeek_Num"]))
    cols["Junction_Control"] = F.coalesce(F.col("Junction_Control"), F.lit(NO_JUNCTION_CONTROL))
    cols["Carriageway_Hazards"] = hazards(F.col("Carriageway_Hazards"))
    cols["Weather_Conditions"] = weather(F.col("Weather_Conditions"))
    cols["lsoa_available"] = F.col("LSOA_of_Accident_Location").isNotNull()
    cols["is_coordinate_valid"] = coordinate_valid(strict_coordinates)
    cols.update(fill_columns(df, {"2nd_Road_Class": SECOND_ROAD_CLASS_FILL,
                                  "2nd_Road_Number": SECOND_ROAD_NUMBER_FILL}, cols))
    cols.update(fill_columns(df, UNKNOWN_FILLS, cols))
    df = df.withColumns(cols)
    if impute_speed:
        df = impute_speed_limit(df)
    return df
