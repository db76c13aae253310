"""Business questions (BQ1-BQ5) and chart datasets (V1-V4) over the star.

Each function takes the fact and the dimension DataFrames it needs and
returns a lazy, bounded result. Joins are inner equi-joins on surrogate keys;
grouping happens after the join so the partial aggregate runs before the
only shuffle. What follows the grouping is a function of its own, so that the
roll-up (``plans.rollup``) is finished in the same way. Windows run on aggregated rows only (bounded by group count).
Ties left open by the published queries are broken by the grouping columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from roadlens.functions.labels import month_label, severity_label, weekday_name
from roadlens.operators.small import materialize
from roadlens.schemas import (BQ2_MIN_ACCIDENTS, BQ3_TOP, BQ5_MIN_FATAL, BQ5_TOP,
                              RUSH_HOURS, TOP_WEATHER)


def _round2(c):
    return F.round(c, 2)


def _on(fact: DataFrame, dim: DataFrame, key: str, alias: str, how: str = "inner") -> DataFrame:
    """``fact`` (alias ``f``, possibly already joined) joined to ``dim`` AS ``alias`` on ``key``."""
    return fact.join(dim.alias(alias), F.col(f"f.{key}") == F.col(f"{alias}.{key}"), how)


def col(name: str):
    return F.col(name)


def monthly_rank(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """BQ1: accidents per (year, month) and the month's rank within its year."""
    monthly = (_on(fact.alias("f"), dim_time, "time_key", "t")
                   .groupBy(col("t.Year_Derived").alias("Year"), col("t.Month_Num").alias("Month"))
                   .agg(F.count(F.lit(1)).alias("accident_count")))
    return ranked_months(monthly)


def ranked_months(monthly: DataFrame) -> DataFrame:
    w = Window.partitionBy("Year").orderBy(F.col("accident_count").desc())
    return (monthly.withColumn("month_rank_in_year", F.rank().over(w))
                   .orderBy("Year", "Month"))


def road_area_vulnerability(fact: DataFrame, dim_road: DataFrame, dim_geo: DataFrame,
                            min_accidents: int = BQ2_MIN_ACCIDENTS) -> DataFrame:
    """BQ2: road type x area with more than ``min_accidents``, ranked by mean casualties."""
    joined = _on(_on(fact.alias("f"), dim_road, "road_key", "r"), dim_geo, "geo_key", "g")
    groups = (joined.groupBy(col("r.Road_Type").alias("Road_Type"),
                             col("g.Urban_or_Rural_Area").alias("Urban_or_Rural_Area"))
                  .agg(F.count(F.lit(1)).alias("total_accidents"),
                       F.avg("f.Number_of_Casualties").alias("_avg")))
    return ranked_areas(groups, min_accidents)


def ranked_areas(groups: DataFrame, min_accidents: int = BQ2_MIN_ACCIDENTS) -> DataFrame:
    groups = groups.filter(F.col("total_accidents") > min_accidents)
    w = Window.orderBy(F.col("_avg").desc(), "Road_Type", "Urban_or_Rural_Area")
    return (groups.select("Road_Type", "Urban_or_Rural_Area", "total_accidents",
                          _round2(F.col("_avg")).alias("avg_casualties"),
                          F.row_number().over(w).alias("vulnerability_rank"))
                  .orderBy("vulnerability_rank"))


def area_hotspots(fact: DataFrame, dim_geo: DataFrame, top: int = BQ3_TOP) -> DataFrame:
    """BQ3: the ``top`` areas by accident count (only rows with a known area)."""
    groups = (_on(fact.alias("f"), dim_geo.filter(F.col("lsoa_available")), "geo_key", "g")
                .groupBy(col("g.LSOA_of_Accident_Location").alias("LSOA"),
                         col("g.Urban_or_Rural_Area").alias("Urban_or_Rural_Area"))
                .agg(F.count(F.lit(1)).alias("total_accidents"),
                     F.sum("Number_of_Casualties").alias("total_casualties"),
                     _round2(F.avg("Number_of_Casualties")).alias("avg_casualties")))
    return top_areas(groups, top)


def top_areas(groups: DataFrame, top: int = BQ3_TOP) -> DataFrame:
    return (groups.orderBy(F.col("total_accidents").desc(), "LSOA", "Urban_or_Rural_Area")
                .limit(top))


def junction_severity(fact: DataFrame, dim_road: DataFrame) -> DataFrame:
    """BQ4: junction control x severity."""
    return (_on(fact.alias("f"), dim_road, "road_key", "r")
                .groupBy(col("r.Junction_Control").alias("Junction_Control"),
                         col("f.Accident_Severity").alias("Accident_Severity"))
                .agg(F.count(F.lit(1)).alias("accident_count"),
                     F.sum("Number_of_Casualties").alias("total_casualties"),
                     _round2(F.avg("Number_of_Casualties")).alias("avg_casualties"))
                .orderBy("Junction_Control", F.col("accident_count").desc(), "Accident_Severity"))


def fatal_combinations(fact: DataFrame, dim_road: DataFrame, dim_env: DataFrame,
                       min_fatal: int = BQ5_MIN_FATAL, top: int = BQ5_TOP) -> DataFrame:
    """BQ5: road type x speed x weather for fatal accidents; > ``min_fatal``; top ``top``."""
    fatal = fact.filter(F.col("Accident_Severity") == 1).alias("f")
    groups = (_on(_on(fatal, dim_road, "road_key", "r"), dim_env, "env_key", "e")
                .groupBy(col("r.Road_Type").alias("Road_Type"), col("r.Speed_limit").alias("Speed_limit"),
                         col("e.Weather_Conditions").alias("Weather_Conditions"))
                .agg(F.count(F.lit(1)).alias("fatal_count"),
                     F.sum("f.Number_of_Casualties").alias("total_casualties")))
    return top_combinations(groups, min_fatal, top)


def top_combinations(groups: DataFrame, min_fatal: int = BQ5_MIN_FATAL, top: int = BQ5_TOP) -> DataFrame:
    return (groups.filter(F.col("fatal_count") > min_fatal)
                .orderBy(F.col("fatal_count").desc(), "Road_Type", "Speed_limit", "Weather_Conditions")
                .limit(top))


def fatal_combinations_plan(fact: DataFrame, dim_road: DataFrame, dim_env: DataFrame) -> DataFrame:
    """V5: the query whose plan is inspected (BQ5 without sum, having, limit)."""
    fatal = fact.filter(F.col("Accident_Severity") == 1).alias("f")
    return (_on(_on(fatal, dim_road, "road_key", "r"), dim_env, "env_key", "e")
                .groupBy(col("r.Road_Type").alias("Road_Type"), col("r.Speed_limit").alias("Speed_limit"),
                         col("e.Weather_Conditions").alias("Weather_Conditions"))
                .agg(F.count(F.lit(1)).alias("fatal_count"))
                .orderBy(F.col("fatal_count").desc()))


# --------------------------------------------------------------------------
# Chart datasets
# --------------------------------------------------------------------------

def month_series(bq1: DataFrame) -> DataFrame:
    """V1: ``YYYY-MM`` label and count, in label order."""
    return (bq1.select(month_label(F.col("Year"), F.col("Month")).alias("date_label"),
                       "accident_count")
               .orderBy("date_label"))


def severity_by_weekday(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """V2: weekday (Sunday first) x {Fatal, Serious, Slight} counts, 0 if absent.

    Counted in long form (one partial + final aggregate), then pivoted over
    the three fixed labels; unknown weekday codes (null label) are dropped
    as in the chart.
    """
    long = (_on(fact.alias("f"), dim_time, "time_key", "t")
                .groupBy(col("t.Day_of_Week").alias("_dow"), col("f.Accident_Severity").alias("_sev"))
                .agg(F.count(F.lit(1)).alias("cnt")))
    return weekday_severities(long)


def weekday_severities(long: DataFrame) -> DataFrame:
    """Counts by ``_dow`` and ``_sev`` as a table."""
    long = (long.select(weekday_name(F.col("_dow")).alias("Day_of_Week"),
                        severity_label(F.col("_sev")).alias("Severity"), "cnt", "_dow")
                .filter(F.col("Day_of_Week").isNotNull()))
    wide = (long.groupBy("Day_of_Week", F.col("_dow").alias("day_order"))
                .pivot("Severity", ["Fatal", "Serious", "Slight"]).agg(F.sum("cnt"))
                .fillna(0, subset=["Fatal", "Serious", "Slight"]))
    return wide.orderBy("day_order")


def weekday_hour_matrix(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """V3: weekday (rows, Sunday first) x hour (columns) accident counts, 0 if absent."""
    long = (_on(fact.alias("f"), dim_time.filter(F.col("Hour").isNotNull()), "time_key", "t")
                .groupBy(col("t.Day_of_Week").alias("_dow"), col("t.Hour").alias("Hour"))
                .agg(F.count(F.lit(1)).alias("cnt")))
    return weekday_hours(long)


def weekday_hours(long: DataFrame) -> DataFrame:
    """Counts by ``_dow`` and ``Hour`` as a table."""
    long = (long.select(weekday_name(F.col("_dow")).alias("Day_of_Week"),
                        F.col("_dow").alias("day_order"), "Hour", "cnt")
                .filter(F.col("Day_of_Week").isNotNull()))
    # Kept (seven weekdays x at most 100 two-digit hours): the pivot looks for its hours there, not in the fact.
    long, _ = materialize(long, count=False)
    wide = long.groupBy("Day_of_Week", "day_order").pivot("Hour").agg(F.sum("cnt"))
    hour_cols = [c for c in wide.columns if c not in ("Day_of_Week", "day_order")]
    return wide.fillna(0, subset=hour_cols).orderBy("day_order")


def severity_share(fact: DataFrame) -> DataFrame:
    """Count and percentage share per severity code (labelled)."""
    return shares(fact.groupBy("Accident_Severity").agg(F.count(F.lit(1)).alias("cnt")))


def shares(counts: DataFrame) -> DataFrame:
    total = F.sum("cnt").over(Window.partitionBy())
    return counts.select(severity_label(F.col("Accident_Severity")).alias("Accident_Severity"),
                         "cnt", F.round(F.col("cnt") * 100.0 / total, 2).alias("pct"))


def hourly_rush(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Accidents per hour with the rush-hour flag."""
    return (_on(fact.alias("f"), dim_time.filter(F.col("Hour").isNotNull()), "time_key", "t")
                .groupBy(col("t.Hour").alias("Hour")).agg(F.count(F.lit(1)).alias("cnt"))
                .withColumn("is_rush", F.col("Hour").isin(*RUSH_HOURS))
                .orderBy("Hour"))


def yearly_trend(fact: DataFrame) -> DataFrame:
    """Accidents per year (null year included)."""
    return (fact.groupBy(F.col("Year_Derived").alias("yr")).agg(F.count(F.lit(1)).alias("cnt"))
                .orderBy("yr"))


def top_weather(fact: DataFrame, dim_env: DataFrame, top: int = TOP_WEATHER) -> DataFrame:
    """V4d: the ``top`` weather categories by accident count."""
    return (_on(fact.alias("f"), dim_env, "env_key", "e")
                .groupBy(col("e.Weather_Conditions").alias("weather"))
                .agg(F.count(F.lit(1)).alias("cnt"))
                .orderBy(F.col("cnt").desc(), "weather")
                .limit(top))


def year_scoped_totals(fact: DataFrame, year: int) -> DataFrame:
    """Accidents and casualties of one year; on a year-partitioned table the
    filter becomes a partition filter (only that folder is read)."""
    return (fact.filter(F.col("Year_Derived") == year)
                .groupBy("Year_Derived")
                .agg(F.count(F.lit(1)).alias("accidents"),
                     F.sum("Number_of_Casualties").alias("casualties")))
