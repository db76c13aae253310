"""A roll-up of the fact from which the questions and charts are answered.

The fact is read once: joined to its dimensions, and counted by the attributes
of each grain in one ``GROUPING SETS`` aggregate (combined map-side, so a hot
group is one row per task and grain). The result has a row per group, far fewer
than accidents, and is written with the star (``run_etl(..., rollup=True)``);
the answers then read its rows alone.

A question counts only accidents whose keys it could join. ``in_time``,
``in_geography``, ``in_road`` and ``in_environment`` say which keys have a
dimension row, and are part of the grains that need them. Means come from
``casualties`` and ``casualties_known``, sums that can be added up. An empty
fact has no rows here and every answer is empty.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.operators.small import broadcast_if_small
from roadlens.plans import questions as Q
from roadlens.schemas import DIMENSIONS, RUSH_HOURS, TOP_WEATHER
from roadlens.sources.tables import star_folder

ROLLUP = "rollup_accidents"

#: Grain -> the columns that it counts by.
GRAINS = {
    "month": ["in_time", "time_year", "time_month", "accident_year"],
    "weekday": ["in_time", "weekday", "hour", "severity"],
    "area": ["in_geography", "lsoa_known", "lsoa", "urban_rural"],
    "road_area": ["in_road", "in_geography", "road_type", "urban_rural"],
    "junction": ["in_road", "junction_control", "severity"],
    "conditions": ["in_road", "in_environment", "road_type", "speed_limit", "weather", "severity"],
}
ATTRIBUTES = {
    "dim_time": {"time_year": "Year_Derived", "time_month": "Month_Num", "weekday": "Day_of_Week", "hour": "Hour"},
    "dim_geography": {"lsoa": "LSOA_of_Accident_Location", "urban_rural": "Urban_or_Rural_Area", "lsoa_known": "lsoa_available"},
    "dim_road": {"road_type": "Road_Type", "speed_limit": "Speed_limit", "junction_control": "Junction_Control"},
    "dim_environment": {"weather": "Weather_Conditions"},
}


def build_rollup(fact: DataFrame, dims: dict[str, DataFrame], dim_bytes: dict[str, int] | None = None) -> DataFrame:
    """One row per grain and group: accidents, casualties, casualties_known."""
    wide = fact.select(*[key for _, key in DIMENSIONS.values()], "Number_of_Casualties",
                       F.col("Accident_Severity").alias("severity"), F.col("Year_Derived").alias("accident_year"))
    for name, (_, key) in DIMENSIONS.items():
        side = dims[name].select(key, F.lit(True).alias(f"in_{name.removeprefix('dim_')}"),
                                 *[F.col(c).alias(a) for a, c in ATTRIBUTES[name].items()])
        wide = wide.join(broadcast_if_small(side, (dim_bytes or {}).get(name)), key, "left")
    columns = list(dict.fromkeys(c for cols in GRAINS.values() for c in cols))
    grain = F.lit(None).cast("string")
    for name, cols in GRAINS.items():
        bits = sum(1 << len(columns) - 1 - i for i, c in enumerate(columns) if c not in cols)
        grain = F.when(F.grouping_id() == bits, name).otherwise(grain)
    return wide.groupingSets([[F.col(c) for c in cols] for cols in GRAINS.values()], *columns).agg(
        grain.alias("grain"), F.count(F.lit(1)).alias("accidents"),
        F.sum("Number_of_Casualties").alias("casualties"), F.count("Number_of_Casualties").alias("casualties_known"))


def read_rollup(spark: SparkSession, star_dir: str) -> DataFrame:
    """The roll-up that was published with the star."""
    return spark.read.parquet(os.path.join(star_folder(spark, star_dir), ROLLUP))


def _grain(rollup: DataFrame, name: str, *joined: str) -> DataFrame:
    """A grain's rows of which the keys had dimension rows."""
    rows = rollup.filter(F.col("grain") == name)
    for flag in joined:
        rows = rows.filter(F.col(flag))
    return rows


def _accidents(name: str):
    return F.sum("accidents").alias(name)


def _casualties():
    return F.sum("casualties").alias("total_casualties")


def _mean():
    return F.sum("casualties") / F.nullif(F.sum("casualties_known"), F.lit(0))


def monthly_rank(rollup: DataFrame) -> DataFrame:
    return Q.ranked_months(_grain(rollup, "month", "in_time")
                           .groupBy(F.col("time_year").alias("Year"), F.col("time_month").alias("Month"))
                           .agg(_accidents("accident_count")))


def road_area_vulnerability(rollup: DataFrame) -> DataFrame:
    return Q.ranked_areas(_grain(rollup, "road_area", "in_road", "in_geography")
                          .groupBy(F.col("road_type").alias("Road_Type"), F.col("urban_rural").alias("Urban_or_Rural_Area"))
                          .agg(_accidents("total_accidents"), _mean().alias("_avg")))


def area_hotspots(rollup: DataFrame) -> DataFrame:
    return Q.top_areas(_grain(rollup, "area", "in_geography", "lsoa_known")
                       .groupBy(F.col("lsoa").alias("LSOA"), F.col("urban_rural").alias("Urban_or_Rural_Area"))
                       .agg(_accidents("total_accidents"), _casualties(), F.round(_mean(), 2).alias("avg_casualties")))


def junction_severity(rollup: DataFrame) -> DataFrame:
    return (_grain(rollup, "junction", "in_road")
            .groupBy(F.col("junction_control").alias("Junction_Control"), F.col("severity").alias("Accident_Severity"))
            .agg(_accidents("accident_count"), _casualties(), F.round(_mean(), 2).alias("avg_casualties"))
            .orderBy("Junction_Control", F.col("accident_count").desc(), "Accident_Severity"))


def fatal_combinations(rollup: DataFrame) -> DataFrame:
    return Q.top_combinations(_grain(rollup, "conditions", "in_road", "in_environment").filter(F.col("severity") == 1)
                              .groupBy(F.col("road_type").alias("Road_Type"), F.col("speed_limit").alias("Speed_limit"),
                                       F.col("weather").alias("Weather_Conditions"))
                              .agg(_accidents("fatal_count"), _casualties()))


def severity_by_weekday(rollup: DataFrame) -> DataFrame:
    return Q.weekday_severities(_grain(rollup, "weekday", "in_time")
                                .groupBy(F.col("weekday").alias("_dow"), F.col("severity").alias("_sev")).agg(_accidents("cnt")))


def weekday_hour_matrix(rollup: DataFrame) -> DataFrame:
    return Q.weekday_hours(_grain(rollup, "weekday", "in_time").filter(F.col("hour").isNotNull())
                           .groupBy(F.col("weekday").alias("_dow"), F.col("hour").alias("Hour")).agg(_accidents("cnt")))


def severity_share(rollup: DataFrame) -> DataFrame:
    return Q.shares(_grain(rollup, "weekday").groupBy(F.col("severity").alias("Accident_Severity")).agg(_accidents("cnt")))


def hourly_rush(rollup: DataFrame) -> DataFrame:
    return (_grain(rollup, "weekday", "in_time").filter(F.col("hour").isNotNull())
            .groupBy(F.col("hour").alias("Hour")).agg(_accidents("cnt"))
            .withColumn("is_rush", F.col("Hour").isin(*RUSH_HOURS)).orderBy("Hour"))


def yearly_trend(rollup: DataFrame) -> DataFrame:
    return _grain(rollup, "month").groupBy(F.col("accident_year").alias("yr")).agg(_accidents("cnt")).orderBy("yr")


def top_weather(rollup: DataFrame, top: int = TOP_WEATHER) -> DataFrame:
    return (_grain(rollup, "conditions", "in_environment").groupBy(F.col("weather").alias("weather")).agg(_accidents("cnt"))
            .orderBy(F.col("cnt").desc(), "weather").limit(top))


#: The question's registered name -> its answer from the roll-up.
ANSWERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "bq1_monthly_rank": monthly_rank,
    "bq2_road_vulnerability": road_area_vulnerability,
    "bq3_hotspots": area_hotspots,
    "bq4_junction_severity": junction_severity,
    "bq5_fatal_combos": fatal_combinations,
    "month_series": lambda rollup: Q.month_series(monthly_rank(rollup)),
    "severity_by_weekday": severity_by_weekday,
    "weekday_hour_matrix": weekday_hour_matrix,
    "severity_share": severity_share,
    "hourly_rush": hourly_rush,
    "yearly_trend": yearly_trend,
    "top_weather": top_weather,
}
