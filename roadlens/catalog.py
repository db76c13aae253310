"""Named queries over the driver tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Every entry reads the scale-factor tables (through the raw accident fixture)
and runs its operator over all rows. Results are lazy except where an
operator materialises a small intermediate on purpose (dimension keys,
size-checked broadcast sides) or a query exercises a file format (the CSV
and Parquet round trips write to the shared scratch folder first).
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.fixture import raw_accidents, secondary_source, source_files
from roadlens.operators import checks, clean as C, profile as P
from roadlens.operators.dedup import dedup_counts
from roadlens.operators.small import broadcast_if_small
from roadlens.operators.star import Star, build_star
from roadlens.plans import questions as Q, rollup
from roadlens.plans.etl import run_etl
from roadlens.schemas import DIMENSIONS, FACT_PARTITION_COL, KEY_COL, SOURCE_ORDER_COL
from roadlens.session import remove_folder, scratch_path
from roadlens.sources import landing
from roadlens.sources.csv import load_report, read_accident_csvs, write_csv
from roadlens.sources.sinks import write_table
from roadlens.sources.tables import read_star, register_star

INGEST_DATE = dt.date(2026, 4, 1)
PRUNED_YEAR = 1996


class Stages:
    """Lazily built stages for one (session, scale-factor folder)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return raw_accidents(self.spark, self.sf_dir)

    @cached_property
    def profiled(self) -> DataFrame:
        return P.profiled(self.raw)

    @cached_property
    def dedup(self) -> DataFrame:
        return C.dedup_accidents(self.raw)

    @cached_property
    def clean(self) -> DataFrame:
        return C.clean_all(self.raw)

    @cached_property
    def star(self) -> Star:
        return build_star(self.clean)

    @cached_property
    def star_nullsafe(self) -> Star:
        return build_star(self.clean, null_safe=True)

    def dim(self, name: str, star: Star | None = None) -> DataFrame:
        """A dimension for joining: broadcast when its measured bytes allow
        (the lazily built dimensions carry no size statistics of their own)."""
        s = star or self.star
        return broadcast_if_small(s.dims[name], s.dim_bytes[name])

    @property
    def fact(self) -> DataFrame:
        return self.star.fact

    @cached_property
    def rollup(self) -> DataFrame:
        return rollup.build_rollup(self.fact, self.star.dims, self.star.dim_bytes)

    def tables(self) -> dict[str, DataFrame]:
        return {"fact_accidents": self.fact, **self.star.dims}

    def land(self) -> dict[str, str]:
        root = scratch_path(self.spark, "landing")
        return landing.land_sources(source_files(self.raw), root, INGEST_DATE)


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Stages(spark, sf_dir))
        return fn
    return register


def _key_and(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(KEY_COL, *cols)


# ----------------------------------------------------------------- sources
@query("raw_union")
def _raw_union(p: Stages) -> DataFrame:
    """The three source files unioned by name (missing column -> null)."""
    parts = list(source_files(p.raw).values())
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


@query("csv_roundtrip")
def _csv_roundtrip(p: Stages) -> DataFrame:
    """Land the files as CSV, read them back with header-driven schemas."""
    return landing.read_landed(p.spark, p.land()).drop("year", "month", "source_file")


@query("clean_from_csv")
def _clean_from_csv(p: Stages) -> DataFrame:
    """S1/S2/S9 + C12: land the source files as CSV, read them back with their
    file and line positions, clean. Equals the cleaned table from the source tables."""
    paths = list(p.land().values())
    return C.clean_all(read_accident_csvs(p.spark, paths))


@query("landing_roundtrip")
def _landing_roundtrip(p: Stages) -> DataFrame:
    """Rows per dated landing partition and source file."""
    return (landing.read_landed(p.spark, p.land())
                   .groupBy("year", "month", "source_file").agg(F.count(F.lit(1)).alias("rows")))


@query("csv_glob_union")
def _csv_glob(p: Stages) -> DataFrame:
    """All landed files by one glob, whatever their headers."""
    folder = os.path.dirname(next(iter(p.land().values())))
    return read_accident_csvs(p.spark, [os.path.join(folder, "source_file=*")], source_col=None)


@query("csv_folder_mixed_headers")
def _csv_mixed(p: Stages) -> DataFrame:
    """Files of one folder with the same columns in two orders, one of them of no known type."""
    cols = [KEY_COL, SOURCE_ORDER_COL, "Accident_Severity", "Speed_limit", "severity_x_ten"]
    raw = p.raw.withColumn("severity_x_ten", F.col("Accident_Severity") * F.lit(10).cast("bigint"))
    root = scratch_path(p.spark, "mixed")
    for part, order in enumerate([cols, cols[::-1]]):
        write_csv(raw.filter(F.col("Number_of_Vehicles") % 2 == part).select(*order), os.path.join(root, str(part)))
    return read_accident_csvs(p.spark, [os.path.join(root, "*")], source_col=None)


@query("csv_corrupt_counts")
def _csv_corrupt(p: Stages) -> DataFrame:
    """Records and those that do not fit the schema (a word where a speed limit belongs)."""
    odd = F.when(F.col("Speed_limit") == 30, F.lit("fast")).otherwise(F.col("Speed_limit").cast("string"))
    path = write_csv(p.raw.withColumn("Speed_limit", odd), scratch_path(p.spark, "corrupt"))
    return load_report(p.spark, [path]).agg(*[F.sum(c).alias(c) for c in ("records", "corrupt", "blank")])


@query("file_report")
def _file_report(p: Stages) -> DataFrame:
    """S3: per landed file: rows and columns (parts and sizes depend on the run)."""
    base = os.path.dirname(next(iter(p.land().values())))
    return landing.landed_report(p.spark, base).select("source_file", "columns", "rows")


@query("file_checks")
def _file_checks(p: Stages) -> DataFrame:
    """Per landed file: data rows, UTF-8 validity."""
    base = os.path.dirname(next(iter(p.land().values())))
    return landing.landed_report(p.spark, base).select("source_file", "rows", "valid_utf8")


@query("landed_sizes")
def _landed_sizes(p: Stages) -> DataFrame:
    """MB of the records of landed files (headers depend on the number of part files), from the manifest."""
    texts = [KEY_COL, "Date", "Time", "Road_Type", "Weather_Conditions"]
    root = scratch_path(p.spark, "landing")
    folders = landing.land_sources({name: df.select(*texts) for name, df in source_files(p.raw).items()}, root, INGEST_DATE)
    base = os.path.dirname(next(iter(folders.values())))
    return landing.landed_report(p.spark, base).select("source_file", "rows", "data_mb")


@query("secondary_csv_types")
def _secondary_csv(p: Stages) -> DataFrame:
    """The secondary source as a CSV file, read back with the types its
    values have by the manifest: per column its type and its values."""
    folders = landing.land_sources({"traffic_flow.csv": secondary_source(p.spark, p.sf_dir)}, scratch_path(p.spark, "secondary"), INGEST_DATE)
    df = landing.read_landed(p.spark, folders, typed=True).drop("year", "month", "source_file")
    return P.schema_report(df).select("column_name", "data_type", "non_null")


@query("secondary_source_totals")
def _secondary(p: Stages) -> DataFrame:
    """Both sources' sizes and the grand total."""
    aadf = secondary_source(p.spark, p.sf_dir)
    n_aadf = aadf.agg(F.count(F.lit(1))).scalar()
    return (p.profiled.agg(F.count(F.lit(1)).alias("accident_rows"))
             .select("accident_rows", n_aadf.alias("traffic_flow_rows"),
                     F.lit(len(aadf.columns)).alias("traffic_flow_columns"),
                     (F.col("accident_rows") + n_aadf).alias("grand_total")))


@query("star_parquet_roundtrip")
def _star_roundtrip(p: Stages) -> DataFrame:
    """Write the star (fact partitioned by year), read it back, count."""
    root = scratch_path(p.spark, "star")
    for name, df in p.tables().items():
        write_table(df, os.path.join(root, name),
                    FACT_PARTITION_COL if name == "fact_accidents" else None)
    back = read_star(p.spark, root)
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
              for name, df in back.items()]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out


@query("year_pruned_count")
def _year_pruned(p: Stages) -> DataFrame:
    """A year-scoped query on the year-partitioned fact (partition filter)."""
    path = write_table(p.fact, scratch_path(p.spark, "fact"), FACT_PARTITION_COL)
    return Q.year_scoped_totals(p.spark.read.parquet(path), PRUNED_YEAR)


@query("views_road_vehicles")
def _views(p: Stages) -> DataFrame:
    """SQL over the star's session views."""
    register_star(p.spark, p.tables())
    return p.spark.sql("""
        SELECT road.Road_Type, SUM(acc.Number_of_Vehicles) AS vehicles
        FROM dim_road road, fact_accidents acc
        WHERE acc.road_key = road.road_key AND acc.Number_of_Casualties >= 3
        GROUP BY ALL""")


@query("dynamic_overwrite_totals")
def _dynamic(p: Stages) -> DataFrame:
    """One year written again replaces its own partition and no other."""
    path = write_table(p.fact, scratch_path(p.spark, "fact"), FACT_PARTITION_COL)
    again = p.fact.filter(F.col(FACT_PARTITION_COL) == PRUNED_YEAR)
    write_table(again.withColumn("Number_of_Casualties", F.col("Number_of_Casualties") + 1), path,
                FACT_PARTITION_COL, dynamic_overwrite=True)
    return (p.spark.read.parquet(path).groupBy(FACT_PARTITION_COL)
             .agg(F.count(F.lit(1)).alias("accidents"), F.sum("Number_of_Casualties").alias("casualties")))


@query("hashed_keys_roads")
def _hashed(p: Stages) -> DataFrame:
    """With hashed keys every accident finds its own road attributes again."""
    star = build_star(p.clean, keys="hash", null_safe=True)
    cols, key = DIMENSIONS["dim_road"]
    return star.fact.join(p.dim("dim_road", star), key).select(KEY_COL, *cols)


# ------------------------------------------------------------------- dedup
@query("dedup_accidents")
def _dedup(p: Stages) -> DataFrame:
    return p.dedup


@query("dedup_mostly_unique")
def _dedup_mostly_unique(p: Stages) -> DataFrame:
    """The same rows with only those of repeated keys shuffled."""
    return C.dedup_accidents(p.raw, mostly_unique=True)


@query("dedup_summary")
def _dedup_summary(p: Stages) -> DataFrame:
    return dedup_counts(p.raw, KEY_COL)


# ---------------------------------------------------------------- cleaning
@query("clean_calendar")
def _clean_calendar(p: Stages) -> DataFrame:
    return _key_and(C.add_calendar(p.dedup), "Date", "Date_Parsed", "Year_Derived", "Month_Num",
                    "Quarter_Num", "Day_Num", "DayOfWeek_Num")


@query("clean_hour")
def _clean_hour(p: Stages) -> DataFrame:
    return _key_and(C.add_hour(p.dedup), "Time", "Hour")


@query("clean_hour_strict")
def _clean_hour_strict(p: Stages) -> DataFrame:
    return _key_and(C.add_hour(p.dedup, strict=True), "Time", "Hour")


@query("clean_period_weekend")
def _clean_period(p: Stages) -> DataFrame:
    df = p.dedup.transform(C.add_calendar).transform(C.add_hour).transform(C.add_period_weekend)
    return _key_and(df, "Hour", "DayOfWeek_Num", "time_period", "is_weekend")


@query("clean_junction")
def _clean_junction(p: Stages) -> DataFrame:
    return _key_and(C.fill_junction_control(p.dedup), "Junction_Control")


@query("clean_second_road")
def _clean_second_road(p: Stages) -> DataFrame:
    return _key_and(C.fill_second_road(p.dedup), "2nd_Road_Class", "2nd_Road_Number")


@query("clean_hazards")
def _clean_hazards(p: Stages) -> DataFrame:
    return _key_and(C.clean_hazards(p.dedup), "Carriageway_Hazards")


@query("clean_weather")
def _clean_weather(p: Stages) -> DataFrame:
    return _key_and(C.consolidate_weather(p.dedup), "Weather_Conditions")


@query("clean_flags")
def _clean_flags(p: Stages) -> DataFrame:
    df = C.add_coordinate_flag(C.add_lsoa_flag(p.dedup))
    return _key_and(df, "lsoa_available", "is_coordinate_valid")


@query("clean_unknowns")
def _clean_unknowns(p: Stages) -> DataFrame:
    return _key_and(C.fill_unknowns(p.dedup), "Junction_Detail", "Light_Conditions",
                    "Road_Surface_Conditions", "Weather_Conditions", "Road_Type", "Urban_or_Rural_Area")


@query("coordinate_bounds")
def _coordinate_bounds(p: Stages) -> DataFrame:
    return _key_and(C.add_coordinate_flag(p.dedup, strict=True), "Latitude", "Longitude",
                    "is_coordinate_valid")


@query("impute_speed_median")
def _impute_speed(p: Stages) -> DataFrame:
    return _key_and(C.impute_speed_limit(p.clean), "Road_Type", "Speed_limit")


@query("clean_all")
def _clean_all(p: Stages) -> DataFrame:
    return p.clean


# ------------------------------------------------------------------- star
def _dim_query(name: str):
    @query(name)
    def _q(p: Stages) -> DataFrame:
        return p.star.dims[name]
    return _q


for _name in DIMENSIONS:
    _dim_query(_name)


@query("fact_accidents")
def _fact(p: Stages) -> DataFrame:
    return p.fact


@query("fact_nullsafe")
def _fact_nullsafe(p: Stages) -> DataFrame:
    return p.star_nullsafe.fact


@query("validate_star")
def _validate(p: Stages) -> DataFrame:
    return checks.validate_tables(p.tables())


@query("integrity_star")
def _integrity(p: Stages) -> DataFrame:
    return checks.integrity(p.fact, p.star.dims, p.star.dim_bytes)


@query("etl_summary")
def _etl_summary(p: Stages) -> DataFrame:
    """M8/M9: the staged run; its rows were counted while they were written."""
    out = scratch_path(p.spark, "etl")
    run = run_etl(p.spark, p.raw, out)
    remove_folder(p.spark, out)
    return p.spark.createDataFrame([(run.raw_rows, run.clean_rows, run.fact_rows)],
                                   "raw_rows bigint, clean_rows bigint, fact_rows bigint")


# -------------------------------------------------------------- questions
@query("bq1_monthly_rank")
def _bq1(p: Stages) -> DataFrame:
    return Q.monthly_rank(p.fact, p.dim("dim_time"))


@query("bq1_nullsafe")
def _bq1_nullsafe(p: Stages) -> DataFrame:
    s = p.star_nullsafe
    return Q.monthly_rank(s.fact, p.dim("dim_time", s))


@query("bq2_road_vulnerability")
def _bq2(p: Stages) -> DataFrame:
    return Q.road_area_vulnerability(p.fact, p.dim("dim_road"), p.dim("dim_geography"))


@query("bq3_hotspots")
def _bq3(p: Stages) -> DataFrame:
    return Q.area_hotspots(p.fact, p.dim("dim_geography"))


@query("bq4_junction_severity")
def _bq4(p: Stages) -> DataFrame:
    return Q.junction_severity(p.fact, p.dim("dim_road"))


@query("bq5_fatal_combos")
def _bq5(p: Stages) -> DataFrame:
    return Q.fatal_combinations(p.fact, p.dim("dim_road"), p.dim("dim_environment"))


@query("fatal_combos_all")
def _v5(p: Stages) -> DataFrame:
    return Q.fatal_combinations_plan(p.fact, p.dim("dim_road"), p.dim("dim_environment"))


@query("month_series")
def _v1(p: Stages) -> DataFrame:
    return Q.month_series(Q.monthly_rank(p.fact, p.dim("dim_time")))


@query("severity_by_weekday")
def _v2(p: Stages) -> DataFrame:
    return Q.severity_by_weekday(p.fact, p.dim("dim_time"))


@query("weekday_hour_matrix")
def _v3(p: Stages) -> DataFrame:
    return Q.weekday_hour_matrix(p.fact, p.dim("dim_time"))


@query("severity_share")
def _v4a(p: Stages) -> DataFrame:
    return Q.severity_share(p.fact)


@query("hourly_rush")
def _v4b(p: Stages) -> DataFrame:
    return Q.hourly_rush(p.fact, p.dim("dim_time"))


@query("yearly_trend")
def _v4c(p: Stages) -> DataFrame:
    return Q.yearly_trend(p.fact)


@query("top_weather")
def _v4d(p: Stages) -> DataFrame:
    return Q.top_weather(p.fact, p.dim("dim_environment"))


@query("validate_published")
def _validate_published(p: Stages) -> DataFrame:
    """M6 over the published star, from the footers of its files."""
    out = scratch_path(p.spark, "validated")
    result = run_etl(p.spark, p.raw, out).validation
    remove_folder(p.spark, out)
    return result


def _rollup_query(name: str):
    @query(f"rollup_{name}")
    def _q(p: Stages) -> DataFrame:
        return rollup.ANSWERS[name](p.rollup)
    return _q


for _name in rollup.ANSWERS:
    _rollup_query(_name)


# -------------------------------------------------------------- profiling
_PROFILES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "profile_missing": P.missing_report,
    "profile_numeric": P.numeric_summary,
    "dist_severity": P.severity_distribution,
    "dist_speed": P.speed_distribution,
    "speed_invalid": P.speed_invalid,
    "dist_casualties": P.casualty_histogram,
    "casualty_stats": P.casualty_stats,
    "casualty_box": P.box_stats,
    "dist_hour": P.hour_distribution,
    "peak_hour": P.peak_hour,
    "dist_weekday": P.weekday_distribution,
    "duplicate_report": P.duplicate_report,
    "worst_keys": P.worst_keys,
    "iqr_outliers": P.iqr_outliers,
    "format_checks": P.format_checks,
    "whitespace_report": P.whitespace_report,
}


def _profile_query(name: str, fn: Callable[[DataFrame], DataFrame]):
    @query(name)
    def _q(p: Stages) -> DataFrame:
        return fn(p.profiled)
    return _q


for _name, _fn in _PROFILES.items():
    _profile_query(_name, _fn)


@query("profile_schema")
def _schema(p: Stages) -> DataFrame:
    """D1 with the first value of each column in source order."""
    return P.schema_report(p.raw, order=(SOURCE_ORDER_COL, KEY_COL))


@query("profile_secondary_schema")
def _secondary_schema(p: Stages) -> DataFrame:
    return P.schema_report(secondary_source(p.spark, p.sf_dir))


@query("final_stats")
def _final_stats(p: Stages) -> DataFrame:
    return P.final_statistics(p.profiled, secondary_source(p.spark, p.sf_dir))


