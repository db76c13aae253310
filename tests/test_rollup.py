"""The roll-up that answers the questions, and validation from footers."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roadlens.fixture import raw_accidents
from roadlens.operators.checks import footer_counts, validate_folder, validate_tables
from roadlens.operators.star import Star
from roadlens.plans import questions as Q, rollup
from roadlens.plans.etl import run_etl
from roadlens.session import scratch_path
from roadlens.sources.tables import read_star, star_folder

FACT = "time_key long, geo_key long, road_key long, env_key long, Number_of_Casualties int, Accident_Severity int, Year_Derived int"


@pytest.fixture(scope="module")
def published(spark, sf_small):
    out = scratch_path(spark, "rollup-test")
    return out, run_etl(spark, raw_accidents(spark, sf_small), out, rollup=True)


@pytest.fixture(scope="module")
def small(spark):
    """Null keys, keys without a dimension row, null casualties, a null severity, a null year."""
    dims = {
        "dim_time": spark.createDataFrame([(1, 2001, 1, 2, 8), (2, 2001, 2, 1, None)], "time_key long, Year_Derived int, Month_Num int, Day_of_Week int, Hour int"),
        "dim_geography": spark.createDataFrame([(1, "E1", "Urban", True), (2, None, "Rural", False)],
                                               "geo_key long, LSOA_of_Accident_Location string, Urban_or_Rural_Area string, lsoa_available boolean"),
        "dim_road": spark.createDataFrame([(1, "Single", 30, "Stop"), (2, None, None, None)], "road_key long, Road_Type string, Speed_limit int, Junction_Control string"),
        "dim_environment": spark.createDataFrame([(1, "Fine"), (2, "Rain")], "env_key long, Weather_Conditions string"),
    }
    fact = spark.createDataFrame([
        (1, 1, 1, 1, 2, 1, 2001), (1, 1, 1, 2, None, 1, 2001), (2, 2, 2, 2, 5, 3, 2001), (None, 1, None, 1, 1, 2, None),
        (9, 9, 9, 9, 7, None, 2002), (None, None, None, None, None, 3, None), (2, 1, 2, None, 4, 2, 2001)], FACT)
    return Star(dims, {}, {}, fact)


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_answers_are_those_over_the_fact(small):
    rolled, f, d = rollup.build_rollup(small.fact, small.dims), small.fact, small.dims
    assert _rows(rollup.monthly_rank(rolled)) == _rows(Q.monthly_rank(f, d["dim_time"]))
    assert _rows(rollup.area_hotspots(rolled)) == _rows(Q.area_hotspots(f, d["dim_geography"]))
    assert _rows(rollup.junction_severity(rolled)) == _rows(Q.junction_severity(f, d["dim_road"]))
    assert _rows(rollup.severity_by_weekday(rolled)) == _rows(Q.severity_by_weekday(f, d["dim_time"]))
    assert _rows(rollup.weekday_hour_matrix(rolled)) == _rows(Q.weekday_hour_matrix(f, d["dim_time"]))
    assert sorted(_rows(rollup.severity_share(rolled))) == sorted(_rows(Q.severity_share(f)))
    assert _rows(rollup.hourly_rush(rolled)) == _rows(Q.hourly_rush(f, d["dim_time"]))
    assert _rows(rollup.yearly_trend(rolled)) == _rows(Q.yearly_trend(f))
    assert _rows(rollup.top_weather(rolled)) == _rows(Q.top_weather(f, d["dim_environment"]))


def test_limits_and_means_are_those_over_the_fact(small, spark):
    """Enough rows to pass the questions' least counts."""
    many = small.fact.crossJoin(spark.range(1200).select()).repartition(3)
    rolled, d = rollup.build_rollup(many, small.dims), small.dims
    assert len(_rows(rollup.road_area_vulnerability(rolled))) > 1
    assert _rows(rollup.road_area_vulnerability(rolled)) == _rows(Q.road_area_vulnerability(many, d["dim_road"], d["dim_geography"]))
    assert _rows(rollup.fatal_combinations(rolled)) == _rows(Q.fatal_combinations(many, d["dim_road"], d["dim_environment"])) != []


def test_rows_of_a_grain_count_every_accident(small):
    rolled = rollup.build_rollup(small.fact, small.dims)
    totals = {r.grain: r.n for r in rolled.groupBy("grain").agg(F.sum("accidents").alias("n")).collect()}
    assert totals == dict.fromkeys(rollup.GRAINS, small.fact.count())
    empty = rollup.build_rollup(small.fact.limit(0), small.dims)
    assert empty.count() == 0 and rollup.yearly_trend(empty).count() == 0 and rollup.weekday_hour_matrix(empty).count() == 0


def test_the_fact_is_read_once(spark, published):
    star = read_star(spark, published[0])
    plan = rollup.build_rollup(star["fact_accidents"], star)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Accident_Severity") and plan.count("Relation [") == 5  # the fact and four dimensions
    answer = rollup.ANSWERS["bq1_monthly_rank"](rollup.read_rollup(spark, published[0]))
    assert all(rollup.ROLLUP in x for x in answer.inputFiles())
    assert _rows(answer) == _rows(Q.monthly_rank(star["fact_accidents"], star["dim_time"]))


def test_validation_reads_footers_only(spark, published):
    folder = star_folder(spark, published[0])
    plan = footer_counts(spark, os.path.join(folder, "fact_accidents"), ["geo_key"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(geo_key)]" in plan and "ReadSchema: struct<count(*):bigint,count(geo_key):bigint>" in plan
    star = read_star(spark, published[0])
    assert sorted(_rows(validate_folder(spark, folder))) == sorted(_rows(validate_tables(star)))
    assert sorted(_rows(published[1].validation)) == sorted(_rows(validate_tables(star)))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_a_footer_without_counts_is_scanned(spark, tmp_path):
    os.makedirs(tmp_path / "t")
    pq.write_table(pa.table({"k": [1, None, 3]}), tmp_path / "t/a.parquet", write_statistics=False)
    assert _rows(validate_folder(spark, str(tmp_path), {"t": ["k"]})) == [("t", "k", 3, 1, False)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        validate_folder(spark, str(tmp_path), {"absent": ["k"]})
