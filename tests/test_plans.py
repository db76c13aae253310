"""Physical-plan properties the design relies on (V5 and friends)."""

import os

from pyspark.sql import functions as F

from roadlens.catalog import Stages
from roadlens.plans import questions as Q
from roadlens.plans.explain import (join_strategies, partition_filters, plan_text, pushed_filters,
                                    uses_python)
from roadlens.session import scratch_path
from roadlens.sources.sinks import write_table
from roadlens.sources.tables import read_star


def _written_star(spark, sf_small):
    p = Stages(spark, sf_small)
    root = scratch_path(spark, "plan-test")
    for name, df in p.tables().items():
        write_table(df, os.path.join(root, name), "Year_Derived" if name == "fact_accidents" else None)
    return read_star(spark, root)


def test_fatal_combo_plan_broadcasts_and_pushes_filter(spark, sf_small):
    star = _written_star(spark, sf_small)
    df = Q.fatal_combinations_plan(star["fact_accidents"], star["dim_road"], star["dim_environment"])
    joins = join_strategies(df)
    assert joins and set(joins) == {"BroadcastHashJoin"}
    assert any("Accident_Severity" in f for f in pushed_filters(df))
    assert not uses_python(df)


def test_year_filter_prunes_partitions(spark, sf_small):
    star = _written_star(spark, sf_small)
    df = Q.year_scoped_totals(star["fact_accidents"], 1996)
    assert any("Year_Derived" in f for f in partition_filters(df))
    # only the needed columns are read
    text = plan_text(df)
    assert "ReadSchema: struct<Number_of_Casualties:int>" in text


def test_fact_build_broadcasts_dimensions(spark, sf_small):
    p = Stages(spark, sf_small)
    joins = join_strategies(p.fact)
    assert joins.count("BroadcastHashJoin") >= 4
    assert "SortMergeJoin" not in joins


def test_profile_is_one_scan(spark, sf_small):
    from roadlens.operators import profile as P

    p = Stages(spark, sf_small)
    text = plan_text(P.missing_report(p.profiled), "simple")
    # the raw relation is orders JOIN customer, unioned with its duplicate copies: 2 x 2 scans
    assert text.count("FileScan parquet") <= 4
    assert not uses_python(P.numeric_summary(p.profiled))


def test_no_cross_joins_in_catalog_plans(spark, sf_small):
    from roadlens.catalog import QUERIES

    for name in ["duplicate_report", "iqr_outliers", "casualty_box", "final_stats", "secondary_source_totals"]:
        df = QUERIES[name](spark, sf_small)
        assert not any(j in ("CartesianProduct", "BroadcastNestedLoopJoin") for j in join_strategies(df)), name


def test_bq1_window_runs_after_aggregation(spark, sf_small):
    star = _written_star(spark, sf_small)
    df = Q.monthly_rank(star["fact_accidents"], star["dim_time"])
    text = plan_text(df, "simple")
    assert text.index("Window") < text.index("HashAggregate")  # window above the aggregate
    assert df.filter(F.col("month_rank_in_year") == 1).count() >= 1


def test_star_answers_sql_over_registered_views(spark, sf_small):
    """Users of the published pipeline query the star with SQL over session
    views; the written tables answer that SQL like the DataFrame questions."""
    from roadlens.sources.tables import register_star

    star = _written_star(spark, sf_small)
    assert register_star(spark, star) == sorted(star)
    heavy = spark.sql("""
        SELECT road.Road_Type AS kind, SUM(acc.Number_of_Vehicles) AS vehicles
        FROM dim_road road, fact_accidents acc
        WHERE acc.road_key = road.road_key AND acc.Number_of_Casualties >= 3
        GROUP BY ALL""")
    fact, road = star["fact_accidents"], star["dim_road"]
    want = (fact.filter("Number_of_Casualties >= 3").join(road, "road_key")
                .groupBy(F.col("Road_Type").alias("kind")).agg(F.sum("Number_of_Vehicles").alias("vehicles")))
    assert heavy.count() > 1
    assert sorted(map(str, heavy.collect())) == sorted(map(str, want.collect()))
