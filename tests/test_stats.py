"""Exact distributed quantiles against numpy's linear interpolation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.operators import quantiles as Q

QS = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("n,leaf", [(1, 4), (2, 4), (7, 3), (2000, 6)])
def test_matches_numpy(spark, n, leaf):
    rng = random.Random(n)
    vals = [round(rng.gauss(50, 10), 3) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals + [None]], "x double")
    got = Q.column_quantiles(df, "x", QS, leaf=leaf)
    assert got == pytest.approx(list(np.quantile(vals, QS)), abs=1e-9)


def test_hot_value_and_empty(spark):
    vals = [7.5] * 3000 + [float(i) for i in range(6000)]  # one value holds a third of the rows
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert Q.column_quantiles(df, "x", QS, leaf=100) == pytest.approx(list(np.quantile(vals, QS)))
    empty = spark.createDataFrame([(None,)], "x double")
    assert Q.column_quantiles(empty, "x", [0.5]) == [None]


def test_histogram_without_bins_when_cap_below_one(spark):
    from roadlens.operators.profile import casualty_histogram

    df = spark.createDataFrame([(0,), (0,), (0,)], "Number_of_Casualties int")
    assert casualty_histogram(df).count() == 0
    df2 = spark.createDataFrame([(1,), (3,), (3,)], "Number_of_Casualties int")
    assert [tuple(r) for r in casualty_histogram(df2).collect()] == [(1, 1), (2, 0), (3, 2)]


def test_numeric_summary_has_one_path_for_wide_and_narrow_columns(spark):
    from roadlens.operators.profile import numeric_summary
    from roadlens.plans.explain import plan_text

    n = 30_001  # more distinct values than one window may sort
    df = spark.range(n).select((F.col("id") * 1.5).alias("x"), (F.col("id") * 7).alias("wide"),
                               (F.col("id") % 3).cast("int").alias("k"))
    out = numeric_summary(df)
    assert "percentile" not in plan_text(out, "simple")
    assert {r.column_name: r.median for r in out.collect()} == {"x": 22500.0, "wide": 105000.0, "k": 1.0}


def test_profiles_scan_once(spark, sf_small):
    """Value counts are kept: what follows them no longer reads the files."""
    from roadlens.catalog import QUERIES
    from roadlens.plans.explain import plan_text

    for name in ["dist_casualties", "casualty_stats", "casualty_box", "iqr_outliers"]:
        assert "FileScan parquet" not in plan_text(QUERIES[name](spark, sf_small), "simple"), name
    # the raw relation is orders JOIN customer, unioned with its duplicate copies: 2 x 2 scans
    assert plan_text(QUERIES["dist_severity"](spark, sf_small), "simple").count("FileScan parquet") <= 4


def test_bracket_that_misses_is_widened(spark, monkeypatch):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("x"))
    scans = []
    monkeypatch.setattr(Q, "second_scan", lambda *a, real=Q.second_scan, **b: scans.append(1) or real(*a, **b))
    want = pytest.approx(list(np.quantile(range(20_000), QS)))
    assert Q.column_quantiles(df, "x", QS, k=64, margin=0.0001) == want and len(scans) > 1
    scans.clear()
    assert Q.column_quantiles(df, "x", QS) == want and len(scans) == 1


def test_second_scan_keeps_a_small_share_of_a_wide_column(spark):
    n = 200_000
    df = spark.range(0, n, 1, 8).select((F.hash("id") * 1.25).alias("x"), (F.col("id") % 7).alias("k"))
    first = Q.first_scan(df, ["x", "k"])
    found = Q.quantiles(df, first, {"x": [0.5], "k": [0.5]})
    assert found.second.table.count() < 0.03 * n
    x = df.toPandas()
    assert found["x", 0.5] == x.x.median() and found["k", 0.5] == 3.0
    m = first.columns["x"]
    assert (m.n, m.low, m.high) == (n, x.x.min(), x.x.max()) and [m.mean, m.std] == pytest.approx([x.x.mean(), x.x.std()])


def test_no_value_nan_and_one_value(spark):
    from roadlens.operators.profile import box_stats, casualty_histogram, casualty_stats, iqr_outliers, numeric_summary

    df = spark.createDataFrame([(float("nan"), None, 4.0), (2.0, None, None), (3.0, None, None), (None, None, None)], "a double, b int, c double")
    got = {r.column_name: r for r in numeric_summary(df).collect()}
    assert (got["a"]["count"], got["a"]["median"], got["a"]["max"]) == (2, 2.5, 3.0)
    assert (got["b"]["count"], got["b"]["median"], got["b"]["std"]) == (0, None, None) and (got["c"]["median"], got["c"]["std"]) == (4.0, None)
    none = df.select(F.col("b").alias("Number_of_Casualties"))
    assert box_stats(none).first().median is None and box_stats(none).first().fliers == 0
    assert casualty_histogram(none).count() == 0 and casualty_stats(none).first().extreme_pct is None
    assert iqr_outliers(none).first().outliers == 0
    assert numeric_summary(df.limit(0)).count() == 3


@pytest.mark.parametrize("n", [1, 2, 5, 40, 3000])
def test_fences_as_numpy(spark, n):
    rng = random.Random(n)
    vals = [round(rng.gauss(0, 1) ** 3, 2) for _ in range(n)] + [1.5] * (n // 3)
    f = Q.fences(spark.createDataFrame([(v,) for v in vals], "x double"), ["x"], 1.5)[1]["x"]
    q1, q2, q3 = np.quantile(vals, [0.25, 0.5, 0.75])
    lo, hi = q1 - (q3 - q1) * 1.5, q3 + (q3 - q1) * 1.5
    inside = [v for v in vals if lo <= v <= hi]
    assert [f.q1, f.median, f.q3] == pytest.approx([q1, q2, q3])
    assert (f.outside, f.whisker_low, f.whisker_high) == (len(vals) - len(inside), min(inside), max(inside))
