"""Rows that may repeat are found by a filter; whatever it lets through, results stay exact."""

import pytest
from pyspark.sql import functions as F

from roadlens.operators.dedup import keep_first
from roadlens.operators.profile import duplicate_report
from roadlens.operators.repeats import flag_repeats, keep_first_of_repeats, repeat_filter
from roadlens.plans.explain import plan_text


def _rows(spark, n=6_000):
    # a third of the rows share a key, some keys are null, the others occur once or twice
    key = (F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 1_000 == 1, F.lit(None))
           .otherwise(F.concat(F.lit("K"), (F.col("id") - F.when(F.col("id") % 50 == 2, 1).otherwise(0)).cast("string"))))
    return (spark.range(n).repartition(5)
                 .select(key.alias("key"), (F.col("id") % 5).cast("int").alias("src"),
                         F.when(F.col("id") % 7 != 0, F.col("id") / 2).alias("2nd_value"),
                         F.lit("x").alias("_word")))


@pytest.mark.parametrize("bits", [1 << 24, 64])
def test_same_rows_as_keep_first(spark, bits):
    df = _rows(spark)
    got = keep_first_of_repeats(df, "key", ["src"], bits)
    want = keep_first(df, "key", ["src"])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert keep_first_of_repeats(df.limit(0), "key", ["src"], bits).count() == 0


def test_flag_holds_every_repeat_and_little_else(spark):
    df = _rows(spark)
    flagged = flag_repeats(df, ["key"], "again")
    repeated = df.groupBy("key").count().filter("count > 1")
    n = repeated.agg(F.sum("count")).first()[0]
    keys = {r.key for r in repeated.collect()}
    rows = flagged.filter("again").collect()
    assert keys <= {r.key for r in rows} and n <= len(rows) <= n + 20
    assert flagged.count() == 6_000


def test_filter_is_bounded(spark):
    df = spark.range(20_000).select((F.col("id") % 10_000).alias("k"))
    assert repeat_filter(df, ["k"], 1 << 10).count() <= 16


def test_single_keys_are_not_shuffled(spark, tmp_path):
    _rows(spark).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    plan = plan_text(flag_repeats(df, ["key"], "again").filter("not again"), "simple")
    assert "BroadcastHashJoin" in plan
    # the shuffles below go by hashes and words of the filter; no row travels by its key
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2 and not any("hashpartitioning(key" in line for line in shuffles)


def test_duplicates_of_odd_rows(spark):
    rows = [("a", 0.0), ("a", -0.0), ("a", None), ("a", None), (None, 1.0), (None, 1.0), (None, 2.0), ("b", float("nan")), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "Accident_Index string, x double")
    r = duplicate_report(df).first()
    assert (r.full_row_dups, r.key_dups) == (4, 6)
    wide = plan_text(duplicate_report(df), "simple")
    assert "xxhash64(Accident_Index" in wide
    empty = duplicate_report(df.limit(0)).first()
    assert empty.full_row_dups is None and empty.key_dups is None


def test_etl_of_mostly_unique_keys(spark, sf_small):
    from roadlens.fixture import raw_accidents
    from roadlens.plans.etl import run_etl
    from roadlens.session import scratch_path
    from roadlens.sources.tables import read_star

    raw = raw_accidents(spark, sf_small)
    path = scratch_path(spark, "mostly-unique-raw")
    raw.write.parquet(path)
    stored = spark.read.parquet(path)
    plain = run_etl(spark, stored, scratch_path(spark, "etl-plain"))
    other = run_etl(spark, stored, scratch_path(spark, "etl-mostly-unique"), mostly_unique=True)
    assert (other.raw_rows, other.clean_rows, other.fact_rows) == (plain.raw_rows, plain.clean_rows, plain.fact_rows)
    facts = [read_star(spark, r.out_dir)["fact_accidents"] for r in (plain, other)]
    assert facts[0].exceptAll(facts[1].select(facts[0].columns)).count() == 0
