"""A key that holds a third of all rows: results stay whole and exact, and the
plans combine map-side before shuffling instead of moving the group whole."""

from pyspark.sql import functions as F

from roadlens.operators.dedup import keep_first
from roadlens.operators.star import dimension_members
from roadlens.plans.explain import plan_text


def _hot(spark, n=30_000):
    # a third of the rows share key "HOT"; the rest are unique keys
    return (spark.range(n).repartition(6)
                 .select(F.when(F.col("id") % 3 == 0, F.lit("HOT"))
                          .otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("key"),
                         (F.col("id") % 5).cast("int").alias("src"),
                         F.col("id").alias("val")))


def test_keep_first_on_hot_key(spark):
    df = _hot(spark)
    out = keep_first(df, "key", ["src"])
    assert out.count() == 1 + 20_000
    hot = out.filter(F.col("key") == "HOT").first()
    # first by source order, then by value: src 0 with the smallest id that is a multiple of 3
    assert (hot.src, hot.val) == (0, 0)


def test_keep_first_combines_map_side(spark):
    text = plan_text(keep_first(_hot(spark), "key", ["src"]), "simple")
    exchange = text.index("Exchange hashpartitioning(key")
    assert text.index("partial_min", exchange) > exchange  # partial aggregate sits below the shuffle


def test_dimension_members_on_hot_member(spark):
    from roadlens.schemas import DIMENSIONS

    cols = [c for cs, _ in DIMENSIONS.values() for c in cs]
    base = _hot(spark).select(*[(F.when(F.col("key") == "HOT", F.lit("x")).otherwise(F.col("key"))
                                 if i == 0 else F.lit(None).cast("string")).alias(c)
                                for i, c in enumerate(cols)])
    members = dimension_members(base)
    lines = [ln.strip() for ln in plan_text(members, "simple").splitlines()]
    ops = [ln.lstrip("+- :").split("(")[0].split(" ")[0] for ln in lines]
    # final hash aggregate <- shuffle <- map-side hash aggregate <- Expand (one scan for all sets)
    i = ops.index("Exchange")
    assert ops[i - 1] == "HashAggregate" and ops[i + 1] == "HashAggregate" and ops[i + 2] == "Expand"
    # one row per distinct member in each grouping set; the hot member once
    assert members.filter(F.col(cols[0]) == "x").count() == 1


def test_etl_with_a_hot_accident_key(spark, sf_small):
    """A third of the raw rows carry one accident number: the run stays exact."""
    from roadlens.fixture import raw_accidents
    from roadlens.plans.etl import run_etl
    from roadlens.session import scratch_path
    from roadlens.sources.tables import read_star

    raw = raw_accidents(spark, sf_small)
    n = raw.count()
    hot = raw.withColumn("Accident_Index",
                         F.when(F.xxhash64("Accident_Index", "copy_no") % 3 == 0, F.lit("A_HOT"))
                          .otherwise(F.col("Accident_Index")))
    expected = hot.select("Accident_Index").distinct().count()
    result = run_etl(spark, hot, scratch_path(spark, "etl-hot"))
    assert result.raw_rows == n
    assert result.clean_rows == result.fact_rows == expected
    fact = read_star(spark, result.out_dir)["fact_accidents"]
    assert fact.filter(F.col("Accident_Index") == "A_HOT").count() == 1
