"""The ETL run end to end: written star, observed counts, validation."""

import os

from roadlens.fixture import raw_accidents
from roadlens.plans.etl import run_etl
from roadlens.sources.tables import read_star, star_folder
from roadlens.session import scratch_path


def test_etl_writes_valid_star(spark, sf_small):
    out = scratch_path(spark, "etl-test")
    result = run_etl(spark, raw_accidents(spark, sf_small), out)
    assert (result.raw_rows, result.clean_rows, result.fact_rows) == (1650, 1500, 1500)
    for name in ["fact_accidents", "dim_time", "dim_geography", "dim_road", "dim_environment"]:
        assert os.path.isdir(os.path.join(star_folder(spark, out), name))
    years = [d for d in os.listdir(os.path.join(star_folder(spark, out), "fact_accidents")) if d.startswith("Year_Derived=")]
    assert "Year_Derived=__HIVE_DEFAULT_PARTITION__" in years  # unparseable dates
    rows = {(r.table_name, r.column_name): r for r in result.validation.collect()}
    assert rows[("fact_accidents", "Accident_Index")].ok
    assert not rows[("fact_accidents", "time_key")].ok  # null attributes never match (published behaviour)
    assert all(rows[(t, k)].ok for t, k in rows if t != "fact_accidents")


def test_etl_null_safe_resolves_all_keys(spark, sf_small):
    out = scratch_path(spark, "etl-test-ns")
    result = run_etl(spark, raw_accidents(spark, sf_small), out, null_safe=True)
    assert all(r.ok for r in result.validation.collect())


def test_etl_with_imputation_and_strict_flags(spark, sf_small):
    from pyspark.sql import functions as F

    out = scratch_path(spark, "etl-test-imp")
    result = run_etl(spark, raw_accidents(spark, sf_small), out, impute_speed=True,
                     strict_hour=True, strict_coordinates=True)
    staged = read_star(spark, out)["dim_road"]
    assert staged.filter(F.col("Speed_limit") <= 0).count() == 0
    assert result.fact_rows == 1500


def test_bench_prints_one_json_line(tmp_path):
    import json
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    proc = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, cwd=tmp_path,
                          capture_output=True, text=True, timeout=900)
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [ln for ln in proc.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["value"] > 0 and "bq1_monthly_rank" in out["queries"]


def test_shuffle_partitions_scoped_and_sized(spark, sf_small):
    from roadlens.session import partitions_for, shuffle_partitions

    before = spark.conf.get("spark.sql.shuffle.partitions")
    with shuffle_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    orders = spark.read.parquet(os.path.join(sf_small, "orders.parquet"))
    assert partitions_for(orders) == int(before)
    assert partitions_for(orders, target_bytes=1024) == -(-os.path.getsize(os.path.join(sf_small, "orders.parquet")) // 1024)
    assert partitions_for(spark.createDataFrame([(1,)], "x int")) == int(before)
    out = scratch_path(spark, "etl-test-parts")
    assert run_etl(spark, raw_accidents(spark, sf_small), out, shuffle_partitions=3).clean_rows == 1500


def test_cli_runs_from_tables(spark, sf_small, capsys):
    import json

    from roadlens.plans.etl import main

    out = scratch_path(spark, "etl-cli")
    assert main(["--sf", sf_small, "--out", out]) == 0
    first = capsys.readouterr().out.splitlines()[0]
    summary = json.loads(first)
    assert (summary["raw_rows"], summary["clean_rows"], summary["fact_rows"]) == (1650, 1500, 1500)


def test_etl_with_hashed_keys(spark, sf_small):
    out = scratch_path(spark, "etl-test-hash")
    result = run_etl(spark, raw_accidents(spark, sf_small), out, keys="hash")
    rows = {(r.table_name, r.column_name): r for r in result.validation.collect()}
    assert all(rows[(t, k)].ok for t, k in rows if t != "fact_accidents")
    assert rows[("fact_accidents", "road_key")].ok and result.fact_rows == 1500


def test_failed_run_leaves_the_star_before_it_and_no_scratch(spark, sf_small, monkeypatch):
    import pytest

    from roadlens.plans import etl
    from roadlens.session import ensure_checkpoint_dir

    raw, out = raw_accidents(spark, sf_small), scratch_path(spark, "etl-fail")
    run_etl(spark, raw, out)
    names = sorted(os.listdir(out))
    versions = os.listdir(os.path.join(out, "_versions"))
    assert "_current" in names and len(versions) == 1
    rows = {n: sorted(map(str, df.collect())) for n, df in read_star(spark, out).items()}

    scratch = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "roadlens")
    before = {d for d in os.listdir(scratch) if d.startswith("staged-clean")}
    real = etl.write_table

    def failing(df, path, *args, **kwargs):
        if path.endswith("fact_accidents"):
            raise OSError("disk")
        return real(df, path, *args, **kwargs)

    monkeypatch.setattr(etl, "write_table", failing)
    with pytest.raises(OSError):
        run_etl(spark, raw.filter("Speed_limit > 30"), out)
    assert sorted(os.listdir(out)) == names
    assert os.listdir(os.path.join(out, "_versions")) == versions
    assert rows == {n: sorted(map(str, df.collect())) for n, df in read_star(spark, out).items()}
    assert {d for d in os.listdir(scratch) if d.startswith("staged-clean")} == before


def test_broadcast_is_decided_by_bytes(spark):
    from pyspark.sql import functions as F

    from roadlens.operators.small import broadcast_if_small, measured_bytes
    from roadlens.plans.explain import join_strategies
    from roadlens.session import broadcast_limit

    assert broadcast_limit(spark) == 10 << 20
    narrow = spark.range(2000).withColumn("v", F.lit("x"))
    wide = spark.range(2000).withColumn("v", F.repeat(F.lit("x"), 10_000))  # as many rows, 20 MB
    left = spark.range(3_000_000)
    assert measured_bytes(narrow) < 10 << 20 < measured_bytes(wide)
    for side, hinted in [(narrow, True), (wide, False)]:
        plan = left.join(broadcast_if_small(side, measured_bytes(side)), "id")._jdf.queryExecution().logical().toString()
        assert ("broadcast" in plan) == hinted
    assert join_strategies(left.join(broadcast_if_small(narrow, measured_bytes(narrow)), "id")) == ["BroadcastHashJoin"]


def test_a_reader_during_a_publish_sees_one_run(spark):
    import threading

    from pyspark.sql import functions as F

    from roadlens.plans.etl import next_version, publish
    from roadlens.sources.tables import STAR_TABLES, version_folder

    out, stop, seen, failed = scratch_path(spark, "publish"), threading.Event(), [], []

    def make(run: int) -> str:
        version = next_version(spark, out)
        for name in STAR_TABLES:
            spark.range(1).select(F.lit(run).alias("run")).write.parquet(os.path.join(version_folder(out, version), name))
        return version

    publish(spark, out, make(0))

    def read():
        while not stop.is_set():
            try:
                seen.append({df.first()["run"] for df in read_star(spark, out).values()})
            except Exception as exc:  # noqa: BLE001
                failed.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for run in range(1, 6):
            publish(spark, out, make(run), keep=3)
    finally:
        stop.set()
        reader.join()
    assert not failed and all(len(runs) == 1 for runs in seen) and len(seen) > 3
    assert read_star(spark, out)["dim_road"].first()["run"] == 5
    assert len(os.listdir(os.path.join(out, "_versions"))) == 4


def test_files_are_as_many_as_their_bytes_need(spark):
    from pyspark.sql import functions as F

    from roadlens.session import shuffle_partitions
    from roadlens.sources.sinks import write_table

    rows = spark.range(0, 400_000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"),
                                                 F.when(F.col("id") % 10 > 0, 2009).otherwise((F.col("id") / 10 % 9 + 2000).cast("int")).alias("year"))
    rows = rows.withColumn("year", F.when(F.col("year") < 2009, F.nullif("year", F.lit(2003))).otherwise(F.col("year")))
    with shuffle_partitions(spark, 64):
        path = write_table(rows, scratch_path(spark, "sized"), "year", file_bytes=4 << 20)
    files = {d.split("=")[1]: [f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")] for d in os.listdir(path) if "=" in d}
    assert len(files) == 10 and 2 <= len(files["2009"]) <= 16
    assert sum(map(len, files.values())) <= 40  # 16 x 10 without it; a year may share its partition with the hot one
    back = spark.read.parquet(path)
    assert back.count() == 400_000 and back.filter("year is null").count() == rows.filter("year is null").count() > 0
