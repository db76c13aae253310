"""The ETL run: raw accidents -> cleaned table -> star schema on Parquet ->
validation and summary.

Shape of the job at scale:

1. Clean (one shuffle: keep-first dedup on the accident key) and stage the
   result as Parquet in the shared scratch folder named by
   ``spark.checkpoint.dir``. Every later step reads the
   staged table, so the dedup shuffle runs once and a lost executor only
   costs a re-read, not a recomputation from the raw files.
2. All four dimensions from one grouping-sets pass over the staged table;
   keys assigned with one small range sort (see ``operators.keys``);
   dimensions written.
3. Fact = staged table joined to the written dimensions (broadcast only
   where their measured bytes fit), written partitioned by year.
4. All tables are written to a version folder of the run inside ``out_dir``; then
   one pointer file is replaced at once, and readers who resolve it (``read_star``)
   see the tables of one run, the one before or this one. A run that fails
   leaves the star before it. Older versions are deleted, but for the last
   ``keep`` that readers may still hold; the staged copy is deleted.
5. Validation reads the footers of the written tables, one aggregate per table,
   and columns only where a footer lacks their counts.

Row counts for the summary come from ``Observation`` metrics collected
while writing, not from extra count jobs.
"""

from __future__ import annotations

import argparse
import json
import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from roadlens.operators.checks import validate_folder
from roadlens.operators.clean import clean_all, impute_speed_limit
from roadlens.operators.star import build_dimensions, build_fact
from roadlens.plans.rollup import ROLLUP, build_rollup
from roadlens.schemas import DIMENSIONS, FACT_PARTITION_COL
from roadlens.session import (folder_names, partitions_for, remove_folder, replace_text, scratch_path,
                              shuffle_partitions as scoped_partitions)
from roadlens.sources.sinks import write_table
from roadlens.sources.tables import POINTER, STAR_TABLES, version_folder


@dataclass
class EtlResult:
    out_dir: str
    raw_rows: int
    clean_rows: int
    fact_rows: int
    dim_rows: dict[str, int]
    validation: DataFrame

    def summary(self) -> dict:
        return {"raw_rows": self.raw_rows, "clean_rows": self.clean_rows,
                "fact_rows": self.fact_rows, "dim_rows": self.dim_rows, "out_dir": self.out_dir}


def run_etl(spark: SparkSession, raw: DataFrame, out_dir: str, keys: str = "dense",
            null_safe: bool = False, strict_hour: bool = False, strict_coordinates: bool = False,
            impute_speed: bool = False, shuffle_partitions: int | None = None, keep: int = 1,
            mostly_unique: bool = False, rollup: bool = False) -> EtlResult:
    """Run the ETL into ``out_dir``. ``shuffle_partitions`` sizes the dedup
    shuffle for the run; by default ``session.partitions_for(raw)``.
    ``mostly_unique``: only rows whose key may repeat go through that shuffle,
    for a stored ``raw``, which is then read more than once. ``rollup``: the
    roll-up that answers the questions (``plans.rollup``) is published with the star."""
    staged_path = scratch_path(spark, "staged-clean")
    version = next_version(spark, out_dir)
    run_dir = version_folder(out_dir, version)
    try:
        with scoped_partitions(spark, shuffle_partitions or partitions_for(raw)):
            result = _run(spark, raw, out_dir, run_dir, staged_path, keys, null_safe,
                          strict_hour, strict_coordinates, impute_speed, mostly_unique)
            if rollup:
                stored = {name: spark.read.parquet(os.path.join(run_dir, name)) for name in STAR_TABLES}
                write_table(build_rollup(stored["fact_accidents"], stored), os.path.join(run_dir, ROLLUP))
        publish(spark, out_dir, version, keep)
    except BaseException:
        remove_folder(spark, run_dir)
        raise
    finally:
        remove_folder(spark, staged_path)
    return result


def next_version(spark: SparkSession, out_dir: str) -> str:
    """A name of its own that sorts after all versions there are."""
    there = folder_names(spark, os.path.join(out_dir, "_versions"))
    number = max((int(name.split("-")[0]) for name in there), default=-1) + 1
    return f"{number:08d}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, out_dir: str, version: str, keep: int = 1) -> None:
    """Point readers of ``out_dir`` to a complete version, and delete those before the last ``keep``."""
    replace_text(spark, os.path.join(out_dir, POINTER), version)
    older = [name for name in folder_names(spark, os.path.join(out_dir, "_versions")) if name < version]
    for name in older[:max(0, len(older) - keep)]:
        remove_folder(spark, version_folder(out_dir, name))


def _run(spark, raw, out_dir, run_dir, staged_path, keys, null_safe, strict_hour,
         strict_coordinates, impute_speed, mostly_unique=False) -> EtlResult:
    raw_obs, clean_obs, fact_obs = Observation("raw"), Observation("clean"), Observation("fact")
    # a raw table that is read several times is counted on its own
    observed_raw = raw if mostly_unique else raw.observe(raw_obs, F.count(F.lit(1)).alias("rows"))
    clean = clean_all(observed_raw, strict_hour=strict_hour, strict_coordinates=strict_coordinates,
                      mostly_unique=mostly_unique)
    # staged in the shared scratch folder (spark.checkpoint.dir), not beside the star
    write_table(clean.observe(clean_obs, F.count(F.lit(1)).alias("rows")), staged_path)
    staged = spark.read.parquet(staged_path)
    if impute_speed:
        # medians from the staged table: a two-column scan, not a second dedup
        staged = impute_speed_limit(staged)

    dims, dim_rows, dim_bytes = build_dimensions(staged, keys)
    # Four small, independent writes: submitted together so they share the cluster.
    with ThreadPoolExecutor(max_workers=len(dims)) as pool:
        list(pool.map(lambda item: write_table(item[1], os.path.join(run_dir, item[0])), dims.items()))
    written_dims = {name: spark.read.parquet(os.path.join(run_dir, name)) for name in DIMENSIONS}

    fact = build_fact(staged, written_dims, dim_bytes, null_safe)
    write_table(fact.observe(fact_obs, F.count(F.lit(1)).alias("rows")),
                os.path.join(run_dir, "fact_accidents"), FACT_PARTITION_COL)
    return EtlResult(out_dir=out_dir, raw_rows=raw.count() if mostly_unique else int(raw_obs.get["rows"]),
                     clean_rows=int(clean_obs.get["rows"]), fact_rows=int(fact_obs.get["rows"]),
                     dim_rows=dim_rows, validation=validate_folder(spark, run_dir))


def main(argv: list[str] | None = None) -> int:
    from roadlens.fixture import raw_accidents
    from roadlens.sources.csv import read_accident_csvs

    ap = argparse.ArgumentParser(description="Run the accident ETL into a star schema.")
    ap.add_argument("--out", required=True, help="output folder for the star schema")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf", help="scale-factor folder: derive raw accidents from its tables")
    src.add_argument("--csv", nargs="+", help="accident CSV files, folders or globs")
    ap.add_argument("--null-safe", action="store_true", help="match null attributes in key lookups")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="dedup shuffle partitions; derived from the input size by default (256 MB each)")
    ap.add_argument("--mostly-unique", action="store_true",
                    help="keys are mostly single: only rows whose key may repeat are shuffled by it")
    ap.add_argument("--rollup", action="store_true", help="publish the roll-up that answers the questions, too")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("roadlens-etl").getOrCreate()  # as submitted
    if args.sf:
        raw = raw_accidents(spark, args.sf)
    else:
        # keeps source_file: it orders keep-first
        raw = read_accident_csvs(spark, args.csv)
    result = run_etl(spark, raw, args.out, null_safe=args.null_safe, shuffle_partitions=args.shuffle_partitions,
                     mostly_unique=args.mostly_unique, rollup=args.rollup)
    print(json.dumps(result.summary()))
    for row in result.validation.collect():
        print(json.dumps(row.asDict()))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
