"""Parquet tables: scan (S5) and SQL view registration."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from roadlens.schemas import DIMENSIONS
from roadlens.session import read_text

STAR_TABLES = ["fact_accidents", *DIMENSIONS]
POINTER = "_current"  # names the published version


def table_path(base: str, name: str) -> str:
    """``{base}/{name}.parquet`` if that exists locally, else ``{base}/{name}``."""
    single = os.path.join(base, f"{name}.parquet")
    if "://" not in base and not os.path.exists(single) and os.path.exists(os.path.join(base, name)):
        return os.path.join(base, name)
    return single


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Lazy Parquet scan; filters and projections reach the reader."""
    return spark.read.parquet(table_path(base, name))


def version_folder(star_dir: str, version: str) -> str:
    return os.path.join(star_dir, "_versions", version)


def star_folder(spark: SparkSession, star_dir: str) -> str:
    """Where the tables of the published run are; ``star_dir`` itself where nothing was published."""
    version = read_text(spark, os.path.join(star_dir, POINTER))
    return version_folder(star_dir, version) if version else star_dir


def read_star(spark: SparkSession, star_dir: str) -> dict[str, DataFrame]:
    """The five star tables (fact partitioned by year), all of one run: the
    pointer is read once."""
    folder = star_folder(spark, star_dir)
    return {name: spark.read.parquet(os.path.join(folder, name)) for name in STAR_TABLES}


def register_star(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Session-scoped SQL names for the star tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)
