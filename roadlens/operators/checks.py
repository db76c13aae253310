"""Validation and integrity (M6, M7)."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.operators.small import broadcast_if_small
from roadlens.schemas import DIMENSIONS, VALIDATED_KEYS


def validate_tables(tables: dict[str, DataFrame],
                    keys: dict[str, list[str]] = VALIDATED_KEYS) -> DataFrame:
    """M6: per table and key column: rows, nulls, ok (no nulls). One
    aggregate per table (all its key columns at once)."""
    parts = []
    for name, cols in keys.items():
        df = tables[name]
        wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                      *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
        recs = [F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                         F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("nulls"))
                for i, c in enumerate(cols)]
        parts.append(wide.select(F.inline(F.array(*recs))))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("ok", F.col("nulls") == 0)


def validate_folder(spark: SparkSession, folder: str, keys: dict[str, list[str]] = VALIDATED_KEYS) -> DataFrame:
    """M6 for the Parquet tables in a folder, from their footers: the counts of
    rows and of values of each key column are pushed into the scan, which then
    reads no column. A table with a footer that lacks a column's count of nulls
    is scanned instead. The checks run at once; one row a table reaches the driver."""
    found: list[tuple[str, str, int, int]] = []
    for name, cols in keys.items():
        path = os.path.join(folder, name)
        try:
            counted = footer_counts(spark, path, cols).first()
        except Exception as e:
            if AGGREGATES not in str(e):  # Spark names the setting where a footer lacks a count
                raise
            counted = _counts(spark.read.parquet(path), cols).first()
        found += [(name, c, counted["_rows"], counted["_rows"] - counted[f"_v{i}"]) for i, c in enumerate(cols)]
    out = spark.createDataFrame(found, "table_name string, column_name string, rows long, nulls long")
    return out.withColumn("ok", F.col("nulls") == 0)


AGGREGATES = "spark.sql.parquet.aggregatePushdown"


def _counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_v{i}") for i, c in enumerate(cols)])


def footer_counts(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """Rows of a Parquet table and values per column, answered by its footers, which tasks read.

    The settings this takes are those of a session of its own; the caller's stay."""
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set(AGGREGATES, "true")
    return _counts(reader.read.parquet(path), cols)


def integrity(fact: DataFrame, dims: dict[str, DataFrame],
              dim_bytes: dict[str, int] | None = None) -> DataFrame:
    """M7: per dimension: rows, distinct keys, duplicated keys, fact rows with
    a null foreign key, and fact rows whose key has no dimension row.

    The fact is scanned once: each dimension's key set is left-joined
    (broadcast when its measured size allows) and flagged, then one aggregate
    counts nulls and misses for all four keys together.
    """
    probe = fact.select(*[key for _, key in DIMENSIONS.values()])
    for name, (_, key) in DIMENSIONS.items():
        keys = dims[name].select(key).distinct().withColumn(f"_hit_{key}", F.lit(True))
        probe = probe.join(broadcast_if_small(keys, (dim_bytes or {}).get(name)), key, "left")
    counted = probe.agg(*[c for _, key in DIMENSIONS.values() for c in (
        F.count_if(F.col(key).isNull()).alias(f"_null_{key}"),
        F.count_if(F.col(key).isNotNull() & F.col(f"_hit_{key}").isNull()).alias(f"_orphan_{key}"))])
    fact_counts = counted.select(F.struct(*counted.columns).alias("s")).scalar()
    parts = []
    for name, (_, key) in DIMENSIONS.items():
        dim_stats = dims[name].agg(F.count(F.lit(1)).alias("rows"),
                                   F.count_distinct(F.col(key)).alias("distinct_keys"))
        parts.append(dim_stats.select(
            F.lit(name).alias("table_name"), "rows", "distinct_keys",
            (F.col("rows") - F.col("distinct_keys")).alias("duplicate_keys"),
            fact_counts[f"_null_{key}"].alias("null_fk_rows"),
            fact_counts[f"_orphan_{key}"].alias("orphan_fact_rows")))
    return reduce(DataFrame.unionByName, parts)
