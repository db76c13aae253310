"""Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roadlens.session import scoped_conf


def write_table(df: DataFrame, path: str, partition_col: str | None = None,
                dynamic_overwrite: bool = False, file_bytes: int | None = None) -> str:
    """Overwrite ``path`` with snappy Parquet, optionally ``partitionBy``.

    Rows of one partition value are brought together first, so that files are
    as many as their bytes need, not tasks x values. It is a REBALANCE: adaptive
    execution joins small values in one task and splits a hot one, or the
    nulls, over several, of about ``file_bytes`` each (shuffled size; the
    session's advisory size by default). Without adaptive execution nothing
    would split a hot value, so rows then stay where they are.
    ``dynamic_overwrite`` replaces only the partitions present in ``df``.
    """
    spark = df.sparkSession
    if partition_col and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        df = df.hint("rebalance", partition_col)
    w = df.write.mode("overwrite").option("compression", "snappy")
    if partition_col:
        w = w.partitionBy(partition_col)
        if dynamic_overwrite:
            w = w.option("partitionOverwriteMode", "dynamic")
    with scoped_conf(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes) if file_bytes else None):
        w.parquet(path)
    return path
