"""Dated landing zone (S9) and pre-load file checks.

Layout: ``{root}/year=YYYY/month=MM/source_file=NAME/part-*.csv``. Landing a
source again replaces only its own folder (same-named file overwritten,
others kept). The ingest date is a parameter, not the wall clock, so a
rerun lands in the same place. Beside the sources lies ``_manifest``, versions of a
small table with their statistics, which reports and typed reads use.
"""

from __future__ import annotations

import datetime as dt
import os
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from roadlens.operators.small import materialize
from roadlens.session import folder_names
from roadlens.sources.csv import (CSV_OPTIONS, DECIMAL, INTEGER, KNOWN_TYPES, header_groups, list_files,
                                  read_csv_group, write_csv)


def landing_folder(root: str, ingest_date: dt.date) -> str:
    return os.path.join(root, f"year={ingest_date.year:04d}", f"month={ingest_date.month:02d}")


def land_sources(sources: dict[str, DataFrame], root: str, ingest_date: dt.date) -> dict[str, str]:
    """Write each source as CSV into its own folder under the dated partition;
    sources of one schema share a write. Their statistics go to the manifest."""
    base = landing_folder(root, ingest_date)
    groups: dict[str, list[str]] = {}
    for name, df in sources.items():
        groups.setdefault(df.schema.simpleString(), []).append(name)
    for names in groups.values():
        named = [sources[name].withColumn("source_file", F.lit(name)) for name in names]
        _write_group(reduce(DataFrame.unionAll, named), base, names)
    out = {name: os.path.join(base, f"source_file={name}") for name in sources}
    if out:
        spark = next(iter(sources.values())).sparkSession
        add_to_manifest(spark, base, _by_source(file_statistics(spark, list(out.values()))))
    return out


def _write_group(df: DataFrame, base: str, names: list[str]) -> None:
    """Files of one header in one write, whatever their number.

    Dynamic overwrite replaces the folders of those that have rows; one
    without any gets a folder with its header alone."""
    seen = Observation("landed")
    counted = df.observe(seen, F.collect_set("source_file").alias("names"))  # names of files, no more
    (counted.write.mode("overwrite").partitionBy("source_file").option("partitionOverwriteMode", "dynamic")
            .options(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", escape='"').csv(base))
    for name in sorted(set(names) - set(seen.get["names"])):
        write_csv(df.drop("source_file").limit(0), os.path.join(base, f"source_file={name}"))


class LandingRefused(ValueError):
    """Incoming files that did not pass the checks; nothing was landed."""


COLUMN_STATS = "array<struct<name:string,non_null:bigint,whole:boolean,decimal:boolean>>"


def _column_stats(columns: tuple[str, ...], value, counted) -> list:
    """Aggregates over the texts of a file's columns: values, and whether all are whole or decimal numbers."""
    out = []
    for i in range(len(columns)):
        x = F.when(counted, value(i))
        out += [F.count(x).alias(f"n{i}"), F.bool_and(F.when(x.isNotNull(), x.rlike(INTEGER) & x.try_cast("bigint").isNotNull())).alias(f"w{i}"),
                F.bool_and(x.rlike(DECIMAL)).alias(f"d{i}")]
    return out


def _stats_array(columns: tuple[str, ...], fits):
    return F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"n{i}").alias("non_null"), (F.col(f"w{i}") & fits).alias("whole"),
                              (F.col(f"d{i}") & fits).alias("decimal")) for i, c in enumerate(columns)]).cast(COLUMN_STATS)


def _group_statistics(spark: SparkSession, columns: tuple[str, ...], paths: list[str], multi_line: bool) -> DataFrame:
    """Statistics of the files of one header, in one pass over their lines; records
    with quoted line breaks need the CSV reader, which is a second pass."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
                                          "value", F.regexp_replace("value", "^\ufeff", "").alias("line"))
    shared = [F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("lines"), F.bool_and(F.is_valid_utf8("value")).alias("valid_utf8")]
    if multi_line:
        text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        rows = spark.read.options(**CSV_OPTIONS, multiLine=True).schema(text).csv(paths).withColumn("file", F.col("_metadata.file_path"))
        stats = rows.groupBy("file").agg(F.count(F.lit(1)).alias("records"), *_column_stats(columns, lambda i: F.col(f"`{columns[i]}`"), F.lit(True)))
        found = lines.groupBy("file").agg(*shared).join(stats, "file", "left").fillna(0, ["records"])
        return found.select("file", "bytes", "lines", "records", "valid_utf8", _stats_array(columns, F.lit(True)).alias("columns"))
    names = [c.replace("`", "``") for c in columns]
    parsed = lines.withColumn("f", F.from_csv("line", ", ".join(f"`{c}` string" for c in names), {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "enforceSchema")}))
    value = lambda i: F.col(f"f.`{names[i]}`")
    header = reduce(lambda a, b: a & b, [value(i).eqNullSafe(F.lit(c or None)) for i, c in enumerate(columns)], F.lit(True))
    full = F.trim("line") != ""
    parsed = parsed.withColumns({"is_header": header, "is_record": full & ~header})
    found = parsed.groupBy("file").agg(*shared, F.count_if(full).alias("full"), F.count_if("is_header").alias("headers"),
                                       *_column_stats(columns, value, F.col("is_record")))
    # a header that comes again inside a file is a record, and no number
    return found.select("file", "bytes", "lines", (F.col("full") - 1).alias("records"), "valid_utf8",
                        _stats_array(columns, F.col("headers") <= 1).alias("columns"))


def file_statistics(spark: SparkSession, paths: list[str], multi_line: bool = False) -> DataFrame:
    """Per real file (S3, S10): file, bytes, lines, records, valid_utf8, and of its
    columns the name, the number of values and whether all are whole or decimal
    numbers. One pass over the files; an empty file has no lines and no columns."""
    listed = spark.createDataFrame([(path,) for path in spark.read.text(paths).inputFiles()], "file string")
    parts = [_group_statistics(spark, columns, some, multi_line) for columns, some in header_groups(spark, paths).items()]
    none = spark.createDataFrame([], f"file string, bytes bigint, lines bigint, records bigint, valid_utf8 boolean, columns {COLUMN_STATS}")
    found = reduce(DataFrame.unionByName, parts, none)
    # a local file is file:/x in one place and file:///x in another
    listed, found = (df.withColumn("file", F.regexp_replace("file", "^file:/+", "file:/")) for df in (listed, found))
    return (listed.join(found, "file", "left").fillna(0, ["bytes", "lines", "records"]).fillna({"valid_utf8": True})
                  .withColumn("columns", F.coalesce("columns", F.array().cast(COLUMN_STATS))))


def incoming_checks(spark: SparkSession, paths: list[str], multi_line: bool = False) -> DataFrame:
    """S10 on incoming CSV files, one row per real file: size in bytes, text
    lines, records (without the header), whether its bytes are UTF-8, ok.

    Lines come from the text source, which keeps the bytes as they are, so a
    bad byte is seen; files can be cut into many tasks. An empty file fails.
    """
    return _checked(file_statistics(spark, paths, multi_line)).drop("columns")


def _checked(statistics: DataFrame) -> DataFrame:
    return statistics.withColumn("ok", (F.col("lines") > 0) & F.col("valid_utf8"))


def _base_name(path):
    return F.try_url_decode(F.replace(F.regexp_extract(path, r"([^/]+)$", 1), F.lit("+"), F.lit("%2B")))


def land_csv_files(spark: SparkSession, paths: list[str], root: str, ingest_date: dt.date,
                   multi_line: bool = False) -> dict[str, str]:
    """Land existing CSV files behind the gate of ``incoming_checks``: no file,
    or one that fails, and nothing is landed (``LandingRefused`` names it).
    Every column is read as text (the landing zone does not interpret
    values) and rewritten under the file's own ``source_file=NAME`` folder, header in
    every part file, in one write per distinct header. The gate's scan is the only
    one besides: what it found goes to the manifest. Files of one name in several folders are refused."""
    from pyspark.errors import AnalysisException

    try:
        files = list_files(spark, paths)
    except AnalysisException as exc:
        raise LandingRefused(f"no such input: {exc}") from exc
    if not files:
        raise LandingRefused(f"no CSV file in {paths}")
    checked, _ = materialize(_checked(file_statistics(spark, files, multi_line)), count=False)
    failed = checked.filter(~F.col("ok")).orderBy("file").first()
    if failed:
        raise LandingRefused(f"{failed['file']}: {'not UTF-8' if failed['lines'] else 'empty'}")
    names = [os.path.basename(path) for path in files]
    if len(set(names)) < len(names):
        raise LandingRefused("two incoming files share a name")
    base = landing_folder(root, ingest_date)
    for columns, group in header_groups(spark, files).items():
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
        rows = spark.read.options(**CSV_OPTIONS, multiLine=multi_line).schema(schema).csv(group)
        _write_group(rows.withColumn("source_file", _base_name(F.col("_metadata.file_path"))), base, [os.path.basename(f) for f in group])
    add_to_manifest(spark, base, _by_source(checked.drop("ok"), _base_name(F.col("file"))))
    return {name: os.path.join(base, f"source_file={name}") for name in names}


def _by_source(statistics: DataFrame, source=None) -> DataFrame:
    """Statistics of files as the manifest has them, one row per source: a landed source may have several part files."""
    named = statistics.withColumn("source_file", F.try_url_decode(F.replace(F.regexp_extract("file", r"source_file=([^/]+)/", 1), F.lit("+"), F.lit("%2B"))) if source is None else source)
    totals = named.groupBy("source_file").agg(F.count(F.lit(1)).alias("files"), *[F.sum(c).alias(c) for c in ("bytes", "lines", "records")],
                                              F.bool_and("valid_utf8").alias("valid_utf8"))
    one = named.select("source_file", F.posexplode("columns").alias("at", "c"))
    columns = one.groupBy("source_file", "at").agg(F.max("c.name").alias("name"), F.sum("c.non_null").alias("non_null"),
                                                   F.bool_and("c.whole").alias("whole"), F.bool_and("c.decimal").alias("decimal"))
    listed = columns.groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct("at", "name", "non_null", "whole", "decimal"))).alias("columns"))
    return totals.join(listed, "source_file", "left").withColumn(
        "columns", F.coalesce(F.transform("columns", lambda c: F.struct(c["name"].alias("name"), c["non_null"].alias("non_null"), c["whole"].alias("whole"), c["decimal"].alias("decimal"))),
                              F.array()).cast(COLUMN_STATS))


def add_to_manifest(spark: SparkSession, base: str, new: DataFrame) -> None:
    """The manifest of a dated folder with ``new`` in place of the rows of its sources, as the next version."""
    kept = manifest(spark, base)
    rows = new if kept is None else kept.join(new, "source_file", "left_anti").unionByName(new)
    versions = folder_names(spark, os.path.join(base, "_manifest"))
    rows.coalesce(1).write.parquet(os.path.join(base, "_manifest", f"{int(versions[-1]) + 1 if versions else 0:08d}"))  # one row a source


def manifest(spark: SparkSession, base: str) -> DataFrame | None:
    """Statistics of what lies in a dated folder: source_file, files, bytes, lines,
    records, valid_utf8, columns; None where nothing was landed."""
    root = os.path.join(base, "_manifest")
    written = [v for v in folder_names(spark, root) if "_SUCCESS" in folder_names(spark, os.path.join(root, v))]
    return spark.read.parquet(os.path.join(base, "_manifest", written[-1])) if written else None


def landed_report(spark: SparkSession, base: str) -> DataFrame:
    """S3 + S10 from the manifest, without reading the files again: per source part
    files, size in MB, the same without the headers of the part files, lines, records, columns, UTF-8."""
    header = F.aggregate("columns", F.lit(0), lambda n, c: n + F.octet_length(c["name"]) + 1)  # with commas and the line's end
    mb = lambda b: F.round(b / F.lit(1024.0 * 1024.0), 6)
    return manifest(spark, base).select(
        "source_file", F.col("files").alias("part_files"), mb(F.col("bytes")).alias("size_mb"),
        mb(F.col("bytes") - F.col("files") * header).alias("data_mb"), "lines", F.col("records").alias("rows"),
        F.size("columns").alias("columns"), "valid_utf8")


def landed_types(spark: SparkSession, base: str) -> dict[str, T.DataType]:
    """Types of the columns without a canonical one, from the manifest: bigint,
    double or string, the narrowest that holds all values of all sources."""
    known = list(KNOWN_TYPES)
    found = (manifest(spark, base).select(F.explode("columns").alias("c")).filter(~F.col("c.name").isin(known) & (F.col("c.non_null") > 0))
             .groupBy("c.name").agg(F.bool_and("c.whole").alias("whole"), F.bool_and("c.decimal").alias("decimal")).collect())
    return {r["name"]: T.LongType() if r["whole"] else T.DoubleType() if r["decimal"] else T.StringType() for r in found}


def read_landed(spark: SparkSession, folders: dict[str, str], typed: bool = False) -> DataFrame:
    """Read landed sources back, one read per distinct header, with the partition
    values as columns; ``typed``: columns of no known type as the manifest says, else as text."""
    types = {}
    for base in {os.path.dirname(folder) for folder in folders.values()} if typed else ():
        types |= landed_types(spark, base)
    place = F.col("_metadata.file_path")
    parts = [read_csv_group(spark, files, None, list(columns), types).withColumns({
        "year": F.regexp_extract(place, r"year=(\d+)", 1).cast("int"),
        "month": F.regexp_extract(place, r"month=(\d+)", 1).cast("int"),
        "source_file": F.try_url_decode(F.replace(F.regexp_extract(place, r"source_file=([^/]+)/", 1), F.lit("+"), F.lit("%2B")))})
        for columns, files in header_groups(spark, list(folders.values())).items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def file_checks(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Per landed source: part files, size MB, text lines, data rows
    (lines minus one header per part file), all lines valid UTF-8."""
    paths = list(folders.values())
    text = spark.read.text(paths).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"source_file=([^/]+)", 1).alias("source_file"),
        F.col("_metadata.file_path").alias("_part"), F.col("_metadata.file_size").alias("_size"),
        F.is_valid_utf8(F.col("value")).alias("_utf8"))
    parts = (text.groupBy("source_file", "_part")
                 .agg(F.count(F.lit(1)).alias("_lines"), F.max("_size").alias("_size"),
                      F.bool_and("_utf8").alias("_utf8")))
    return (parts.groupBy("source_file")
                 .agg(F.count(F.lit(1)).alias("part_files"),
                      F.round(F.sum("_size") / F.lit(1024.0 * 1024.0), 2).alias("size_mb"),
                      F.sum("_lines").alias("lines"),
                      (F.sum("_lines") - F.count(F.lit(1))).alias("rows"),
                      F.bool_and("_utf8").alias("valid_utf8")))
