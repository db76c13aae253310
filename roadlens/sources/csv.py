"""CSV sources (S1-S3) and the CSV writer used by the landing zone.

Files are grouped by their header line and each group is read once with its
own schema: known columns have their canonical type, all others the narrowest
of bigint, double and string that holds every value of all files. A header
that does not match the schema it is read with is an error, never a silent
shift of columns. Groups are unioned by name with missing columns as null
(U1). A record that does not fit its schema keeps its readable fields, and its
text goes to ``CORRUPT_COL``. Whitespace is data (the profile counts
leading/trailing spaces), so the reader and writer keep it.
"""

from __future__ import annotations

import csv as _csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from roadlens.operators.small import materialize
from roadlens.schemas import RAW_FIELDS

CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
    "enforceSchema": "false",
}
CORRUPT_COL = "_corrupt_record"
FIRST_BYTES = 1 << 16
INTEGER = r"^\s*[+-]?\d+\s*$"
DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
KNOWN_TYPES: dict[str, T.DataType] = {**dict(RAW_FIELDS), "copy_no": T.IntegerType()}


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line of a file group (one row to the driver)."""
    first = spark.read.options(quote='"', escape='"').option("header", "false").csv(path).limit(1).collect()
    if not first:
        return []
    return [str(v).strip() if v is not None else f"_c{i}" for i, v in enumerate(first[0])]


def _local(path: str) -> str | None:
    """The plain path of a local file, None for another store."""
    found = re.match("file:/+", path)
    return f"/{path[found.end():]}" if found else None if "://" in path else path


def first_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(path, header, bytes_read) of local files that aren't empty: tasks open
    some files each and read ``FIRST_BYTES`` at a time until a line is whole, so
    the bytes read don't grow with the files. Needs nothing but pyarrow on the executors."""
    step = FIRST_BYTES

    def read(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                with fs.LocalFileSystem().open_input_stream(_plain(path), compression="detect") as stream:
                    start = b""
                    while (more := stream.read(step)) and not any(c in start + more for c in b"\r\n"):
                        start += more
                    start += more
                if start:
                    rows.append((path, start.splitlines()[0].decode("utf-8", "replace"), len(start)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "header", "bytes_read"])

    _plain = _local  # by value: executors need not have this package
    listed = spark.createDataFrame([(path,) for path in files], "path string")
    tasks = max(1, min(len(files), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return listed.repartition(tasks).mapInArrow(read, "path string, header string, bytes_read bigint")


def _scanned_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """The same from any store, by Spark's reader: the line at offset 0 of each file."""
    return (spark.read.text(files).select(F.col("_metadata.file_path").alias("path"), "value",
                                          F.col("_metadata.file_block_start").alias("at"),
                                          F.monotonically_increasing_id().alias("row"))
                 .filter(F.col("at") == 0)
                 .groupBy("path").agg(F.min_by("value", "row").alias("header")))


def header_groups(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """``paths`` (files, folders, globs) by their columns; empty files belong to no group.

    The driver gets the distinct headers. If there is one, all paths go with
    it as they are; only if there are several it gets each file's, because
    Spark's reader takes the files of a group as a list."""
    files = list_files(spark, paths)
    if not files:
        return {}
    lines = first_lines(spark, files) if all(map(_local, files)) else _scanned_lines(spark, files)
    lines, _ = materialize(lines, count=False)

    def columns(header: str) -> tuple[str, ...]:
        return tuple(next(_csv.reader([header.removeprefix("\ufeff")]), []))

    headers = {columns(r["header"]) for r in lines.select("header").distinct().collect()}
    if len(headers) <= 1:
        return {header: list(paths) for header in headers}
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in lines.select("path", "header").orderBy("path").collect():
        groups.setdefault(columns(r["header"]), []).append(unquote(r["path"]))
    return groups


def schema_for(columns: list[str], types: dict[str, T.DataType] | None = None) -> T.StructType:
    known = {**(types or {}), **KNOWN_TYPES}
    return T.StructType([T.StructField(c, known.get(c, T.StringType()), True) for c in columns])


def unknown_types(spark: SparkSession, groups: dict[tuple[str, ...], list[str]], multi_line: bool = False) -> dict[str, T.DataType]:
    """Types of the columns without a canonical one: bigint, double or string,
    the narrowest that holds all their values in all files (one aggregate per
    header over whole files; a column without values is a string)."""
    fits: dict[str, list[bool]] = {}
    for columns, files in groups.items():
        wanted = [(i, c) for i, c in enumerate(columns) if c not in KNOWN_TYPES]
        if not wanted:
            continue
        text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        df = spark.read.options(**CSV_OPTIONS, multiLine=multi_line).schema(text).csv(files)
        found = df.agg(*[a for i, c in wanted for x in [F.col(f"`{c}`")] for a in (
            F.count(x).alias(f"n{i}"), F.bool_and(F.when(x.isNotNull(), x.rlike(INTEGER) & x.try_cast("bigint").isNotNull())).alias(f"i{i}"),
            F.bool_and(x.rlike(DECIMAL)).alias(f"d{i}"))]).first()
        for i, c in wanted:
            if found[f"n{i}"]:
                fits.setdefault(c, []).append((found[f"i{i}"], found[f"d{i}"]))
    return {c: T.LongType() if all(i for i, _ in seen) else T.DoubleType() if all(d for _, d in seen) else T.StringType()
            for c, seen in fits.items()}


def read_csv_group(spark: SparkSession, path: str | list[str], source_col: str | None = "source_file",
                   columns: list[str] | None = None, types: dict[str, T.DataType] | None = None,
                   corrupt: bool = False, multi_line: bool = False) -> DataFrame:
    """Files sharing one header (``columns``, read from the file if not given).

    With ``source_col`` the rows also carry their position in the input:
    file path, start offset of the split (``source_block``) and an id taken
    right at the scan (``source_row``), which increases in line order within
    a split. Ordered together they give "first occurrence" without a line
    number in the file format. ``corrupt`` keeps the text of records that do
    not fit in ``CORRUPT_COL``; ``multi_line`` reads quoted line breaks (a
    file is then one task).
    """
    columns = list(columns) if columns is not None else header_columns(spark, path)
    schema = schema_for(columns, types)
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType())])
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multi_line, columnNameOfCorruptRecord=CORRUPT_COL)
    if corrupt:
        reader = reader.option("columnPruning", "false")  # a record is judged by all its fields
    df = reader.schema(schema).csv(path)
    if source_col:
        df = df.withColumns({
            source_col: F.col("_metadata.file_path"),
            "source_block": F.col("_metadata.file_block_start"),
            "source_row": F.monotonically_increasing_id(),
        })
    return df


def list_files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Files behind paths, folders and globs, empty ones included, sorted (as
    Spark's reader lists them; the list is bounded by the number of files)."""
    return sorted(unquote(path) for path in spark.read.text(paths).inputFiles())


def read_accident_csvs(spark: SparkSession, paths: list[str], source_col: str | None = "source_file",
                       infer_unknown: bool = True, corrupt: bool = False, multi_line: bool = False,
                       types: dict[str, T.DataType] | None = None) -> DataFrame:
    """S1 + S2 + U1: files, folders and globs, one read per distinct header,
    unioned by name, missing columns -> null. Columns outside the canonical
    schema have the ``types`` given (a landing manifest knows them), or are typed
    by their values (``infer_unknown``, a scan of their own) or left as text."""
    groups = header_groups(spark, paths)
    if types is None:
        types = unknown_types(spark, groups, multi_line) if infer_unknown else {}
    if not groups:
        place = [T.StructField(source_col, T.StringType()), *(T.StructField(c, T.LongType()) for c in ("source_block", "source_row"))]
        known = schema_for([name for name in KNOWN_TYPES if name != "copy_no"]).fields
        return spark.createDataFrame([], T.StructType([*known, *(place if source_col else [])]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [read_csv_group(spark, files, source_col, list(columns), types, corrupt, multi_line)
                   for columns, files in groups.items()])


def load_report(spark: SparkSession, paths: list[str], multi_line: bool = False) -> DataFrame:
    """Per source file: records read, records that do not fit their schema, and
    records without a value in any column (keep all three when you aggregate
    further: Spark refuses a CSV read that needs the corrupt column alone)."""
    df = read_accident_csvs(spark, paths, "source_file", corrupt=True, multi_line=multi_line)
    fields = [F.col(f"`{c}`").cast("string") for c in df.columns
              if c not in (CORRUPT_COL, "source_file", "source_block", "source_row")]
    return (df.groupBy("source_file").agg(F.count(F.lit(1)).alias("records"), F.count(CORRUPT_COL).alias("corrupt"),
                                          F.count_if(F.coalesce(*fields).isNull()).alias("blank")))


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header in every part file, whitespace preserved."""
    (df.write.mode("overwrite")
       .option("header", "true")
       .option("ignoreLeadingWhiteSpace", "false")
       .option("ignoreTrailingWhiteSpace", "false")
       .option("escape", '"')
       .csv(path))
    return path


def file_report(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """S3: per source (a file or a folder of part files): part files, size in
    MB, rows, columns (from its header)."""
    parts = []
    for name, folder in folders.items():
        for columns, files in (header_groups(spark, [folder]) or {(): []}).items():
            if files:
                df = read_csv_group(spark, files, None, list(columns))
                parts.append(df.select(F.lit(name).alias("source_file"), F.lit(len(columns)).alias("columns"),
                                       F.col("_metadata.file_path").alias("_part"),
                                       F.col("_metadata.file_size").alias("_size")))
    if not parts:
        return spark.createDataFrame([], "source_file string, columns int, part_files bigint, size_mb double, rows bigint")
    per_part = (reduce(DataFrame.unionByName, parts).groupBy("source_file", "columns", "_part")
                .agg(F.count(F.lit(1)).alias("_rows"), F.max("_size").alias("_size")))
    return (per_part.groupBy("source_file", "columns")
                    .agg(F.count(F.lit(1)).alias("part_files"),
                         F.round(F.sum("_size") / F.lit(1024.0 * 1024.0), 2).alias("size_mb"),
                         F.sum("_rows").alias("rows")))
