"""The raw accident relation derived from the driver tables.

The reference's inputs are road-accident CSVs that are not available, so the
raw relation is derived from ``orders`` joined with ``customer``: one SQL text
that Spark and DuckDB both run (Spark gets DataFrames through ``spark.sql``
keyword substitution, DuckDB gets the pre-registered views). It grows linearly
with the scale factor and injects the dirt the cleaning steps exist for:
duplicate keys (half identical rows, half with a changed measure), null,
garbage and timestamp-shaped times, impossible dates, missing areas, null and
out-of-bounds coordinates, zero speed limits, placeholder hazards, nulls in
categorical columns, leading/trailing spaces.

``copy_no`` stands for the source file; it orders "keep first" and is left out
of full-row duplicate checks and of the cleaned table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens.sources.tables import load_table

# ``{dow}`` is 0 for Spark (dayofweek 1 = Sunday) and 1 for DuckDB (0 = Sunday).
RAW_SQL = """
WITH base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderdate AS d, o.o_orderstatus AS st,
         o.o_orderpriority AS pr, c.c_nationkey AS nk, 1 AS copy_no
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey),
allrows AS (
  SELECT * FROM base
  UNION ALL
  SELECT k, ck, d, st, pr, nk, 2 AS copy_no FROM base WHERE k % 10 = 0)
SELECT concat('A', lpad(CAST(k AS STRING), 9, '0')) AS Accident_Index, copy_no,
  CASE WHEN k % 97 = 0 THEN '99/99/9999'
       ELSE concat(lpad(CAST(day(d) AS STRING), 2, '0'), '/', lpad(CAST(month(d) AS STRING), 2, '0'),
                   '/', CAST(year(d) AS STRING)) END AS Date,
  CASE WHEN k % 53 = 0 THEN NULL
       WHEN k % 101 = 0 THEN 'xx'
       WHEN k % 31 = 0 THEN concat('2026-05-04 ', lpad(CAST((k * 7) % 24 AS STRING), 2, '0'), ':',
                                   lpad(CAST((k * 13) % 60 AS STRING), 2, '0'))
       ELSE concat(lpad(CAST((k * 7) % 24 AS STRING), 2, '0'), ':',
                   lpad(CAST((k * 13) % 60 AS STRING), 2, '0')) END AS Time,
  CAST(dayofweek(d) + {dow} AS INT) AS Day_of_Week,
  CASE st WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS Accident_Severity,
  CAST(CASE WHEN k % 211 = 0 THEN 25 ELSE 1 + (k % 7) * (k % 3) END AS INT) AS Number_of_Casualties,
  CAST(1 + ck % 4 + CASE WHEN copy_no = 2 AND k % 20 = 0 THEN 1 ELSE 0 END AS INT) AS Number_of_Vehicles,
  CAST(CASE WHEN k % 149 = 0 THEN NULL WHEN k % 139 = 0 THEN 99.0 ELSE 49.0 + nk * 0.5 END AS DOUBLE) AS Latitude,
  CAST(CASE WHEN k % 151 = 0 THEN NULL ELSE -8.0 + nk * 0.4 END AS DOUBLE) AS Longitude,
  CASE WHEN k % 11 = 0 THEN NULL ELSE concat('E', lpad(CAST(ck % 60 AS STRING), 8, '0')) END
    AS LSOA_of_Accident_Location,
  CAST(1 + nk % 3 AS INT) AS Urban_or_Rural_Area,
  CASE ck % 5 WHEN 0 THEN 'Single carriageway' WHEN 1 THEN 'Dual carriageway'
              WHEN 2 THEN 'Roundabout' WHEN 3 THEN 'One way street' END AS Road_Type,
  CAST(CASE WHEN k % 127 = 0 THEN 0 ELSE 20 + 10 * (ck % 6) END AS INT) AS Speed_limit,
  CASE k % 4 WHEN 0 THEN 'Crossroads' WHEN 1 THEN ' T or staggered junction'
             WHEN 2 THEN 'Roundabout ' END AS Junction_Detail,
  CASE k % 3 WHEN 0 THEN 'Give way or uncontrolled' WHEN 1 THEN 'Automatic traffic signal' END
    AS Junction_Control,
  CASE k % 9 WHEN 0 THEN 'Fine no high winds' WHEN 1 THEN 'Fine + high winds'
             WHEN 2 THEN 'Raining no high winds' WHEN 3 THEN 'Raining + high winds'
             WHEN 4 THEN 'Snowing no high winds' WHEN 5 THEN 'Snowing + high winds'
             WHEN 6 THEN 'Fog or mist' WHEN 7 THEN 'Other' END AS Weather_Conditions,
  pr AS Light_Conditions,
  CASE nk % 4 WHEN 0 THEN 'Dry' WHEN 1 THEN 'Wet or damp' WHEN 2 THEN 'Snow' END AS Road_Surface_Conditions,
  CASE k % 6 WHEN 0 THEN 'None' WHEN 1 THEN 'Data missing or out of range'
             WHEN 2 THEN 'Other object in carriageway' END AS Carriageway_Hazards,
  CASE WHEN k % 2 = 0 THEN 'A' END AS `2nd_Road_Class`,
  CAST(CASE WHEN k % 2 = 0 THEN k % 500 END AS INT) AS `2nd_Road_Number`
FROM allrows
"""


def raw_sql_for_duckdb() -> str:
    """The same text for DuckDB: views by name, Sunday = 0, double quotes."""
    return RAW_SQL.format(orders="orders", customer="customer", dow=1).replace("`", '"')


def raw_accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw accident rows (with ``copy_no``) over the tables in ``sf_dir``."""
    orders = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return spark.sql(RAW_SQL, orders=orders, customer=customer, dow=0)


def source_files(raw: DataFrame) -> dict[str, DataFrame]:
    """The raw rows as three source files: first copies with even numbers,
    first copies with odd numbers, second copies (without ``2nd_Road_Number``,
    so the files' columns differ)."""
    number = F.substring(F.col("Accident_Index"), 2, 9).cast("long")
    first = F.col("copy_no") == 1
    return {
        "accidents_1.csv": raw.filter(first & (number % 2 == 0)),
        "accidents_2.csv": raw.filter(first & (number % 2 == 1)),
        "accidents_3.csv": raw.filter(~first).drop("2nd_Road_Number"),
    }


def secondary_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second, never-modelled source (traffic-flow counts in the reference)."""
    return load_table(spark, sf_dir, "lineitem")
