"""Independent DuckDB formulations of every checked query (the correctness
oracle). Written directly in SQL over the driver's pre-registered views, they
share nothing with the Spark code except the input fixture text.

Parity notes: DuckDB ``dayofweek`` is 0 = Sunday (Spark 1 = Sunday);
``year``/``month`` and window ranks are BIGINT (cast to INTEGER where Spark
returns int); ``SUM`` of integers is HUGEINT (cast to BIGINT); default NULL
ordering is NULLS LAST, so dense keys spell out NULLS FIRST.
"""

from __future__ import annotations

from roadlens.fixture import raw_sql_for_duckdb

HOUR_RE = r"(\d{1,2}):(\d{2})"

RAW_CTE = f"raw AS ({raw_sql_for_duckdb()})"

WEATHER_CASE = """CASE
      WHEN contains(Weather_Conditions, 'Fine no high winds') THEN 'Fine'
      WHEN contains(Weather_Conditions, 'Fine + high winds') THEN 'Fine (High Winds)'
      WHEN contains(Weather_Conditions, 'Raining no high winds') THEN 'Rain'
      WHEN contains(Weather_Conditions, 'Raining + high winds') THEN 'Rain (High Winds)'
      WHEN contains(Weather_Conditions, 'Snowing no high winds') THEN 'Snow'
      WHEN contains(Weather_Conditions, 'Snowing + high winds') THEN 'Snow (High Winds)'
      WHEN contains(Weather_Conditions, 'Fog or mist') THEN 'Fog / Mist'
      WHEN contains(Weather_Conditions, 'Other') THEN 'Other'
      ELSE Weather_Conditions END"""

HAZARD_CASE = """CASE WHEN regexp_matches(lower(Carriageway_Hazards), 'data missing|out of range')
      THEN NULL ELSE Carriageway_Hazards END"""

RAW_COLS = ('Accident_Index, Date, Time, Day_of_Week, Accident_Severity, Number_of_Casualties, '
            'Number_of_Vehicles, Latitude, Longitude, LSOA_of_Accident_Location, Urban_or_Rural_Area, '
            'Road_Type, Speed_limit, Junction_Detail, Junction_Control, Weather_Conditions, '
            'Light_Conditions, Road_Surface_Conditions, Carriageway_Hazards, "2nd_Road_Class", '
            '"2nd_Road_Number"')

DEDUP_CTE = f"""dedup AS (
  SELECT {RAW_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY Accident_Index ORDER BY copy_no) AS _rn FROM raw)
  WHERE _rn = 1)"""

# Step 1: calendar and hour; step 2: the rest.
STAGE_CTE = f"""stage AS (
  SELECT d.*, CAST(try_strptime(Date, '%d/%m/%Y') AS DATE) AS Date_Parsed,
         CAST(NULLIF(regexp_extract(CAST(Time AS VARCHAR), '{HOUR_RE}', 1), '') AS INTEGER) AS Hour
  FROM dedup d)"""

CLEAN_CTE = f"""clean AS (
  SELECT Accident_Index, Date, Time, Day_of_Week, Accident_Severity, Number_of_Casualties,
    Number_of_Vehicles, Latitude, Longitude, LSOA_of_Accident_Location, Urban_or_Rural_Area,
    COALESCE(Road_Type, 'Unknown') AS Road_Type,
    Speed_limit,
    COALESCE(Junction_Detail, 'No Junction') AS Junction_Detail,
    COALESCE(Junction_Control, 'No Junction Applicable') AS Junction_Control,
    COALESCE({WEATHER_CASE}, 'Unknown') AS Weather_Conditions,
    COALESCE(Light_Conditions, 'Unknown') AS Light_Conditions,
    COALESCE(Road_Surface_Conditions, 'Unknown') AS Road_Surface_Conditions,
    COALESCE({HAZARD_CASE}, 'None') AS Carriageway_Hazards,
    COALESCE("2nd_Road_Class", 'N/A') AS "2nd_Road_Class",
    COALESCE("2nd_Road_Number", -1) AS "2nd_Road_Number",
    Date_Parsed,
    CAST(year(Date_Parsed) AS INTEGER) AS Year_Derived,
    CAST(month(Date_Parsed) AS INTEGER) AS Month_Num,
    CAST(quarter(Date_Parsed) AS INTEGER) AS Quarter_Num,
    CAST(day(Date_Parsed) AS INTEGER) AS Day_Num,
    CAST(dayofweek(Date_Parsed) + 1 AS INTEGER) AS DayOfWeek_Num,
    Hour,
    CASE WHEN Hour BETWEEN 6 AND 11 THEN 'Morning' WHEN Hour BETWEEN 12 AND 17 THEN 'Afternoon'
         WHEN Hour BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Night' END AS time_period,
    COALESCE(dayofweek(Date_Parsed) + 1 IN (1, 7), false) AS is_weekend,
    LSOA_of_Accident_Location IS NOT NULL AS lsoa_available,
    Latitude IS NOT NULL AND Longitude IS NOT NULL AS is_coordinate_valid
  FROM stage)"""

DIM_COLS = {
    "dim_time": (["Year_Derived", "Month_Num", "Quarter_Num", "Day_of_Week", "DayOfWeek_Num",
                  "Hour", "time_period", "is_weekend"], "time_key"),
    "dim_geography": (["LSOA_of_Accident_Location", "Urban_or_Rural_Area", "lsoa_available"], "geo_key"),
    "dim_road": (["Road_Type", "Speed_limit", "Junction_Detail", "Junction_Control"], "road_key"),
    "dim_environment": (["Weather_Conditions", "Light_Conditions", "Road_Surface_Conditions",
                         "Carriageway_Hazards"], "env_key"),
}


def _dim_cte(name: str) -> str:
    cols, key = DIM_COLS[name]
    listed = ", ".join(cols)
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in cols)
    return (f"{name} AS (SELECT {listed}, row_number() OVER (ORDER BY {order}) AS {key} "
            f"FROM (SELECT DISTINCT {listed} FROM clean))")


def _fact_cte(null_safe: bool = False, name: str = "fact") -> str:
    op = "IS NOT DISTINCT FROM" if null_safe else "="
    joins = []
    for dim, alias in [("dim_time", "t"), ("dim_geography", "g"), ("dim_road", "r"), ("dim_environment", "e")]:
        cols, _ = DIM_COLS[dim]
        cond = " AND ".join(f"c.{c} {op} {alias}.{c}" for c in cols)
        joins.append(f"LEFT JOIN {dim} {alias} ON {cond}")
    return (f"{name} AS (SELECT c.Accident_Index, t.time_key, g.geo_key, r.road_key, e.env_key, "
            "c.Number_of_Casualties, c.Number_of_Vehicles, c.Accident_Severity, c.Latitude, c.Longitude, "
            "c.Date_Parsed, c.is_coordinate_valid, c.Year_Derived FROM clean c " + " ".join(joins) + ")")


DIMS_CTE = ",\n".join(_dim_cte(n) for n in DIM_COLS)
BASE = ",\n".join([RAW_CTE, DEDUP_CTE, STAGE_CTE, CLEAN_CTE])
STAR = ",\n".join([BASE, DIMS_CTE, _fact_cte()])
STAR_NULLSAFE = ",\n".join([BASE, DIMS_CTE, _fact_cte(null_safe=True)])


def with_raw(select: str) -> str:
    return f"WITH {RAW_CTE}\n{select}"


def with_base(select: str) -> str:
    return f"WITH {BASE}\n{select}"


def with_star(select: str, null_safe: bool = False) -> str:
    return f"WITH {STAR_NULLSAFE if null_safe else STAR}\n{select}"


SEV_LABEL = "CASE {c} WHEN 1 THEN 'Fatal' WHEN 2 THEN 'Serious' ELSE 'Slight' END"
DAY_LABEL = ("CASE {c} WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday' "
             "WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' "
             "WHEN 7 THEN 'Saturday' END")


BQ1 = """SELECT t.Year_Derived AS Year, t.Month_Num AS Month, COUNT(*) AS accident_count,
  CAST(RANK() OVER (PARTITION BY t.Year_Derived ORDER BY COUNT(*) DESC) AS INTEGER) AS month_rank_in_year
FROM fact f JOIN dim_time t ON f.time_key = t.time_key
GROUP BY t.Year_Derived, t.Month_Num"""


def rnd(expr: str, digits: int) -> str:
    """Round half-up on the decimal value (Spark rounds the shortest decimal
    form of a double; DuckDB would round the binary value)."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38, 9)), {digits}) AS DOUBLE)"


def pct(part: str, total: str, digits: int) -> str:
    return rnd(f"CAST({part} AS DOUBLE) * 100.0 / CAST({total} AS DOUBLE)", digits)


def q(name: str) -> str:
    return f'"{name}"'


RAW_TYPES = [
    ("Accident_Index", "string"), ("Date", "string"), ("Time", "string"), ("Day_of_Week", "int"),
    ("Accident_Severity", "int"), ("Number_of_Casualties", "int"), ("Number_of_Vehicles", "int"),
    ("Latitude", "double"), ("Longitude", "double"), ("LSOA_of_Accident_Location", "string"),
    ("Urban_or_Rural_Area", "int"), ("Road_Type", "string"), ("Speed_limit", "int"),
    ("Junction_Detail", "string"), ("Junction_Control", "string"), ("Weather_Conditions", "string"),
    ("Light_Conditions", "string"), ("Road_Surface_Conditions", "string"),
    ("Carriageway_Hazards", "string"), ("2nd_Road_Class", "string"), ("2nd_Road_Number", "int"),
]
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
FLOAT_COLS = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
DUCK_TO_SPARK = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
                 "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
                 "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE lower(typeof({c})) END")

PROFILED = "acc AS (SELECT * EXCLUDE (copy_no) FROM raw)"


def with_acc(select: str) -> str:
    return f"WITH {RAW_CTE},\n{PROFILED}\n{select}"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def schema_sql(table: str, cols: list[tuple[str, str | None]], first: str | None = None) -> str:
    parts = []
    for i, (c, t) in enumerate(cols, start=1):
        dtype = f"'{t}'" if t else f"(SELECT {DUCK_TO_SPARK.format(c=q(c))} FROM {table} LIMIT 1)"
        lo = f"arg_min({q(c)}, {first}) FILTER (WHERE {q(c)} IS NOT NULL)" if first else f"MIN({q(c)})"
        if t == "double" or (t is None and c in FLOAT_COLS):
            lo = f"({lo} + 0.0)"
        s = f"CAST({lo} AS VARCHAR)"
        sample = f"COALESCE(CASE WHEN length({s}) > 43 THEN substr({s}, 1, 40) || '...' ELSE {s} END, 'N/A')"
        parts.append(f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, {dtype} AS data_type, "
                     f"COUNT({q(c)}) AS non_null, {sample} AS sample FROM {table}")
    return _union(parts)


def missing_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({q(c)}) AS missing_count, "
             f"{pct(f'COUNT(*) - COUNT({q(c)})', 'COUNT(*)', 3)} AS missing_pct FROM acc" for c, _ in RAW_TYPES]
    return (f"SELECT *, CASE WHEN missing_pct > 20 THEN 'high' WHEN missing_pct > 5 THEN 'medium' "
            f"ELSE 'low' END AS band FROM ({_union(parts)}) WHERE missing_count > 0")


def numeric_sql() -> str:
    parts = []
    for c, t in RAW_TYPES:
        if t not in ("int", "double"):
            continue
        x = q(c)
        parts.append(f"SELECT '{c}' AS column_name, COUNT({x}) AS count, {rnd(f'AVG({x})', 4)} AS mean, "
                     f"{rnd(f'median({x})', 4)} AS median, {rnd(f'stddev_samp({x})', 4)} AS std, "
                     f"{rnd(f'MIN({x})', 4)} AS min, {rnd(f'MAX({x})', 4)} AS max FROM acc")
    return _union(parts)


def severity_dist_sql() -> str:
    return (f"SELECT Accident_Severity, COUNT(*) AS cnt, {pct('COUNT(*)', '(SELECT COUNT(*) FROM acc)', 2)} "
            "AS pct FROM acc WHERE Accident_Severity IS NOT NULL GROUP BY Accident_Severity")


STRICT_HOUR = ("CASE WHEN regexp_full_match(Time, '(\\d{1,2}):(\\d{1,2})') "
               "AND TRY_CAST(regexp_extract(Time, '^(\\d{1,2}):(\\d{1,2})$', 1) AS INTEGER) <= 23 "
               "AND TRY_CAST(regexp_extract(Time, '^(\\d{1,2}):(\\d{1,2})$', 2) AS INTEGER) <= 59 "
               "THEN TRY_CAST(regexp_extract(Time, '^(\\d{1,2}):(\\d{1,2})$', 1) AS INTEGER) END")


def iqr_sql() -> str:
    parts = []
    for c in ["Number_of_Casualties", "Number_of_Vehicles", "Speed_limit"]:
        x = q(c)
        invalid = f"COUNT(*) FILTER (WHERE {x} <= 0)" if c == "Speed_limit" else None
        parts.append(
            f"SELECT '{c}' AS column_name, q1, q3, q3 - q1 AS iqr, q1 - (q3 - q1) * 1.5 AS lower, "
            f"q3 + (q3 - q1) * 1.5 AS upper, "
            f"(SELECT COUNT(*) FROM acc WHERE {x} < q1 - (q3 - q1) * 1.5 OR {x} > q3 + (q3 - q1) * 1.5) AS outliers, "
            f"{pct(f'(SELECT COUNT(*) FROM acc WHERE {x} < q1 - (q3 - q1) * 1.5 OR {x} > q3 + (q3 - q1) * 1.5)', f'(SELECT COUNT({x}) FROM acc)', 3)} AS outlier_pct, "
            f"{f'(SELECT {invalid} FROM acc)' if invalid else 'CAST(0 AS BIGINT)'} AS invalid, "
            f"{pct(f'(SELECT {invalid} FROM acc)', f'(SELECT COUNT({x}) FROM acc)', 3) if invalid else 'CAST(0 AS DOUBLE)'} AS invalid_pct "
            f"FROM (SELECT CAST(quantile_cont({x}, 0.25) AS DOUBLE) AS q1, "
            f"CAST(quantile_cont({x}, 0.75) AS DOUBLE) AS q3 FROM acc)")
    return _union(parts)


def validate_sql() -> str:
    own = {dim: [key] for dim, (_, key) in DIM_COLS.items()}
    keys = {"fact_accidents": ["Accident_Index", *[key for _, key in DIM_COLS.values()]], **own}
    parts = []
    for table, cols in keys.items():
        src = "fact" if table == "fact_accidents" else table
        for c in cols:
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) AS rows, "
                         f"COUNT(*) - COUNT({c}) AS nulls, COUNT(*) = COUNT({c}) AS ok FROM {src}")
    return _union(parts)


def integrity_sql() -> str:
    parts = []
    for dim, (_, key) in DIM_COLS.items():
        parts.append(
            f"SELECT '{dim}' AS table_name, (SELECT COUNT(*) FROM {dim}) AS rows, "
            f"(SELECT COUNT(DISTINCT {key}) FROM {dim}) AS distinct_keys, "
            f"(SELECT COUNT(*) - COUNT(DISTINCT {key}) FROM {dim}) AS duplicate_keys, "
            f"(SELECT COUNT(*) FROM fact WHERE {key} IS NULL) AS null_fk_rows, "
            f"(SELECT COUNT(*) FROM fact f WHERE f.{key} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})) AS orphan_fact_rows")
    return _union(parts)


def source_file_expr() -> str:
    return ("CASE WHEN copy_no = 2 THEN 'accidents_3.csv' "
            "WHEN CAST(substr(Accident_Index, 2, 9) AS BIGINT) % 2 = 0 THEN 'accidents_1.csv' "
            "ELSE 'accidents_2.csv' END")


def final_stats_sql() -> str:
    sizes = _union([
        "SELECT 'size' AS section, 'accidents' AS item, 'rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM acc",
        "SELECT 'size', 'traffic_flow', 'rows', CAST(COUNT(*) AS DOUBLE) FROM lineitem",
        "SELECT 'size', 'accidents', 'columns', CAST(21 AS DOUBLE)",
        "SELECT 'size', 'traffic_flow', 'columns', "
        "CAST((SELECT COUNT(*) FROM information_schema.columns WHERE table_name = 'lineitem') AS DOUBLE)"])
    sev = (f"SELECT 'severity', CAST(Accident_Severity AS VARCHAR), 'pct', pct FROM ({severity_dist_sql()})")
    miss = (f"SELECT 'missing', column_name, 'pct', missing_pct FROM ({missing_sql()}) "
            "ORDER BY missing_pct DESC, column_name LIMIT 5")
    num = _union([f"SELECT 'numeric', column_name, '{m}', {m} FROM ({numeric_sql()})"
                  for m in ["mean", "median", "std", "min", "max"]])
    return _union([sizes, sev, f"SELECT * FROM ({miss})", num])


ORACLES: dict[str, str] = {}


def _register() -> None:
    o = ORACLES
    # sources
    o["raw_union"] = with_raw('SELECT * REPLACE (CASE WHEN copy_no = 2 THEN NULL ELSE "2nd_Road_Number" END '
                              'AS "2nd_Road_Number") FROM raw')
    o["csv_roundtrip"] = o["raw_union"]
    o["landing_roundtrip"] = with_raw(
        f"SELECT CAST(2026 AS INTEGER) AS year, CAST(4 AS INTEGER) AS month, source_file, COUNT(*) AS rows "
        f"FROM (SELECT {source_file_expr()} AS source_file FROM raw) GROUP BY source_file")
    o["csv_glob_union"] = o["raw_union"]
    o["csv_folder_mixed_headers"] = with_raw(
        "SELECT Accident_Index, copy_no, Accident_Severity, Speed_limit, "
        "CAST(Accident_Severity * 10 AS BIGINT) AS severity_x_ten FROM raw")
    o["csv_corrupt_counts"] = with_raw(
        "SELECT COUNT(*) AS records, COUNT(*) FILTER (WHERE Speed_limit = 30) AS corrupt, "
        "CAST(0 AS BIGINT) AS blank FROM raw")
    per_file = f"(SELECT {source_file_expr()} AS source_file FROM raw) GROUP BY source_file"
    o["file_report"] = with_raw(
        "SELECT source_file, CAST(CASE source_file WHEN 'accidents_3.csv' THEN 21 ELSE 22 END AS INTEGER) AS columns, "
        f"COUNT(*) AS rows FROM {per_file}")
    o["file_checks"] = with_raw(f"SELECT source_file, COUNT(*) AS rows, true AS valid_utf8 FROM {per_file}")
    written = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 WHEN {c} = '' THEN 2 ELSE strlen({c}) END"
                         for c in ["Accident_Index", '"Date"', '"Time"', "Road_Type", "Weather_Conditions"])
    o["landed_sizes"] = with_raw(
        f"SELECT source_file, COUNT(*) AS rows, round(CAST(SUM(n) AS DOUBLE) / 1048576, 6) AS data_mb "
        f"FROM (SELECT {source_file_expr()} AS source_file, {written} + 5 AS n FROM raw) GROUP BY source_file")
    csv_types = {"l_linenumber": "bigint", **{c: "double" for c in FLOAT_COLS}}
    o["secondary_csv_types"] = _union(
        [f"SELECT '{c}' AS column_name, '{csv_types.get(c, 'bigint' if c.endswith('key') else 'string')}' AS data_type, "
         f"COUNT({c}) AS non_null FROM lineitem" for c in LINEITEM_COLS])
    o["secondary_source_totals"] = with_raw(
        "SELECT (SELECT COUNT(*) FROM raw) AS accident_rows, (SELECT COUNT(*) FROM lineitem) AS traffic_flow_rows, "
        "CAST((SELECT COUNT(*) FROM information_schema.columns WHERE table_name = 'lineitem') AS INTEGER) "
        "AS traffic_flow_columns, (SELECT COUNT(*) FROM raw) + (SELECT COUNT(*) FROM lineitem) AS grand_total")
    o["star_parquet_roundtrip"] = with_star(_union(
        ["SELECT 'fact_accidents' AS table_name, COUNT(*) AS rows FROM fact"]
        + [f"SELECT '{d}', COUNT(*) FROM {d}" for d in DIM_COLS]))
    o["year_pruned_count"] = with_star(
        "SELECT Year_Derived, COUNT(*) AS accidents, CAST(SUM(Number_of_Casualties) AS BIGINT) AS casualties "
        "FROM fact WHERE Year_Derived = 1996 GROUP BY Year_Derived")
    o["views_road_vehicles"] = with_star(
        "SELECT Road_Type, CAST(SUM(Number_of_Vehicles) AS BIGINT) AS vehicles FROM fact JOIN dim_road USING (road_key) "
        "WHERE Number_of_Casualties >= 3 GROUP BY Road_Type")
    o["dynamic_overwrite_totals"] = with_star(
        "SELECT Year_Derived, COUNT(*) AS accidents, CAST(SUM(Number_of_Casualties + CASE WHEN Year_Derived = 1996 "
        "THEN 1 ELSE 0 END) AS BIGINT) AS casualties FROM fact GROUP BY Year_Derived")
    o["hashed_keys_roads"] = with_base("SELECT Accident_Index, Road_Type, Speed_limit, Junction_Detail, Junction_Control FROM clean")
    # dedup
    o["dedup_accidents"] = with_base("SELECT * FROM dedup")
    o["dedup_mostly_unique"] = with_base("SELECT * FROM dedup")
    o["dedup_summary"] = with_raw(
        'SELECT COUNT(*) AS "before", COUNT(DISTINCT Accident_Index) + MAX(CASE WHEN Accident_Index IS NULL '
        'THEN 1 ELSE 0 END) AS "after", COUNT(*) - COUNT(DISTINCT Accident_Index) - MAX(CASE WHEN '
        'Accident_Index IS NULL THEN 1 ELSE 0 END) AS removed FROM raw')
    # cleaning
    o["clean_calendar"] = with_base("SELECT Accident_Index, Date, Date_Parsed, Year_Derived, Month_Num, "
                                    "Quarter_Num, Day_Num, DayOfWeek_Num FROM clean")
    o["clean_hour"] = with_base("SELECT Accident_Index, Time, Hour FROM clean")
    o["clean_hour_strict"] = with_base("SELECT Accident_Index, Time, CASE WHEN Hour <= 23 THEN Hour END AS Hour "
                                       "FROM clean")
    o["clean_period_weekend"] = with_base("SELECT Accident_Index, Hour, DayOfWeek_Num, time_period, is_weekend "
                                          "FROM clean")
    o["clean_junction"] = with_base("SELECT Accident_Index, Junction_Control FROM clean")
    o["clean_second_road"] = with_base('SELECT Accident_Index, "2nd_Road_Class", "2nd_Road_Number" FROM clean')
    o["clean_hazards"] = with_base("SELECT Accident_Index, Carriageway_Hazards FROM clean")
    o["clean_weather"] = with_base(f"SELECT Accident_Index, {WEATHER_CASE} AS Weather_Conditions FROM dedup")
    o["clean_flags"] = with_base("SELECT Accident_Index, lsoa_available, is_coordinate_valid FROM clean")
    o["clean_unknowns"] = with_base(
        "SELECT Accident_Index, COALESCE(Junction_Detail, 'No Junction') AS Junction_Detail, "
        "COALESCE(Light_Conditions, 'Unknown') AS Light_Conditions, "
        "COALESCE(Road_Surface_Conditions, 'Unknown') AS Road_Surface_Conditions, "
        "COALESCE(Weather_Conditions, 'Unknown') AS Weather_Conditions, "
        "COALESCE(Road_Type, 'Unknown') AS Road_Type, Urban_or_Rural_Area FROM dedup")
    o["coordinate_bounds"] = with_base(
        "SELECT Accident_Index, Latitude, Longitude, Latitude IS NOT NULL AND Longitude IS NOT NULL "
        "AND Latitude BETWEEN 49 AND 61 AND Longitude BETWEEN -8 AND 2 AS is_coordinate_valid FROM dedup")
    o["impute_speed_median"] = with_base(
        "SELECT c.Accident_Index, c.Road_Type, CASE WHEN c.Speed_limit <= 0 AND m.med IS NOT NULL "
        "THEN CAST(ROUND(m.med) AS INTEGER) ELSE c.Speed_limit END AS Speed_limit FROM clean c LEFT JOIN "
        "(SELECT Road_Type, median(Speed_limit) AS med FROM clean WHERE Speed_limit > 0 GROUP BY Road_Type) m "
        "ON c.Road_Type = m.Road_Type")
    o["clean_all"] = with_base("SELECT * FROM clean")
    o["clean_from_csv"] = o["clean_all"]
    # star
    for d in DIM_COLS:
        o[d] = with_star(f"SELECT * FROM {d}")
    o["fact_accidents"] = with_star("SELECT * FROM fact")
    o["fact_nullsafe"] = with_star("SELECT * FROM fact", null_safe=True)
    o["validate_star"] = with_star(validate_sql())
    o["integrity_star"] = with_star(integrity_sql())
    o["etl_summary"] = with_star("SELECT (SELECT COUNT(*) FROM raw) AS raw_rows, "
                                 "(SELECT COUNT(*) FROM clean) AS clean_rows, (SELECT COUNT(*) FROM fact) AS fact_rows")
    # questions
    o["bq1_monthly_rank"] = with_star(BQ1)
    o["bq1_nullsafe"] = with_star(BQ1, null_safe=True)
    o["bq2_road_vulnerability"] = with_star(
        f"SELECT r.Road_Type, g.Urban_or_Rural_Area, COUNT(*) AS total_accidents, "
        f"{rnd('AVG(f.Number_of_Casualties)', 2)} AS avg_casualties, "
        "CAST(ROW_NUMBER() OVER (ORDER BY AVG(f.Number_of_Casualties) DESC, r.Road_Type NULLS FIRST, "
        "g.Urban_or_Rural_Area NULLS FIRST) AS INTEGER) AS vulnerability_rank "
        "FROM fact f JOIN dim_road r ON f.road_key = r.road_key JOIN dim_geography g ON f.geo_key = g.geo_key "
        "GROUP BY r.Road_Type, g.Urban_or_Rural_Area HAVING COUNT(*) > 1000")
    o["bq3_hotspots"] = with_star(
        f"SELECT g.LSOA_of_Accident_Location AS LSOA, g.Urban_or_Rural_Area, COUNT(*) AS total_accidents, "
        f"CAST(SUM(f.Number_of_Casualties) AS BIGINT) AS total_casualties, "
        f"{rnd('AVG(f.Number_of_Casualties)', 2)} AS avg_casualties "
        "FROM fact f JOIN dim_geography g ON f.geo_key = g.geo_key WHERE g.lsoa_available = true "
        "GROUP BY g.LSOA_of_Accident_Location, g.Urban_or_Rural_Area "
        "ORDER BY total_accidents DESC, LSOA NULLS FIRST, g.Urban_or_Rural_Area NULLS FIRST LIMIT 20")
    o["bq4_junction_severity"] = with_star(
        f"SELECT r.Junction_Control, f.Accident_Severity, COUNT(*) AS accident_count, "
        f"CAST(SUM(f.Number_of_Casualties) AS BIGINT) AS total_casualties, "
        f"{rnd('AVG(f.Number_of_Casualties)', 2)} AS avg_casualties "
        "FROM fact f JOIN dim_road r ON f.road_key = r.road_key GROUP BY r.Junction_Control, f.Accident_Severity")
    o["bq5_fatal_combos"] = with_star(
        "SELECT r.Road_Type, r.Speed_limit, e.Weather_Conditions, COUNT(*) AS fatal_count, "
        "CAST(SUM(f.Number_of_Casualties) AS BIGINT) AS total_casualties "
        "FROM fact f JOIN dim_road r ON f.road_key = r.road_key JOIN dim_environment e ON f.env_key = e.env_key "
        "WHERE f.Accident_Severity = 1 GROUP BY r.Road_Type, r.Speed_limit, e.Weather_Conditions "
        "HAVING COUNT(*) > 10 ORDER BY fatal_count DESC, r.Road_Type NULLS FIRST, r.Speed_limit NULLS FIRST, "
        "e.Weather_Conditions NULLS FIRST LIMIT 15")
    o["fatal_combos_all"] = with_star(
        "SELECT r.Road_Type, r.Speed_limit, e.Weather_Conditions, COUNT(*) AS fatal_count "
        "FROM fact f JOIN dim_road r ON f.road_key = r.road_key JOIN dim_environment e ON f.env_key = e.env_key "
        "WHERE f.Accident_Severity = 1 GROUP BY r.Road_Type, r.Speed_limit, e.Weather_Conditions")
    o["month_series"] = with_star(
        "SELECT concat_ws('-', CAST(Year AS VARCHAR), lpad(CAST(Month AS VARCHAR), 2, '0')) AS date_label, "
        f"accident_count FROM ({BQ1})")
    day = DAY_LABEL.format(c="t.Day_of_Week")
    o["severity_by_weekday"] = with_star(
        f"SELECT {day} AS Day_of_Week, t.Day_of_Week AS day_order, "
        "COUNT(*) FILTER (WHERE f.Accident_Severity = 1) AS Fatal, "
        "COUNT(*) FILTER (WHERE f.Accident_Severity = 2) AS Serious, "
        "COUNT(*) FILTER (WHERE f.Accident_Severity IS NULL OR f.Accident_Severity NOT IN (1, 2)) AS Slight "
        f"FROM fact f JOIN dim_time t ON f.time_key = t.time_key GROUP BY t.Day_of_Week HAVING {day} IS NOT NULL")
    hours = ", ".join(f'COUNT(*) FILTER (WHERE t.Hour = {h}) AS "{h}"' for h in range(24))
    o["weekday_hour_matrix"] = with_star(
        f"SELECT {day} AS Day_of_Week, t.Day_of_Week AS day_order, {hours} "
        "FROM fact f JOIN dim_time t ON f.time_key = t.time_key WHERE t.Hour IS NOT NULL "
        f"GROUP BY t.Day_of_Week HAVING {day} IS NOT NULL")
    o["severity_share"] = with_star(
        f"SELECT {SEV_LABEL.format(c='sev')} AS Accident_Severity, cnt, "
        f"{pct('cnt', 'SUM(cnt) OVER ()', 2)} AS pct "
        "FROM (SELECT Accident_Severity AS sev, COUNT(*) AS cnt FROM fact GROUP BY Accident_Severity)")
    o["hourly_rush"] = with_star(
        "SELECT t.Hour, COUNT(*) AS cnt, t.Hour IN (7, 8, 9, 16, 17, 18) AS is_rush "
        "FROM fact f JOIN dim_time t ON f.time_key = t.time_key WHERE t.Hour IS NOT NULL GROUP BY t.Hour")
    o["yearly_trend"] = with_star("SELECT Year_Derived AS yr, COUNT(*) AS cnt FROM fact GROUP BY Year_Derived")
    o["top_weather"] = with_star(
        "SELECT e.Weather_Conditions AS weather, COUNT(*) AS cnt FROM fact f JOIN dim_environment e "
        "ON f.env_key = e.env_key GROUP BY e.Weather_Conditions ORDER BY cnt DESC, weather NULLS FIRST LIMIT 6")
    # profiling
    o["profile_schema"] = with_raw(schema_sql("raw", [(c, t) for c, t in RAW_TYPES], "concat(copy_no, Accident_Index)"))
    o["profile_secondary_schema"] = schema_sql("lineitem", [(c, None) for c in LINEITEM_COLS])
    o["profile_missing"] = with_acc(missing_sql())
    o["profile_numeric"] = with_acc(numeric_sql())
    o["dist_severity"] = with_acc(severity_dist_sql())
    o["dist_speed"] = with_acc("SELECT Speed_limit, COUNT(*) AS cnt FROM acc WHERE Speed_limit > 0 GROUP BY Speed_limit")
    o["speed_invalid"] = with_acc(
        f"SELECT COUNT(*) FILTER (WHERE Speed_limit <= 0) AS invalid_count, "
        f"{pct('COUNT(*) FILTER (WHERE Speed_limit <= 0)', 'COUNT(*)', 3)} AS invalid_pct FROM acc")
    o["dist_casualties"] = with_acc(
        "SELECT CAST(b.v AS INTEGER) AS Number_of_Casualties, COALESCE(c.cnt, 0) AS cnt FROM "
        "(SELECT unnest(generate_series(1, CAST(floor(quantile_cont(Number_of_Casualties, 0.99)) AS BIGINT))) AS v "
        "FROM acc) b LEFT JOIN (SELECT Number_of_Casualties AS v, COUNT(*) AS cnt FROM acc GROUP BY 1) c ON b.v = c.v")
    o["casualty_stats"] = with_acc(
        f"SELECT {rnd('AVG(Number_of_Casualties)', 4)} AS mean, {rnd('median(Number_of_Casualties)', 4)} AS median, "
        "MAX(Number_of_Casualties) AS max, COUNT(*) FILTER (WHERE Number_of_Casualties > 10) AS extreme_count, "
        f"{pct('COUNT(*) FILTER (WHERE Number_of_Casualties > 10)', 'COUNT(Number_of_Casualties)', 3)} AS extreme_pct "
        "FROM acc")
    o["casualty_box"] = with_acc(
        "SELECT q1, med AS median, q3, q3 - q1 AS iqr, "
        "(SELECT MIN(Number_of_Casualties) FROM acc WHERE Number_of_Casualties BETWEEN lo AND hi) AS whisker_low, "
        "(SELECT MAX(Number_of_Casualties) FROM acc WHERE Number_of_Casualties BETWEEN lo AND hi) AS whisker_high, "
        "(SELECT COUNT(*) FROM acc WHERE Number_of_Casualties NOT BETWEEN lo AND hi) AS fliers "
        "FROM (SELECT q1, med, q3, q1 - (q3 - q1) * 1.5 AS lo, q3 + (q3 - q1) * 1.5 AS hi FROM "
        "(SELECT CAST(quantile_cont(Number_of_Casualties, 0.25) AS DOUBLE) AS q1, "
        "CAST(quantile_cont(Number_of_Casualties, 0.5) AS DOUBLE) AS med, "
        "CAST(quantile_cont(Number_of_Casualties, 0.75) AS DOUBLE) AS q3 FROM acc))")
    o["dist_hour"] = with_acc(
        f"SELECT Hour, COUNT(*) AS cnt, Hour IN (7, 8, 9, 16, 17, 18) AS is_peak FROM "
        f"(SELECT {STRICT_HOUR} AS Hour FROM acc) WHERE Hour IS NOT NULL GROUP BY Hour")
    o["peak_hour"] = with_acc(
        f"SELECT (SELECT Hour FROM h WHERE Hour IS NOT NULL ORDER BY cnt DESC, Hour ASC LIMIT 1) AS peak_hour, "
        "CAST(COALESCE((SELECT SUM(cnt) FROM h WHERE Hour IS NULL), 0) AS BIGINT) AS unparseable")
    o["peak_hour"] = o["peak_hour"].replace(
        f"{PROFILED}\n", f"{PROFILED},\nh AS (SELECT Hour, COUNT(*) AS cnt FROM (SELECT {STRICT_HOUR} AS Hour FROM acc) GROUP BY Hour)\n")
    o["dist_weekday"] = with_acc(
        f"SELECT {DAY_LABEL.format(c='d.d')} AS day_name, CAST(((d.d + 5) % 7) + 1 AS INTEGER) AS day_order, "
        "COALESCE(c.cnt, 0) AS cnt, d.d IN (1, 7) AS is_weekend FROM "
        "(SELECT CAST(unnest(generate_series(1, 7)) AS INTEGER) AS d) d LEFT JOIN "
        "(SELECT Day_of_Week, COUNT(*) AS cnt FROM acc WHERE Day_of_Week IS NOT NULL GROUP BY Day_of_Week) c "
        "ON d.d = c.Day_of_Week")
    all_cols = ", ".join(q(c) for c, _ in RAW_TYPES)
    o["duplicate_report"] = with_acc(
        f"SELECT CAST(SUM(c - 1) AS BIGINT) AS full_row_dups, {pct('SUM(c - 1)', 'SUM(c)', 4)} AS full_row_pct, "
        "(SELECT CAST(SUM(k - 1) AS BIGINT) FROM (SELECT COUNT(*) AS k FROM acc GROUP BY Accident_Index)) AS key_dups, "
        f"{pct('(SELECT SUM(k - 1) FROM (SELECT COUNT(*) AS k FROM acc GROUP BY Accident_Index))', 'SUM(c)', 4)} "
        f"AS key_pct FROM (SELECT COUNT(*) AS c FROM acc GROUP BY {all_cols})")
    o["worst_keys"] = with_acc(
        "SELECT Accident_Index, COUNT(*) AS cnt FROM acc WHERE Accident_Index IS NOT NULL "
        "GROUP BY Accident_Index HAVING COUNT(*) > 1 ORDER BY cnt DESC, Accident_Index LIMIT 5")
    o["iqr_outliers"] = with_acc(iqr_sql())
    box = ("(Latitude < 49 OR Latitude > 61 OR Longitude < -8 OR Longitude > 2)")
    checks_cols = {
        "bad_dates": "COUNT(*) FILTER (WHERE COALESCE(try_strptime(Date, '%d/%m/%Y'), "
                     "try_strptime(Date, '%d-%m-%Y'), try_strptime(Date, '%Y-%m-%d')) IS NULL)",
        "bad_times": f"COUNT(*) FILTER (WHERE ({STRICT_HOUR}) IS NULL)",
        "out_of_bounds": f"COUNT(*) FILTER (WHERE COALESCE({box}, false))",
        "missing_geo": "COUNT(*) FILTER (WHERE Latitude IS NULL OR Longitude IS NULL)",
    }
    o["format_checks"] = with_acc("SELECT " + ", ".join(
        f"{e} AS {n}, {pct(e, 'COUNT(*)', 3)} AS {n}_pct" for n, e in checks_cols.items()) + " FROM acc")
    o["whitespace_report"] = with_acc(
        "SELECT * FROM (" + _union([
            f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {q(c)} LIKE ' %') AS \"leading\", "
            f"COUNT(*) FILTER (WHERE {q(c)} LIKE '% ') AS \"trailing\" FROM acc"
            for c, t in RAW_TYPES if t == "string"]) + ') WHERE "leading" + "trailing" > 0')
    o["final_stats"] = with_acc(final_stats_sql())
    o["validate_published"] = o["validate_star"]
    for name in ("bq1_monthly_rank", "bq2_road_vulnerability", "bq3_hotspots", "bq4_junction_severity", "bq5_fatal_combos", "month_series",
                 "severity_by_weekday", "weekday_hour_matrix", "severity_share", "hourly_rush", "yearly_trend", "top_weather"):
        o[f"rollup_{name}"] = o[name]  # the questions are the same


_register()
