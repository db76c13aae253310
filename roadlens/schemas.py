"""Schemas, column groups and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw accident relation (one row per reported accident, duplicates possible).
# Types are fixed up front instead of inferred per file: ``Time`` stays a
# string (inference turns ``17:42`` into a timestamp carrying today's date).
# ---------------------------------------------------------------------------
RAW_FIELDS: list[tuple[str, T.DataType]] = [
    ("Accident_Index", T.StringType()),
    ("Date", T.StringType()),
    ("Time", T.StringType()),
    ("Day_of_Week", T.IntegerType()),
    ("Accident_Severity", T.IntegerType()),
    ("Number_of_Casualties", T.IntegerType()),
    ("Number_of_Vehicles", T.IntegerType()),
    ("Latitude", T.DoubleType()),
    ("Longitude", T.DoubleType()),
    ("LSOA_of_Accident_Location", T.StringType()),
    ("Urban_or_Rural_Area", T.IntegerType()),
    ("Road_Type", T.StringType()),
    ("Speed_limit", T.IntegerType()),
    ("Junction_Detail", T.StringType()),
    ("Junction_Control", T.StringType()),
    ("Weather_Conditions", T.StringType()),
    ("Light_Conditions", T.StringType()),
    ("Road_Surface_Conditions", T.StringType()),
    ("Carriageway_Hazards", T.StringType()),
    ("2nd_Road_Class", T.StringType()),
    ("2nd_Road_Number", T.IntegerType()),
]
RAW_COLUMNS = [name for name, _ in RAW_FIELDS]
RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])

# Orders duplicates for "keep first": stands for the source file position.
SOURCE_ORDER_COL = "copy_no"

KEY_COL = "Accident_Index"

# ---------------------------------------------------------------------------
# Star schema column groups (natural keys of each dimension, fact layout).
# ---------------------------------------------------------------------------
DIM_TIME_COLS = ["Year_Derived", "Month_Num", "Quarter_Num", "Day_of_Week",
                 "DayOfWeek_Num", "Hour", "time_period", "is_weekend"]
DIM_GEO_COLS = ["LSOA_of_Accident_Location", "Urban_or_Rural_Area", "lsoa_available"]
DIM_ROAD_COLS = ["Road_Type", "Speed_limit", "Junction_Detail", "Junction_Control"]
DIM_ENV_COLS = ["Weather_Conditions", "Light_Conditions",
                "Road_Surface_Conditions", "Carriageway_Hazards"]

DIMENSIONS: dict[str, tuple[list[str], str]] = {
    "dim_time": (DIM_TIME_COLS, "time_key"),
    "dim_geography": (DIM_GEO_COLS, "geo_key"),
    "dim_road": (DIM_ROAD_COLS, "road_key"),
    "dim_environment": (DIM_ENV_COLS, "env_key"),
}

FACT_COLS = ["Accident_Index", "time_key", "geo_key", "road_key", "env_key",
             "Number_of_Casualties", "Number_of_Vehicles", "Accident_Severity",
             "Latitude", "Longitude", "Date_Parsed", "is_coordinate_valid",
             "Year_Derived"]
FACT_PARTITION_COL = "Year_Derived"

# Key columns checked after the star is written.
VALIDATED_KEYS: dict[str, list[str]] = {
    "fact_accidents": [KEY_COL, *[key for _, key in DIMENSIONS.values()]],
    **{name: [key] for name, (_, key) in DIMENSIONS.items()},
}

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the reference's for identical results.
# ---------------------------------------------------------------------------
DATE_PATTERN = "dd/MM/yyyy"
# Day-first shapes accepted by the lenient format check (X2), in order.
DAY_FIRST_PATTERNS = ("dd/MM/yyyy", "d/M/yyyy", "dd-MM-yyyy", "yyyy-MM-dd")
HOUR_REGEX = r"(\d{1,2}):(\d{2})"
HAZARD_PLACEHOLDER_REGEX = "data missing|out of range"

# (hour_lo, hour_hi, label); anything else, null included, is "Night".
TIME_PERIODS = [(6, 11, "Morning"), (12, 17, "Afternoon"), (18, 21, "Evening")]
NIGHT = "Night"
WEEKEND_DAYS = [1, 7]  # dayofweek: 1 = Sunday, 7 = Saturday

# Weather consolidation: ordered, first substring match wins, else unchanged.
WEATHER_RULES = [
    ("Fine no high winds", "Fine"),
    ("Fine + high winds", "Fine (High Winds)"),
    ("Raining no high winds", "Rain"),
    ("Raining + high winds", "Rain (High Winds)"),
    ("Snowing no high winds", "Snow"),
    ("Snowing + high winds", "Snow (High Winds)"),
    ("Fog or mist", "Fog / Mist"),
    ("Other", "Other"),
]

NO_JUNCTION_CONTROL = "No Junction Applicable"
HAZARD_NONE = "None"
SECOND_ROAD_CLASS_FILL = "N/A"
SECOND_ROAD_NUMBER_FILL = -1
UNKNOWN_FILLS = {
    "Junction_Detail": "No Junction",
    "Light_Conditions": "Unknown",
    "Road_Surface_Conditions": "Unknown",
    "Weather_Conditions": "Unknown",
    "Road_Type": "Unknown",
    "Urban_or_Rural_Area": "Unknown",
}

SEVERITY_LABELS = [(1, "Fatal"), (2, "Serious")]  # anything else: "Slight"
SEVERITY_ELSE = "Slight"
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
RUSH_HOURS = [7, 8, 9, 16, 17, 18]

UK_LAT_BOUNDS = (49.0, 61.0)
UK_LON_BOUNDS = (-8.0, 2.0)

IQR_COLUMNS = ["Number_of_Casualties", "Number_of_Vehicles", "Speed_limit"]
IQR_FACTOR = 1.5
SAMPLE_MAX_CHARS = 43
SAMPLE_KEEP_CHARS = 40

# Business-question parameters (as published).
BQ2_MIN_ACCIDENTS = 1000
BQ3_TOP = 20
BQ5_MIN_FATAL = 10
BQ5_TOP = 15
TOP_WEATHER = 6
WORST_KEYS = 5
CASUALTY_CAP_QUANTILE = 0.99
CASUALTY_EXTREME = 10
MISSING_BANDS = [(20.0, "high"), (5.0, "medium")]  # else "low"
