"""Column helpers and single cleaning steps on small literal frames."""

from pyspark.sql import functions as F, types as T

from roadlens.functions.fill import fill_nulls
from roadlens.functions.labels import (month_label, monday_first_ordinal, severity_label,
                                       truncate_sample, weekday_name)
from roadlens.functions.parsing import lenient_hour, parse_day_first_date, strict_hour
from roadlens.operators import clean as C


def _one_col(spark, values, dtype="string", name="v"):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, T.StringType() if dtype == "string" else T.IntegerType())]))


def test_lenient_hour(spark):
    vals = ["17:42", "2026-05-04 22:30:00", "9:05", "", None, "xx", "99:99"]
    got = [r[0] for r in _one_col(spark, vals).select(lenient_hour(F.col("v"))).collect()]
    assert got == [17, 22, 9, None, None, None, 99]
    strict = [r[0] for r in _one_col(spark, vals).select(lenient_hour(F.col("v"), strict=True)).collect()]
    assert strict == [17, 22, 9, None, None, None, None]


def test_strict_clock_hour(spark):
    vals = ["17:42", "9:05", "2026-05-04 22:30", "24:00", "12:60", "xx", None]
    got = [r[0] for r in _one_col(spark, vals).select(strict_hour(F.col("v"))).collect()]
    assert got == [17, 9, None, None, None, None, None]


def test_day_first_date(spark):
    vals = ["28/05/1997", "99/99/9999", "31/02/2001", None]
    got = [r[0] for r in _one_col(spark, vals).select(parse_day_first_date(F.col("v"))).collect()]
    assert str(got[0]) == "1997-05-28" and got[1:] == [None, None, None]


def test_period_and_weekend(spark):
    df = spark.createDataFrame([(h, d) for h, d in [(None, None), (5, 1), (6, 2), (11, 3), (12, 4),
                                                     (17, 5), (18, 6), (21, 7), (22, 2)]],
                               "Hour int, DayOfWeek_Num int")
    rows = C.add_period_weekend(df).collect()
    assert [r.time_period for r in rows] == ["Night", "Night", "Morning", "Morning", "Afternoon",
                                             "Afternoon", "Evening", "Evening", "Night"]
    assert [r.is_weekend for r in rows] == [False, True, False, False, False, False, False, True, False]


def test_hazards(spark):
    df = _one_col(spark, ["DATA MISSING or whatever", None, "None", "Other object"], name="Carriageway_Hazards")
    got = [r[0] for r in C.clean_hazards(df).collect()]
    assert got == ["None", "None", "None", "Other object"]


def test_weather_rules(spark):
    vals = ["Fine no high winds", "Fine + high winds", "Raining no high winds", "Raining + high winds",
            "Snowing no high winds", "Snowing + high winds", "Fog or mist", "Other", "Unusual", None]
    got = [r[0] for r in C.consolidate_weather(_one_col(spark, vals, name="Weather_Conditions")).collect()]
    assert got == ["Fine", "Fine (High Winds)", "Rain", "Rain (High Winds)", "Snow", "Snow (High Winds)",
                   "Fog / Mist", "Other", "Unusual", None]


def test_type_aware_fill_leaves_int_column(spark):
    df = spark.createDataFrame([(None, None), (2, "x")], "Urban_or_Rural_Area int, Road_Type string")
    rows = fill_nulls(df, {"Urban_or_Rural_Area": "Unknown", "Road_Type": "Unknown", "absent": "x"}).collect()
    assert [tuple(r) for r in rows] == [(None, "Unknown"), (2, "x")]


def test_second_road_only_if_present(spark):
    df = spark.createDataFrame([(None,), ("B",)], "`2nd_Road_Class` string")
    out = C.fill_second_road(df)
    assert out.columns == ["2nd_Road_Class"]
    assert [r[0] for r in out.collect()] == ["N/A", "B"]


def test_labels(spark):
    df = spark.createDataFrame([(i,) for i in [1, 2, 3, 7, 8, None]], "d int")
    rows = df.select(weekday_name(F.col("d")), severity_label(F.col("d")), monday_first_ordinal(F.col("d"))).collect()
    assert [r[0] for r in rows] == ["Sunday", "Monday", "Tuesday", "Saturday", None, None]
    assert [r[1] for r in rows] == ["Fatal", "Serious", "Slight", "Slight", "Slight", "Slight"]
    assert [r[2] for r in rows][:4] == [7, 1, 2, 6]
    lab = spark.createDataFrame([(2005, 3)], "y int, m int").select(month_label(F.col("y"), F.col("m"))).first()[0]
    assert lab == "2005-03"
    s = spark.createDataFrame([("x" * 44,), ("y" * 43,)], "s string").select(truncate_sample(F.col("s"))).collect()
    assert s[0][0] == "x" * 40 + "..." and s[1][0] == "y" * 43


def test_lenient_day_first_patterns(spark):
    from roadlens.schemas import DAY_FIRST_PATTERNS

    vals = ["28/05/1997", "8/5/1997", "08-05-1997", "1997-05-08", "99/99/9999", "x"]
    got = [r[0] for r in _one_col(spark, vals).select(
        parse_day_first_date(F.col("v"), DAY_FIRST_PATTERNS)).collect()]
    assert [str(d) if d else None for d in got] == ["1997-05-28", "1997-05-08", "1997-05-08",
                                                    "1997-05-08", None, None]
