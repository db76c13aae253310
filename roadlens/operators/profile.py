"""Data-quality profiles of the raw accident table.

The reference computes these in pandas on one machine; here each profile is
a Spark aggregate over the whole table, typically one scan (+ one small
shuffle), returning a bounded result. Percentages use the reference's
denominators (all rows, or the non-null rows of the column where it used
``dropna``) and rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from roadlens.functions.labels import monday_first_ordinal, truncate_sample, weekday_name
from roadlens.functions.parsing import parse_day_first_date, strict_hour
from roadlens.operators.quantiles import FirstScan, fences, first_scan, number, quantiles
from roadlens.operators.repeats import flag_repeats
from roadlens.operators.stats import (approx_quantile, numeric_columns, pct, rows_from_wide,
                                      string_columns, value_counts)
from roadlens.schemas import (CASUALTY_CAP_QUANTILE, CASUALTY_EXTREME, DAY_FIRST_PATTERNS,
                              IQR_COLUMNS, IQR_FACTOR,
                              KEY_COL, MISSING_BANDS, RUSH_HOURS, SOURCE_ORDER_COL,
                              UK_LAT_BOUNDS, UK_LON_BOUNDS, WORST_KEYS)


def _total():
    return F.count(F.lit(1))


def profiled(raw: DataFrame) -> DataFrame:
    """The table as profiled: every loaded row, source position columns left out."""
    return raw.drop(SOURCE_ORDER_COL, "source_file", "source_block", "source_row")


def schema_report(df: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """Column, type, non-null count and a sample value truncated to 43
    characters: the first non-null one by the columns in ``order`` (source
    position, left out of the report), or the smallest without any, so the
    answer never depends on row order."""
    fields = [f for f in df.schema.fields if f.name not in order or f.name == KEY_COL]

    def picked(f):
        x = F.col(f.name)
        lo = F.min_by(x, F.when(x.isNotNull(), F.struct(*order))) if order else F.min(x)
        # -0.0 and 0.0 are the same sample value
        return lo + F.lit(0.0) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else lo

    wide = df.agg(*[F.count(F.col(f.name)).alias(f"n{i}") for i, f in enumerate(fields)],
                  *[picked(f).cast("string").alias(f"s{i}") for i, f in enumerate(fields)])
    records = [{"position": F.lit(i + 1), "column_name": F.lit(f.name),
                "data_type": F.lit(f.dataType.simpleString()), "non_null": F.col(f"n{i}"),
                "sample": F.coalesce(truncate_sample(F.col(f"s{i}")), F.lit("N/A"))}
               for i, f in enumerate(fields)]
    return rows_from_wide(wide, records)


def missing_report(df: DataFrame) -> DataFrame:
    """Null count and % per column, only columns with nulls, worst first,
    with the chart band (> 20 %: high, > 5 %: medium, else low)."""
    cols = df.columns
    wide = df.agg(_total().alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    records = [{"column_name": F.lit(c), "missing_count": F.col(f"m{i}"),
                "missing_pct": pct(F.col(f"m{i}"), F.col("_n"), 3)} for i, c in enumerate(cols)]
    out = rows_from_wide(wide, records).filter(F.col("missing_count") > 0)
    band = None
    for threshold, label in MISSING_BANDS:
        cond = F.col("missing_pct") > threshold
        band = F.when(cond, F.lit(label)) if band is None else band.when(cond, F.lit(label))
    return (out.withColumn("band", band.otherwise(F.lit("low")))
               .orderBy(F.col("missing_pct").desc(), "column_name"))


def _one_row(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(0, 1, 1, 1)


def _double(x: float | int | None):
    return F.lit(x).cast("double")


def _r4(x: float | None):
    return F.round(_double(x), 4)


def _summary(first: FirstScan, medians: dict[str, float | None], c: str) -> dict:
    m = first.columns[c]
    return {"mean": _r4(m.mean), "median": _r4(medians[c]), "std": _r4(m.std), "min": _r4(m.low), "max": _r4(m.high)}


def _medians(df: DataFrame, first: FirstScan, columns: list[str], approx: list[str], groups=None):
    """Exact medians by a second scan, sketched ones of ``approx``; and that scan."""
    exact = [c for c in columns if c not in approx]
    found = quantiles(df, first, {c: [0.5] for c in exact}, groups=groups) if exact or groups else None
    sketched = first.brackets({c: [0.5] for c in approx}, margin=0.0)
    return {**{c: found[c, 0.5] for c in exact}, **{c: sketched.get((c, 0.5), (None,))[0] for c in approx}}, found


def numeric_summary(df: DataFrame, approx_cols: tuple[str, ...] = ()) -> DataFrame:
    """D3: count, mean, median, sample std, min, max (rounded to 4) for every
    numeric column, NaN being no value. Two scans, see ``quantiles``; columns in ``approx_cols``
    have the median of their sketch, and if all are, one scan will do.
    """
    cols = numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, count bigint, mean double, median double, std double, min double, max double")
    first = first_scan(df, cols)
    medians, _ = _medians(df, first, cols, [c for c in cols if c in approx_cols])
    records = [{"column_name": F.lit(c), "count": F.lit(first.columns[c].n).cast("long"), **_summary(first, medians, c)} for c in cols]
    return rows_from_wide(_one_row(df), records)


def severity_distribution(df: DataFrame) -> DataFrame:
    """Count and % (of all rows) per severity code, most frequent first.
    One scan: the total is summed over the counted codes, null among them."""
    counts = df.groupBy("Accident_Severity").agg(_total().alias("cnt"))
    return (counts.withColumn("pct", pct(F.col("cnt"), F.sum("cnt").over(Window.partitionBy()), 2))
              .filter(F.col("Accident_Severity").isNotNull())
              .orderBy(F.col("cnt").desc(), "Accident_Severity"))


def speed_distribution(df: DataFrame) -> DataFrame:
    """Counts of valid (> 0) speed limits by value."""
    return value_counts(df.filter(F.col("Speed_limit") > 0), "Speed_limit").orderBy("Speed_limit")


def speed_invalid(df: DataFrame) -> DataFrame:
    """Count and % (of all rows) of speed limits <= 0."""
    return (df.agg(F.count_if(F.col("Speed_limit") <= 0).alias("invalid_count"), _total().alias("_n"))
              .select("invalid_count", pct(F.col("invalid_count"), F.col("_n"), 3).alias("invalid_pct")))


def casualty_histogram(df: DataFrame, column: str = "Number_of_Casualties",
                       q: float = CASUALTY_CAP_QUANTILE) -> DataFrame:
    """Unit bins 1..int(p99) with their counts (0 for empty bins). Two
    scans: the second finds the cap and counts whole values up to its bracket's end."""
    first = first_scan(df, [column])
    spark = df.sparkSession
    if not first.columns[column].n:
        return spark.createDataFrame([], f"`{column}` int, cnt bigint")
    x, top = number(column), first.brackets({column: [q]})[column, q][1]
    whole = F.when((x == F.floor(x)) & x.between(1, F.lit(top)), x)
    found = quantiles(df, first, {column: [q]}, groups=[whole] if top >= 1 else None)
    # no bins when the cap is below 1
    bins = spark.range(1, max(int(found[column, q]), 0) + 1).select(F.col("id").cast("int").alias(column))
    counts = found.second.table.filter(F.col("_c") == -1).select(F.col("_v").cast("int").alias(column), "_n")
    return (bins.join(counts, column, "left")
                .select(column, F.coalesce(F.col("_n"), F.lit(0)).alias("cnt"))
                .orderBy(column))


def casualty_stats(df: DataFrame, column: str = "Number_of_Casualties",
                   extreme: int = CASUALTY_EXTREME) -> DataFrame:
    """Mean, median, max, and count / % (of non-null rows) above ``extreme``; two scans."""
    first = first_scan(df, [column], {"extreme": number(column) > extreme})
    m, over = first.columns[column], F.lit(first.counts["extreme"]).cast("long")
    median = quantiles(df, first, {column: [0.5]})[column, 0.5]
    return _one_row(df).select(_r4(m.mean).alias("mean"), _r4(median).alias("median"),
                               _double(m.high).cast(df.schema[column].dataType).alias("max"), over.alias("extreme_count"),
                               pct(over, F.nullif(F.lit(m.n).cast("long"), F.lit(0)), 3).alias("extreme_pct"))


def box_stats(df: DataFrame, column: str = "Number_of_Casualties", k: float = IQR_FACTOR) -> DataFrame:
    """Median, quartiles, whiskers (furthest values inside the 1.5 IQR
    fences) and the number of fliers, in two scans."""
    f, dtype = fences(df, [column], k)[1][column], df.schema[column].dataType
    q1, median, q3 = (_double(x) for x in (f.q1, f.median, f.q3))
    return _one_row(df).select(q1.alias("q1"), median.alias("median"), q3.alias("q3"), (q3 - q1).alias("iqr"),
                               _double(f.whisker_low).cast(dtype).alias("whisker_low"),
                               _double(f.whisker_high).cast(dtype).alias("whisker_high"),
                               F.lit(f.outside).cast("long").alias("fliers"))


def hour_distribution(df: DataFrame) -> DataFrame:
    """Accidents per strictly parsed hour, with the rush-hour flag."""
    hours = df.select(strict_hour(F.col("Time")).alias("Hour"))
    return (value_counts(hours, "Hour")
              .withColumn("is_peak", F.col("Hour").isin(*RUSH_HOURS))
              .orderBy("Hour"))


def peak_hour(df: DataFrame) -> DataFrame:
    """The busiest hour (smallest on ties) and the unparseable count."""
    hours = df.select(strict_hour(F.col("Time")).alias("Hour"))
    counts = hours.groupBy("Hour").agg(_total().alias("cnt"))
    return counts.agg(
        F.max_by(F.col("Hour"), F.when(F.col("Hour").isNotNull(),
                                       F.struct(F.col("cnt"), -F.col("Hour")))).alias("peak_hour"),
        F.coalesce(F.sum(F.when(F.col("Hour").isNull(), F.col("cnt"))), F.lit(0)).alias("unparseable"))


def weekday_distribution(df: DataFrame) -> DataFrame:
    """All seven days Monday first, zero-filled, with the weekend flag."""
    spark = df.sparkSession
    days = spark.range(1, 8).select(F.col("id").cast("int").alias("Day_of_Week"))
    # only codes 1..7 survive the reindex, so the broadcast side has at most 7 rows
    counts = value_counts(df.filter(F.col("Day_of_Week").between(1, 7)), "Day_of_Week")
    return (days.join(F.broadcast(counts), "Day_of_Week", "left")
                .select(weekday_name(F.col("Day_of_Week")).alias("day_name"),
                        monday_first_ordinal(F.col("Day_of_Week")).alias("day_order"),
                        F.coalesce(F.col("cnt"), F.lit(0)).alias("cnt"),
                        F.col("Day_of_Week").isin(1, 7).alias("is_weekend"))
                .orderBy("day_order"))


def duplicate_report(df: DataFrame, key: str = KEY_COL) -> DataFrame:
    """Rows that repeat an earlier row in full, rows that repeat an
    earlier key, and their % of all rows. Only hashes and keys of all rows
    are shuffled; whole rows only where a row's hash says that it may repeat,
    and these are compared in full."""
    flagged = flag_repeats(df, df.columns, "_again")
    rows = flagged.filter("_again").groupBy(*df.columns).agg(_total().alias("_c"))
    full = rows.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("_full")).scalar()
    keys = df.groupBy(key).agg(_total().alias("_c"))
    sums = keys.agg(F.sum(F.col("_c") - 1).alias("key_dups"), F.sum("_c").alias("_n"))
    sums = sums.withColumn("full_row_dups", F.when(F.col("_n").isNotNull(), full))
    n = F.col("_n")
    return sums.select(F.col("full_row_dups").cast("long").alias("full_row_dups"),
                       pct(F.col("full_row_dups"), n, 4).alias("full_row_pct"),
                       F.col("key_dups").cast("long").alias("key_dups"),
                       pct(F.col("key_dups"), n, 4).alias("key_pct"))


def worst_keys(df: DataFrame, key: str = KEY_COL, top: int = WORST_KEYS) -> DataFrame:
    """The most repeated keys (count of rows per duplicated key); null is no key."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(_total().alias("cnt"))
              .filter(F.col("cnt") > 1)
              .orderBy(F.col("cnt").desc(), key)
              .limit(top))


def iqr_outliers(df: DataFrame, columns: list[str] = IQR_COLUMNS, k: float = IQR_FACTOR) -> DataFrame:
    """Per column Q1, Q3, IQR, fences, outliers and invalid (<= 0) speed
    limits, both also as % of the column's non-null rows; two scans for all."""
    cols = [c for c in columns if c in df.columns]
    first, found = fences(df, cols, k, {c: number(c) <= 0 if c == "Speed_limit" else F.lit(False) for c in cols})
    records = []
    for c in cols:
        f = found[c]
        n = F.nullif(F.lit(f.n).cast("long"), F.lit(0))
        outliers, invalid = (F.lit(x).cast("long") for x in (f.outside, first.counts[c]))
        q1, q3 = _double(f.q1), _double(f.q3)
        records.append({"column_name": F.lit(c), "q1": q1, "q3": q3, "iqr": q3 - q1,
                        "lower": _double(f.lower), "upper": _double(f.upper), "outliers": outliers,
                        "outlier_pct": pct(outliers, n, 3), "invalid": invalid, "invalid_pct": pct(invalid, n, 3)})
    return rows_from_wide(_one_row(df), records)


def format_checks(df: DataFrame) -> DataFrame:
    """Malformed dates, null/malformed times, coordinates outside the UK
    box, missing coordinates — counts and % of all rows, one pass."""
    lat, lon = F.col("Latitude"), F.col("Longitude")
    out_of_box = ((lat < UK_LAT_BOUNDS[0]) | (lat > UK_LAT_BOUNDS[1])
                  | (lon < UK_LON_BOUNDS[0]) | (lon > UK_LON_BOUNDS[1]))
    wide = df.agg(
        F.count_if(parse_day_first_date(F.col("Date"), DAY_FIRST_PATTERNS).isNull()).alias("bad_dates"),
        F.count_if(strict_hour(F.col("Time")).isNull()).alias("bad_times"),
        F.count_if(F.coalesce(out_of_box, F.lit(False))).alias("out_of_bounds"),
        F.count_if(lat.isNull() | lon.isNull()).alias("missing_geo"),
        _total().alias("_n"))
    names = ["bad_dates", "bad_times", "out_of_bounds", "missing_geo"]
    return wide.select(*[c for n in names for c in (F.col(n), pct(F.col(n), F.col("_n"), 3).alias(f"{n}_pct"))])


def whitespace_report(df: DataFrame) -> DataFrame:
    """Leading / trailing space counts per text column, only columns with any."""
    cols = string_columns(df)
    wide = df.agg(*[F.count_if(F.col(c).startswith(" ")).alias(f"l{i}") for i, c in enumerate(cols)],
                  *[F.count_if(F.col(c).endswith(" ")).alias(f"t{i}") for i, c in enumerate(cols)])
    records = [{"column_name": F.lit(c), "leading": F.col(f"l{i}"), "trailing": F.col(f"t{i}")}
               for i, c in enumerate(cols)]
    return (rows_from_wide(wide, records)
              .filter(F.col("leading") + F.col("trailing") > 0)
              .orderBy("column_name"))


def final_statistics(df: DataFrame, secondary: DataFrame) -> DataFrame:
    """Sizes, severity shares, the five worst missing columns and the
    numeric summary as one long (section, item, metric, value) table. Two
    scans of ``df``: figures, gaps and sketches; then medians and severities."""
    cols, numeric = df.columns, numeric_columns(df)
    first = first_scan(df, numeric, {c: F.col(f"`{c}`").isNull() for c in cols})
    medians, found = _medians(df, first, numeric, [], groups=[F.col("Accident_Severity")])
    wide = _one_row(df).withColumn("_m", secondary.agg(_total()).scalar())
    rows = F.lit(first.rows).cast("long")

    def line(section, item, metric, value):
        return F.struct(F.lit(section).alias("section"), item.alias("item"), F.lit(metric).alias("metric"), value.alias("value"))

    sizes = [line("size", F.lit(item), metric, value) for item, metric, value in [
        ("accidents", "rows", _double(first.rows)), ("traffic_flow", "rows", F.col("_m").cast("double")),
        ("accidents", "columns", _double(len(cols))), ("traffic_flow", "columns", _double(len(secondary.columns)))]]
    summary = [line("numeric", F.lit(c), metric, value) for c in numeric
               for metric, value in _summary(first, medians, c).items()]
    # worst first: by falling share, then by name
    gaps = F.array(*[F.struct((-pct(F.lit(n).cast("long"), rows, 3)).alias("k"), F.lit(c).alias("c"),
                              F.lit(n).cast("long").alias("missing")) for c, n in first.counts.items()])
    worst = F.transform(F.slice(F.array_sort(F.filter(gaps, lambda g: g["missing"] > 0)), 1, 5),
                        lambda g: line("missing", g["c"], "pct", -g["k"]))
    severity = (found.second.table.filter(F.col("_c") == -1)
                     .select(F.lit("severity").alias("section"),
                             F.col("_v").cast(df.schema["Accident_Severity"].dataType).cast("string").alias("item"),
                             F.lit("pct").alias("metric"), pct(F.col("_n"), rows, 2).alias("value")))
    return wide.select(F.inline(F.concat(F.array(*sizes), worst, F.array(*summary)))).unionByName(severity)
