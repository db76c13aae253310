"""Exact quantiles of many columns in two scans.

The first scan takes, per column, counts, mean, variance, extremes and a KLL
sketch: partial aggregates of up to ``BUCKETS`` groups of input partitions,
which are merged afterwards, so that no task reads a sketch of every task. The
sketch brackets the ranks that are asked for: at ``MARGIN`` times its error on both
sides the true value lies in between but for one case in very many.

The second scan counts the rows below each bracket and keeps the values inside,
as (bracket, value, rows). What it keeps is a small share of a wide column, and of
a narrow one a few values with their counts. Ranks are then found in it exactly.
A bracket that turns out not to hold its rank is widened and the scan repeated.

The scans run while a query is built. The driver sees ``BUCKETS`` rows of
numbers, and the values kept if they are ``LEAF_VALUES`` at most.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from roadlens.operators.small import materialize

SKETCH_K = 1024       # size of a sketch; its rank error is about 0.45 %
BUCKETS = 256         # partial sketches that are merged at the end
MARGIN = 2.0          # bracket half width in rank errors
LEAF_VALUES = 10_000  # distinct values that one window may sort
FANOUT = 64           # parts a larger range is cut into


def rank_error(k: int) -> float:
    """Rank error of a KLL sketch of size ``k`` that 99 % of its answers keep within."""
    return 2.296 / k ** 0.9021


def number(column: str) -> Column:
    """A numeric column as a double; NaN is no value, like null."""
    x = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(x), x)


@dataclass
class Moments:
    """Figures of one column's values."""

    n: int = 0
    mean: float | None = None
    std: float | None = None
    low: float | None = None
    high: float | None = None


@dataclass
class FirstScan:
    rows: int
    columns: dict[str, Moments]
    counts: dict[str, int]
    sketches: DataFrame = field(repr=False)  # one per bucket and column, named by the column's position
    sketch_k: int = SKETCH_K

    def brackets(self, wanted: dict[str, list[float]], margin: float = MARGIN) -> dict[tuple[str, float], tuple[float, float]]:
        """(column, quantile) -> the two values that it lies between, for columns that have values."""
        names = list(self.columns)
        ranks = {(c, q): (q - margin * rank_error(self.sketch_k), q + margin * rank_error(self.sketch_k))
                 for c, qs in wanted.items() if self.columns[c].n for q in qs}
        asked = {c: sorted({r for (d, _), pair in ranks.items() if d == c for r in pair if 0 < r < 1}) for c, _ in ranks}
        found = {}
        if any(asked.values()):
            merged = self.sketches.agg(*[F.kll_merge_agg_double(f"k{names.index(c)}").alias(f"k{names.index(c)}") for c in asked])
            cuts = merged.select(*[F.kll_sketch_get_quantile_double(f"k{names.index(c)}", F.lit(r)).alias(f"v{names.index(c)}_{j}")
                                   for c, rs in asked.items() for j, r in enumerate(rs)]).first()
            found = {(c, r): cuts[f"v{names.index(c)}_{j}"] for c, rs in asked.items() for j, r in enumerate(rs)}
        return {(c, q): (found.get((c, lo), self.columns[c].low), found.get((c, hi), self.columns[c].high))
                for (c, q), (lo, hi) in ranks.items()}


def first_scan(df: DataFrame, columns: list[str], counts: dict[str, Column] | None = None,
               sketched: list[str] | None = None, k: int = SKETCH_K) -> FirstScan:
    """Figures and sketches of ``columns`` (sketches of ``sketched`` only, if
    given), and how many rows meet each condition of ``counts``; one scan."""
    sketched = columns if sketched is None else sketched
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        x = number(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.var_pop(x).alias(f"v{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        if c in sketched:
            aggs.append(F.kll_sketch_agg_double(x, F.lit(k)).alias(f"k{i}"))
    aggs += [F.count_if(cond).alias(f"c{j}") for j, cond in enumerate((counts or {}).values())]
    bucketed = df.withColumn("_bucket", F.pmod(F.spark_partition_id(), F.lit(BUCKETS)))
    parts, _ = materialize(bucketed.groupBy("_bucket").agg(*aggs).drop("_bucket"), count=False)
    rows = parts.drop(*[f"k{i}" for i in range(len(columns))]).collect()
    figures = {}
    for i, c in enumerate(columns):
        some = [r for r in rows if r[f"n{i}"]]
        if not some:
            figures[c] = Moments()
            continue
        n = sum(r[f"n{i}"] for r in some)
        mean = math.fsum(r[f"n{i}"] * r[f"a{i}"] for r in some) / n
        away = math.fsum(r[f"n{i}"] * (r[f"v{i}"] + (r[f"a{i}"] - mean) ** 2) for r in some)
        figures[c] = Moments(n, mean, math.sqrt(away / (n - 1)) if n > 1 else None,
                             min(r[f"lo{i}"] for r in some), max(r[f"hi{i}"] for r in some))
    sums = {name: sum(r[f"c{j}"] for r in rows) for j, name in enumerate(counts or {})}
    return FirstScan(sum(r["rows"] for r in rows), figures, sums, parts, k)


@dataclass
class SecondScan:
    below: list[int]      # rows below each range
    observed: dict        # further aggregates of the same scan
    table: DataFrame      # (_c, _v, _n): range or group, value, rows with it

    def inside(self) -> dict[int, tuple[int, int]]:
        """Rows and distinct values of each range and group."""
        found = self.table.groupBy("_c").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("d")).collect()
        return {r["_c"]: (r["n"], r["d"]) for r in found}


def second_scan(df: DataFrame, ranges: list[tuple[str, float, float]], observed: dict[str, Column] | None = None,
                groups: list[Column] | None = None) -> SecondScan:
    """Rows below and values inside each (column, low, high), and counts by the
    values of each of ``groups`` (doubles; range number -1, -2, ...); one scan."""
    # a range of one value, as narrow columns have them, is a count; only wider ones keep rows
    points = {i: lo for i, (_, lo, hi) in enumerate(ranges) if lo == hi}
    aggs = [F.count_if(number(c) < F.lit(lo)).alias(f"b{i}") for i, (c, lo, _) in enumerate(ranges)]
    aggs += [F.count_if(number(ranges[i][0]) == F.lit(lo)).alias(f"p{i}") for i, lo in points.items()]
    aggs += [a.alias(name) for name, a in (observed or {}).items()] + [F.count(F.lit(1)).alias("rows")]
    kept = [F.struct(F.lit(i).alias("_c"), F.when(number(c).between(F.lit(lo), F.lit(hi)), number(c)).alias("_v"))
            for i, (c, lo, hi) in enumerate(ranges) if i not in points]
    kept += [F.struct(F.lit(-1 - j).alias("_c"), g.cast("double").alias("_v")) for j, g in enumerate(groups or [])]
    spark, schema = df.sparkSession, "_c int, _v double, _n bigint"
    if kept:
        metrics = Observation("second-scan")
        seen = df.observe(metrics, *aggs)
        if not groups:  # whose conditions might be constant, and the scan with its metrics be optimized away
            seen = seen.filter(reduce(lambda x, y: x | y, [k["_v"].isNotNull() for k in kept]))
        counted = (seen.select(F.inline(F.array(*kept))).filter(F.col("_v").isNotNull())
                       .groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n")))
        table, _ = materialize(counted, count=False)
        got = metrics.get
    else:
        table, got = spark.createDataFrame([], schema), df.agg(*aggs).first()
    counts = [(i, lo, got[f"p{i}"]) for i, lo in points.items() if got[f"p{i}"]]
    if counts:
        table = table.unionAll(_rows(spark, schema, counts))
    return SecondScan([got[f"b{i}"] for i in range(len(ranges))], {name: got[name] for name in observed or {}}, table)


def _rows(spark, schema: str, rows: list[tuple]) -> DataFrame:
    """A few rows as literals of the plan."""
    fields = [f.split() for f in schema.split(", ")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def _find(table: DataFrame, ranges: dict) -> DataFrame:
    """Rows of ``table`` inside each ``{(column, lo, hi): id}`` (a few ranges: at most two per quantile)."""
    side = _rows(table.sparkSession, "_r int, _rc int, _lo double, _hi double",
                 [(i, c, lo, hi) for (c, lo, hi), i in ranges.items()])
    return table.join(F.broadcast(side), (F.col("_c") == F.col("_rc")) & F.col("_v").between(F.col("_lo"), F.col("_hi")))


def values_at(table: DataFrame, ranks: dict[int, set[int]], leaf: int = LEAF_VALUES, fanout: int = FANOUT) -> dict[tuple[int, int], float]:
    """The values at 0-based ranks of each ``_c`` of (_c, _v, _n).

    Each rank starts in its whole range. While that holds more than ``leaf``
    distinct values it is cut at ``fanout`` sketched points, the parts are
    counted exactly, and the part with the rank goes on; so no task ever sorts
    more than ``leaf`` values and the driver sees ``fanout`` counts per range.
    """
    start = {r["_c"]: r for r in table.groupBy("_c").agg(
        F.sum("_n").alias("n"), F.count(F.lit(1)).alias("d"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).collect()}
    # (column, rank) -> (lo, hi, rows before lo, distinct values)
    at = {(c, rank): (start[c]["lo"], start[c]["hi"], 0, start[c]["d"]) for c, some in ranks.items() for rank in some}

    def numbered(keys):
        return {k: i for i, k in enumerate(dict.fromkeys((c, *at[c, rank][:2]) for c, rank in keys))}

    while wide := [k for k, state in at.items() if state[3] > max(leaf, 1)]:
        ranges = numbered(wide)
        inside = _find(table, ranges)
        points = [i / fanout for i in range(1, fanout)]
        cuts = inside.groupBy("_r").agg(F.percentile_approx("_v", points, 20 * fanout).alias("_cuts"))
        parts = (inside.join(F.broadcast(cuts), "_r")  # one array of cuts per range
                       .withColumn("_b", F.size(F.filter("_cuts", lambda cut: cut < F.col("_v"))))
                       .groupBy("_r", "_b").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("d"),
                                                F.min("_v").alias("lo"), F.max("_v").alias("hi"))
                       .orderBy("_r", "_b").collect())
        for c, rank in wide:
            lo, hi, before, _ = at[c, rank]
            for part in (p for p in parts if p["_r"] == ranges[c, lo, hi]):
                if rank < before + part["n"]:
                    at[c, rank] = (part["lo"], part["hi"], before, part["d"])
                    break
                before += part["n"]
    if not at:
        return {}
    ranges = numbered(at)
    asked = _rows(table.sparkSession, "_r int, _rank bigint, _local bigint",
                  [(ranges[c, lo, hi], rank, rank - before) for (c, rank), (lo, hi, before, _) in at.items()])
    upto = Window.partitionBy("_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (_find(table, ranges).withColumn("_cum", F.sum("_n").over(upto))
             .join(F.broadcast(asked), "_r").filter(F.col("_cum") > F.col("_local"))
             .groupBy("_c", "_rank").agg(F.min("_v").alias("_v")).collect())
    return {(r["_c"], r["_rank"]): r["_v"] for r in found}


@dataclass
class Quantiles:
    """Exact quantiles by (column, q); None where a column has no values."""

    values: dict[tuple[str, float], float | None]
    second: SecondScan | None  # the scan that found them, with what else was asked of it
    extra: list[tuple[str, float, float]]  # ranges of ``more`` in it, after the brackets' own
    first_extra: int

    def __getitem__(self, key: tuple[str, float]) -> float | None:
        return self.values[key]


def quantiles(df: DataFrame, first: FirstScan, wanted: dict[str, list[float]], more=None, observed=None, groups=None,
              leaf: int = LEAF_VALUES, margin: float = MARGIN) -> Quantiles:
    """Linear-interpolated quantiles (pandas / ``quantile_cont``), by one more scan of ``df``.

    ``more(brackets)`` gives further ranges, ``observed(brackets)`` further
    aggregates and ``groups`` further counts of that scan."""
    values: dict[tuple[str, float], float | None] = {(c, q): None for c, qs in wanted.items() for q in qs}
    while True:
        brackets = first.brackets(wanted, margin)
        if not brackets and not groups:
            return Quantiles(values, None, [], 0)
        extra = more(brackets) if more else []
        ranges = [(c, *brackets[c, q]) for c, q in brackets] + extra
        second = second_scan(df, ranges, observed(brackets) if observed else None, groups)
        inside = second.inside()
        ranks, missed = {}, False
        for i, (c, q) in enumerate(brackets):
            pos = q * (first.columns[c].n - 1)
            ranks[i] = {int(pos), min(int(pos) + 1, first.columns[c].n - 1)}
            missed |= any(not 0 <= r - second.below[i] < inside.get(i, (0, 0))[0] for r in ranks[i])
        if not missed:
            break
        margin *= 4
    bracketed = second.table.filter(F.col("_c").between(0, len(brackets) - 1))
    local = {i: {r - second.below[i] for r in some} for i, some in ranks.items()}
    if sum(inside[i][1] for i in ranks) <= leaf:  # no more than one window would sort
        found = {}
        for i, some in itertools.groupby(sorted(map(tuple, bracketed.collect())), key=lambda r: r[0]):
            upto = 0
            for _, v, n in some:
                found |= {(i, r): v for r in local[i] if upto <= r < upto + n}
                upto += n
    else:
        found = values_at(bracketed, local, leaf)
    for i, (c, q) in enumerate(brackets):
        pos = q * (first.columns[c].n - 1)
        low = found[i, int(pos) - second.below[i]]
        high = found[i, min(int(pos) + 1, first.columns[c].n - 1) - second.below[i]]
        values[c, q] = low if pos == int(pos) or low == high else low + (high - low) * (pos - int(pos))
    return Quantiles(values, second, extra, len(brackets))


def column_quantiles(df: DataFrame, column: str, qs: list[float], leaf: int = LEAF_VALUES, k: int = SKETCH_K,
                     margin: float = MARGIN) -> list[float | None]:
    """Exact quantiles of one column."""
    first = first_scan(df, [column], k=k)
    found = quantiles(df, first, {column: qs}, leaf=leaf, margin=margin)
    return [found[column, q] for q in qs]


@dataclass
class Fences:
    """Box-plot figures of a column; None without values."""

    n: int = 0
    q1: float | None = None
    median: float | None = None
    q3: float | None = None
    lower: float | None = None
    upper: float | None = None
    outside: int = 0
    whisker_low: float | None = None
    whisker_high: float | None = None


def fences(df: DataFrame, columns: list[str], factor: float, counts: dict[str, Column] | None = None) -> tuple[FirstScan, dict[str, Fences]]:
    """Quartiles, fences ``factor`` interquartile ranges beyond them, rows
    outside and the furthest values inside, of all columns in two scans: the
    brackets of the quartiles bracket the fences too, and the second scan keeps
    the values in these and counts the rows beyond."""
    first = first_scan(df, columns, counts)
    wanted = {c: [0.25, 0.5, 0.75] for c in columns}

    def fence(q1: float, q3: float) -> tuple[float, float]:
        return q1 - (q3 - q1) * factor, q3 + (q3 - q1) * factor

    def zones(b: dict) -> dict[str, tuple[float, float, float, float]]:
        """Lowest and highest value of either fence; each rises with its own quartile and falls with the other."""
        out = {}
        for c in columns:
            if first.columns[c].n:
                (a1, b1), (a3, b3) = b[c, 0.25], b[c, 0.75]
                out[c] = (fence(a1, b3)[0], fence(b1, a3)[0], fence(b1, a3)[1], fence(a1, b3)[1])
        return out

    def more(b: dict) -> list[tuple[str, float, float]]:
        return [(c, *pair) for c, z in zones(b).items() for pair in (z[:2], z[2:])]

    def observed(b: dict) -> dict[str, Column]:
        out = {}
        for c, z in zones(b).items():
            i = columns.index(c)
            out[f"above{i}"] = F.min(F.when(number(c) > F.lit(z[1]), number(c)))
            out[f"under{i}"] = F.max(F.when(number(c) < F.lit(z[2]), number(c)))
        return out

    found = quantiles(df, first, wanted, more, observed)
    done, tests = {c: Fences() for c in columns}, []
    at = found.first_extra
    v, n = F.col("_v"), F.col("_n")
    zoned = [c for c in columns if first.columns[c].n]
    for j, c in enumerate(zoned):
        q1, median, q3 = (found[c, q] for q in wanted[c])
        lower, upper = fence(q1, q3)
        done[c] = Fences(first.columns[c].n, q1, median, q3, lower, upper)
        low, high = F.col("_c") == at + 2 * j, F.col("_c") == at + 2 * j + 1
        tests += [F.sum(F.when(low & (v < lower), n)).alias(f"low{j}"), F.sum(F.when(high & (v <= upper), n)).alias(f"high{j}"),
                  F.min(F.when(low & (v >= lower), v)).alias(f"first{j}"), F.max(F.when(high & (v <= upper), v)).alias(f"last{j}")]
    got = found.second.table.agg(*tests).first() if tests else None
    for j, c in enumerate(zoned):
        i, f = columns.index(c), done[c]
        f.outside = found.second.below[at + 2 * j] + (got[f"low{j}"] or 0) + f.n - found.second.below[at + 2 * j + 1] - (got[f"high{j}"] or 0)
        f.whisker_low = min(x for x in (got[f"first{j}"], found.second.observed[f"above{i}"]) if x is not None)
        f.whisker_high = max(x for x in (got[f"last{j}"], found.second.observed[f"under{i}"]) if x is not None)
    return first, done
