"""Star schema: four dimensions and the accident fact.

* All four dimensions come from ONE pass over the cleaned table: a
  ``GROUPING SETS`` aggregate (combined map-side, so a hot member costs one
  row per input partition) yields every distinct member of every dimension,
  tagged with its grouping id.
* Keys are dense (1..n in natural-key order, nulls first) or hashed; see
  ``roadlens.operators.keys``. Dense keys for all four dimensions are
  assigned by one range sort keyed on (grouping id, attributes).
* The fact attaches keys with left equi-joins. A dimension is broadcast only
  when its measured bytes fit the session's broadcast threshold; otherwise it
  is a shuffle join (AQE may still switch it, and splits skewed partitions).
  Default joins reproduce the published behaviour that a null attribute
  never matches (null foreign key); ``null_safe=True`` matches nulls too.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from roadlens.operators.keys import dense_keys, hash_key
from roadlens.operators.small import broadcast_if_small, materialize, row_bytes
from roadlens.schemas import DIMENSIONS, FACT_COLS

@dataclass
class Star:
    dims: dict[str, DataFrame]
    dim_rows: dict[str, int]
    dim_bytes: dict[str, int]
    fact: DataFrame


def _all_dim_cols() -> list[str]:
    return [c for cols, _ in DIMENSIONS.values() for c in cols]


def _grouping_id(member_cols: list[str], all_cols: list[str]) -> int:
    """``grouping_id()`` of a set: bit (n-1-i) is 1 when column i is not grouped."""
    n = len(all_cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(all_cols) if c not in member_cols)


def dimension_members(clean: DataFrame) -> DataFrame:
    """Distinct members of all dimensions in one aggregate, with ``_gid``."""
    all_cols = _all_dim_cols()
    sets = [[F.col(c) for c in cols] for cols, _ in DIMENSIONS.values()]
    return clean.groupingSets(sets, *all_cols).agg(F.grouping_id().alias("_gid"))


def build_dimensions(clean: DataFrame, keys: str = "dense") -> tuple[dict[str, DataFrame], dict[str, int], dict[str, int]]:
    """``{name: DataFrame(attributes..., key)}``, and rows and bytes per dimension."""
    all_cols = _all_dim_cols()
    members = dimension_members(clean)
    if keys == "dense":
        keyed, _ = dense_keys(members, all_cols, "_key", group_col="_gid")
    elif keys == "hash":
        keyed, _ = materialize(members, count=False)
        keyed = keyed.withColumn("_key", F.lit(None).cast("long"))
    else:
        raise ValueError(f"unknown key scheme {keys!r}")
    sizes = {r["_gid"]: r for r in keyed.groupBy("_gid").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(keyed)).alias("bytes")).collect()}
    dims, rows, nbytes = {}, {}, {}
    for name, (cols, key) in DIMENSIONS.items():
        gid = _grouping_id(cols, all_cols)
        key_expr = F.col("_key") if keys == "dense" else hash_key(cols)
        dims[name] = keyed.filter(F.col("_gid") == gid).select(*cols, key_expr.alias(key))
        rows[name], nbytes[name] = (int(sizes[gid]["rows"]), int(sizes[gid]["bytes"])) if gid in sizes else (0, 0)
    return dims, rows, nbytes


def attach_keys(clean: DataFrame, dims: dict[str, DataFrame], dim_bytes: dict[str, int],
                null_safe: bool = False) -> DataFrame:
    """Left-join each dimension on its natural key to pick up the surrogate key."""
    out = clean
    for name, (cols, key) in DIMENSIONS.items():
        side = broadcast_if_small(dims[name], dim_bytes.get(name))
        if not null_safe:
            out = out.join(side, on=cols, how="left")
        else:
            f, d = out.alias("f"), side.alias("d")
            cond = reduce(lambda a, b: a & b,
                          [F.col(f"f.`{c}`").eqNullSafe(F.col(f"d.`{c}`")) for c in cols])
            out = f.join(d, on=cond, how="left").select("f.*", F.col(f"d.{key}"))
    return out


def build_fact(clean: DataFrame, dims: dict[str, DataFrame], dim_bytes: dict[str, int],
               null_safe: bool = False) -> DataFrame:
    """M5: one row per accident: keys, measures, degenerate attributes, year."""
    return attach_keys(clean, dims, dim_bytes, null_safe).select(*FACT_COLS)


def build_star(clean: DataFrame, keys: str = "dense", null_safe: bool = False) -> Star:
    dims, rows, nbytes = build_dimensions(clean, keys)
    return Star(dims, rows, nbytes, build_fact(clean, dims, nbytes, null_safe))
