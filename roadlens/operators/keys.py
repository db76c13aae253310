"""Deterministic surrogate keys.

Position-based ids (``monotonically_increasing_id`` straight after a
``distinct``) change with row placement, so the same member can get a
different key on a rerun. Two deterministic schemes instead:

* ``dense_keys`` — 1..n in the sort order of the natural key (nulls first),
  computed without a single-partition window: range-partition and sort,
  checkpoint once (fixes partition contents and order), then
  key = rows in earlier partitions + position inside the partition.
  Only one number per partition (and one per group) reaches the driver —
  bounded by the partition count, not by the data.
* ``hash_key`` — 64-bit hash of the null-marked natural key: no materialised
  step and stable across loads; uniqueness is asserted by the integrity check.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from roadlens.operators.small import materialize

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def _lookup(mapping: dict, key: Column) -> Column:
    """``mapping[key]`` as a literal map expression (keys compared as text;
    a ``None`` key is matched by a null ``key``)."""
    plain = {k: v for k, v in mapping.items() if k is not None}
    out = F.lit(None).cast("long")
    if plain:
        pairs = chain.from_iterable((F.lit(str(k)), F.lit(int(v)).cast("long")) for k, v in plain.items())
        out = F.element_at(F.create_map(*pairs), key.cast("string"))
    if None in mapping:
        out = F.when(key.isNull(), F.lit(int(mapping[None])).cast("long")).otherwise(out)
    return out


def dense_keys(df: DataFrame, order_cols: list[str], key_col: str,
               group_col: str | None = None) -> tuple[DataFrame, dict]:
    """Add ``key_col`` = 1..n by ``order_cols`` ascending, nulls first,
    restarting at 1 for each value of ``group_col`` if given.

    The range sort gets no explicit count, so AQE coalesces it to the
    members' actual size (a few partitions even at scale); without AQE it
    has the session's shuffle partitions. One offset per partition.

    Returns the keyed DataFrame and the row count per group value (or
    ``{None: n}`` without groups).
    """
    lead = [group_col] if group_col else []
    spec = [F.col(c).asc_nulls_first() for c in lead + order_cols]
    ranged = df.repartitionByRange(*spec)
    ordered, _ = materialize(ranged.sortWithinPartitions(*spec), count=False)

    rid = F.monotonically_increasing_id()
    tagged = ordered.withColumn("_rid", rid).withColumns({
        "_part": F.shiftright(F.col("_rid"), _POS_BITS),
        "_pos": F.col("_rid").bitwiseAND((1 << _POS_BITS) - 1),
    })
    group = F.col(group_col) if group_col else F.lit(None).cast("int")
    # One small aggregate: rows per (partition, group) and each group's first row.
    stats = (tagged.groupBy(F.col("_part"), group.alias("_g"))
                   .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
                   .collect())
    sizes: dict[int, int] = {}
    for r in stats:
        sizes[r["_part"]] = sizes.get(r["_part"], 0) + r["_n"]
    offsets, running = {}, 0
    for part in sorted(sizes):
        offsets[part] = running
        running += sizes[part]
    starts: dict = {}
    counts: dict = {}
    for r in stats:
        pos = offsets[r["_part"]] + r["_first"]
        starts[r["_g"]] = min(pos, starts.get(r["_g"], pos))
        counts[r["_g"]] = counts.get(r["_g"], 0) + r["_n"]

    part = F.shiftright(F.col("_rid"), _POS_BITS)
    pos = F.col("_rid").bitwiseAND((1 << _POS_BITS) - 1)
    start = _lookup(starts, F.col(group_col)) if group_col else F.lit(starts.get(None, 0)).cast("long")
    key = (_lookup(offsets, part) + pos - start + 1).cast("long")
    keyed = ordered.withColumn("_rid", rid).select(*df.columns, key.alias(key_col))
    return keyed, counts


def hash_key(cols: list[str]) -> Column:
    """xxhash64 of the natural key with an explicit null marker per field
    (plain ``xxhash64`` skips nulls, so (null, 'a') would equal ('a', null))."""
    return F.xxhash64(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")) for c in cols])
