"""Mixing sources to target weights: Efraimidis-Spirakis order, cut at token budgets.

Every document draws an exponential key, -ln(u) / weight, with u from a hash of
its id (of its text, where the id is null): the smaller, the earlier; heavier documents tend to come first. A source
whose budget is e times its size and a rest first gives e complete epochs. The rest
is a fractional selection: documents in the order of their keys, while their
running sum of words lasts; the document that crosses the line gives its first words.

No source is sorted as a whole. Keys fall into bins of 1/1024 octave, of which
none holds over 0.03 % of a source's ids whatever their weights are (the density of
log2 of an exponential variable is at most 0.26); documents without weight are dealt
to bins after these by a hash. Running sums are taken over
the bins' totals, and inside each (source, bin) on its own.

Built-in functions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import WORD, checkpointed, fresh, row_key, stored, uniform

#: Bins for each doubling of the key.
BINS = 1024
#: Up to so many sources, their budgets (a name and five numbers each) are broadcast.
FEW_SOURCES = 10_000


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) with target: ``share`` of all sizes, dealt by weight and stopped at ``most`` times the size.

    Sources by code point, null last, take the weights in turn. What a stopped
    source leaves is reshared among the others by weight: in the order of
    limit / weight, sources are stopped until one isn't, and from there on
    the rate is the same for all. One row a source comes together here.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = sizes.select("source", "source_size", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("w"), (most * F.col("source_size")).alias("limit"))
    before = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = weighted.select(
        "*",
        (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))).alias("budget"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("ws"),
    )
    first = left.withColumn("free", F.when(F.col("limit") * F.col("ws") > F.col("w") * F.col("budget"), F.struct((F.col("limit") / F.col("w")).alias("o"), F.col("source").isNull().alias("n"), "source", "budget", "ws")))
    rate = first.withColumn("rate", F.min("free").over(everything))
    target = F.coalesce(F.least("limit", F.col("w") * F.col("rate.budget") / F.col("rate.ws")), F.col("limit"))
    return rate.select("source", "source_size", target.alias("target"))


def mix(df: DataFrame, weights: DataFrame | None = None, seed: str = "mix", source_weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", size: Column | None = None, row_col: str | None = None) -> DataFrame:
    """Per row: doc_id, size (words), source_size, target (its source's), taken (words, repeats counted), text_hash, and row_col, if given, as ``row``.

    ``weights``: (doc_id, weight), the quality weights; a document without one
    weighs 1, one with a weight that isn't positive comes last. Several weights
    of an id count by their mean.

    A null text has size 0 and gives nothing; a null source is a source of its
    own. Rows with the same id draw the same key and follow each other by size
    and a hash of the text, in one task; rows with a null id draw by that hash, so
    that they don't fall into one bin; among rows alike in all, which one is cut is open,
    but not how much of them is taken. Sources of size 0 have target 0.
    An empty table gives no rows; other columns aren't looked at.
    """
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(f"{WORD}+")), F.lit(0)).cast("long") if size is None else size
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), row_key(id_col, text_col)[1].alias("text_hash"), *([F.col(row_col).alias("row")] if row_col else []))
    kept = ["row"] if row_col else []
    weight = F.lit(1.0)
    if weights is not None:
        given = weights.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("weight").cast("double").alias("weight")).groupBy("doc_id").agg(F.avg("weight").alias("weight"))
        rows = rows.join(given, "doc_id", "left")
        weight = F.coalesce(F.nanvl("weight", F.lit(1.0)), F.lit(1.0))
    drawn = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.col("text_hash").cast("string")))
    key = F.when(weight > 0, -F.log(uniform(drawn, seed=seed)) / weight).otherwise(F.lit(float("inf")))
    rows = rows.select("doc_id", "source", "size", "text_hash", key.alias("key"), *kept)
    # documents without weight follow in bins of their own, dealt by hash
    last = F.lit(1 << 40) + F.floor(uniform(drawn, seed=f"{seed}:last") * 64 * BINS)
    bin_ = F.when(F.col("key") < 1e300, F.floor(F.log2("key") * BINS)).otherwise(last).cast("long")
    rows = checkpointed(rows.select("*", bin_.alias("bin")))

    bins = checkpointed(rows.groupBy("source", "bin").agg(F.sum("size").alias("n")))
    wanted = targets(bins.groupBy("source").agg(F.sum("n").alias("source_size")), source_weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    wanted = wanted.select("source", "source_size", "target", whole.alias("epochs"))
    wanted = wanted.withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = bins.select("source", "bin", "n", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    starts = starts.withColumnRenamed("source", "s").join(wanted, F.col("s").eqNullSafe(F.col("source")))
    cut = starts.where("before + n > rest").groupBy("source").agg(F.min(F.struct("bin", "before")).alias("at"))
    wanted = wanted.withColumnRenamed("source", "s").join(cut, F.col("s").eqNullSafe(F.col("source")), "left").select("s", "source_size", "target", "epochs", "rest", F.col("at.bin").alias("cut_bin"), F.col("at.before").alias("cut_before"))

    # one row a source; joined by broadcast while they are few, so that a hot source's rows stay where they are
    wanted = checkpointed(wanted)
    if wanted.count() <= FEW_SOURCES:
        wanted = F.broadcast(wanted)
    earlier = Window.partitionBy("source", "bin").orderBy("key", F.col("doc_id").asc_nulls_last(), "size", "text_hash", *kept).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    placed = placed.join(wanted, F.col("source").eqNullSafe(F.col("s")))
    left = F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("cut_before") - F.col("before")))
    # no bin crosses the line where the rest is, rounded, the whole source
    part = F.when(F.col("cut_bin").isNull() & (F.col("rest") > 0) | (F.col("bin") < F.col("cut_bin")), F.col("size")).when(F.col("bin") == F.col("cut_bin"), left).otherwise(0)
    return placed.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"), "text_hash", *kept)


def first_words(text: Column, n: Column) -> Column:
    """The start of a text that holds its first n words, white space as it is."""
    return F.when(n <= 0, "").otherwise(F.call_function("regexp_extract", text, F.concat(F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), n.cast("string"), F.lit("}+")), F.lit(0)))


def mixed_documents(df: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """df as mix() takes it: each document as often as it is taken whole, and once more cut to the words left over.

    ``more`` goes to mix(). The rows are stored with a number each, by which they
    meet what is taken of them: rows alike in id and text, or without an id, are
    taken each on their own account. A null or empty text is never taken, an
    empty table stays empty; the other columns are handed on, whatever their names.
    """
    row, id_, size, taken, words = fresh(df, "row", "mixed_row", "size", "taken", "words")
    numbered = stored(df.withColumn(row, F.monotonically_increasing_id()), "mixing")
    mixed = mix(numbered, weights, id_col=id_col, text_col=text_col, row_col=row, **more).where("taken > 0")
    joined = numbered.join(mixed.select(F.col("row").alias(id_), F.col("size").alias(size), F.col("taken").alias(taken)), F.col(row) == F.col(id_))
    rest = F.col(taken) % F.col(size)
    sizes = F.concat(F.array_repeat(F.col(size), F.floor(F.col(taken) / F.col(size)).cast("int")), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<long>")))
    copies = joined.withColumn(words, F.explode(sizes))
    text = F.when(F.col(words) == F.col(size), F.col(text_col)).otherwise(first_words(F.col(text_col), F.col(words)))
    return copies.withColumn(text_col, text).select(*df.columns)
