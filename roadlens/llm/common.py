"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"

#: Orders null ids after all others.
NO_ID = 2**63 - 1


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver has it from; once per application.

    Not needed where the package is installed or was given by --py-files.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    made = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(made, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(made))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text): whatever else the input carries can't clash with working columns."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Two longs, never null, that rows share if they are alike in id and text."""
    id_ = F.col(id_col).cast("long")
    return F.coalesce(id_, F.lit(NO_ID)), F.xxhash64(text_col, id_.isNull())


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores in front until df has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``.

    Where none is set, a temporary one is used if the master is local; else it
    is an error, because executors would not share it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the reliable checkpoint folder and read from there."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read from there: compressed, and read by column."""
    path = f"{shared_folder(df.sparkSession)}/{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose ``column`` holds about max_bytes each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size + 64
    if start < len(sizes):
        yield batch.slice(start)


def uniform(*parts: Column | str, seed: str) -> Column:
    """A number in (0, 1) that depends on the parts and the seed alone; DuckDB's md5 gives the same."""
    key = F.concat_ws(":", F.lit(seed), *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def model_bytes(path: str) -> bytes:
    """A vocabulary file, read once by the driver; it travels with the tasks, so executors need no copy."""
    with open(os.fspath(path), "rb") as f:
        return f.read()


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """(doc_id, text, label) of labelled documents outside the held-out fold, ``rows`` rows at most.

    Which labels depends on a hash of their ids alone; those that are sent
    to every executor are ``rows`` at most. Null ids and labels are left out; a
    document that is labelled twice counts twice. Where ids are shared by so many
    rows that more than ``rows`` documents have these labels, rows alike in id, label
    and text count once, and those whose digests hash lowest are taken.
    """
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    chosen = given.where(~held_out("doc_id", folds, fold)).orderBy(uniform("doc_id", seed="fit"), "doc_id", "label").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    if found.select("doc_id").count() <= rows:
        return found
    drawn = found.withColumn("draw", uniform("doc_id", "label", F.md5(F.coalesce("text", F.lit("")).cast("binary")), seed="row"))
    line = drawn.select("draw").distinct().orderBy("draw").limit(rows).agg(F.max("draw")).first()[0]
    # alike rows are reduced in their tasks, before any travels
    return drawn.where(F.col("draw") <= line).groupBy("doc_id", "label", "draw").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
