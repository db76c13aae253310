"""Session helpers: building a session for tests / bench and locating the
shared scratch folder.

Library code never creates a session; it receives one. Scratch data (reliable
checkpoints, staged tables) goes below ``spark.checkpoint.dir`` — on a cluster
that is a shared, fault-tolerant folder named by the deployment. Only when the
setting is missing (unit tests) is a local folder chosen, and it is then set on
the session so every later lookup agrees.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "roadlens") -> SparkSession:
    """Session for tests and the local bench (the library never calls this)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root; a local master gets a local one if unset, a cluster an error."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="roadlens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        return root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None):
    """Run a block with ``spark.sql.shuffle.partitions = n`` (restored after).

    The shuffle count sets the reduce-side task size of the big shuffles
    (dedup); AQE can coalesce small partitions but not split large ones, so
    at scale it should be about input bytes / 256 MB (see ``partitions_for``).
    """
    if not n:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, previous)


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, key: str, value: str | None):
    """Run a block with a setting of the session (restored after); None leaves it as it is."""
    if value is None:
        yield
        return
    previous = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def partitions_for(df, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Shuffle partitions for ``df``'s inputs at ``target_bytes`` each, from the
    sizes in its plan (no file is listed again); the session's own number where
    that is larger or no input has a known size."""
    spark = df.sparkSession
    unknown = _size(spark.conf.get("spark.sql.defaultSizeInBytes"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    known = sum(size for size in sizes if size < unknown)
    return max(-(-known // target_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))


def _size(text: str) -> int:
    """Bytes of a size as Spark's settings spell it (``10MB``, ``10485760b``)."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", text.lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes (negative: none)."""
    return _size(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run made, in whatever store it is."""
    fs, where = _folder(spark, path)
    fs.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file in any store, None if there is none."""
    fs, where = _folder(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place of the one before it at once: a reader finds the old text or the new one."""
    fs, where = _folder(spark, path)
    made = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(made, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.getScheme() == "file":
        os.replace(made.toUri().getPath(), where.toUri().getPath())
        return
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.rename(made, where, options)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any store, sorted; none if there is no such folder."""
    fs, where = _folder(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "roadlens", f"{purpose}-{uuid.uuid4().hex}")
