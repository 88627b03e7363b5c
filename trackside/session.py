"""Session builder and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Bodies grow ten times or more when decompressed, so batches to Python are kept small.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
    # State of streams on local disk, not in executor memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "trackside", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def work_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; a machine's own temporary folder
    would be lost with that machine on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="trackside-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below :func:`work_root`."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write a result once and read it from there, where several branches need it.

    Unlike a cache it outlives an executor, and unlike a plan it is not computed per branch. Whoever
    needs it no longer says so with :func:`forget`.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    rows._landed = [path]
    return rows


def forget(*frames: DataFrame | None) -> None:
    """Delete the tables that :func:`landed` wrote for some frames. Nothing may read them any more: what was
    made of them is written by now."""
    for frame in frames:
        for path in getattr(frame, "_landed", []):
            at = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
        if frame is not None:
            frame._landed = []


@contextmanager
def small_batches(spark: SparkSession, most: str = "2m") -> Iterator[None]:
    """What runs inside gets batches of at most so many bytes in Python, whatever the session says. A batch lies
    in the task's JVM, its worker and the answer at once, in every core of an executor."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)
