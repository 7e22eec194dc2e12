"""Session settings and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


# HotSpot never compiles methods above 8000 bytes of code. Past that, Spark's fused code for a wide
# projection would run interpreted, so such stages fall back to separately compiled expressions.
# Batches for Python workers hold whole texts: by rows alone one of them can fill a worker.
_TUNING = {"spark.sql.codegen.hugeMethodLimit": ("65535", "8000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def tune(spark: SparkSession) -> None:
    """Session settings the operators profit from; values somebody chose are left alone."""
    for key, (default, value) in _TUNING.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)


@contextmanager
def held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for what is started inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def keyed_state(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started inside keep their state in RocksDB, which states with timers need; later ones do as before."""
    return held(spark, "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs run inside drop their shuffle files when they end, not when the driver happens to collect its garbage."""
    return held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that the caller made and needs no more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    Clusters name it in ``spark.checkpoint.dir``, and without it nothing is written there: a folder
    of one machine would be lost to the others. Only a session that lives in one process (tests,
    bench) gets a temporary folder, once, which goes when the process ends.
    """
    tune(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="carelake-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused directory name below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
