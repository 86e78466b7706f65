"""Session settings the plans are designed for."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Event, Thread

from pyspark.sql import DataFrame, SparkSession

from tidelot.sources.fs import remove

CHECKPOINT_DIR = "spark.checkpoint.dir"


def builder(app_name: str = "tidelot") -> SparkSession.Builder:
    """A builder with adaptive execution on; sizes are left to the cluster."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; where none is set, one in the warehouse, which all executors share too."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidelot-scratch-{uuid.uuid4().hex}"
        spark.conf.set(CHECKPOINT_DIR, configured)
    return configured


_FOLDER: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder below the shared one for what a job materializes; it is removed when the job ends, however it ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/job-{uuid.uuid4().hex}"
    before = _FOLDER.set(folder)
    try:
        yield folder
    finally:
        _FOLDER.reset(before)
        remove(spark, folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, inside the job's folder where a job is running."""
    root = _FOLDER.get() or shared_dir(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def collect_garbage(spark: SparkSession) -> None:
    """Have the driver collect its garbage: Spark removes shuffle files and kept blocks only when nothing there refers to them."""
    spark.sparkContext._jvm.System.gc()


@contextmanager
def collecting(spark: SparkSession, seconds: float = 20) -> Iterator[None]:
    """Collect garbage every so often inside the block and when it ends, so a job of many passes holds the files of few."""
    ended = Event()

    def repeat() -> None:
        while not ended.wait(seconds):
            collect_garbage(spark)

    thread = Thread(target=repeat, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()
        collect_garbage(spark)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a frame that several plans read to the shared folder, or to ``path``, and read it back."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
