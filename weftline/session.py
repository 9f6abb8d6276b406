"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "weftline", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor reaches, named by the cluster in spark.checkpoint.dir.

    Whoever makes the session sets it, or the context's checkpoint folder, also in local mode.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there, so a lost executor costs no rerun."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BATCH_ROWS = 1000  # texts or pages a Python worker holds at once


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Plans made from now on hand Python at most so many rows at once: what they hold grows with it, not with the input."""
    if int(spark.conf.get(BATCH)) <= 0 or int(spark.conf.get(BATCH)) > rows:
        spark.conf.set(BATCH, str(rows))


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession):
    """What is written inside leaves no shuffle files behind; else they stay until the driver collects its garbage."""
    before = spark.conf.get(SWEEP)
    spark.conf.set(SWEEP, "true")
    try:
        yield
    finally:
        spark.conf.set(SWEEP, before)


def staged_at(df: DataFrame, name: str) -> str:
    """Write the rows to the shared folder as Parquet; returns the path, which `remove` takes."""
    path = noted(scratch_path(df.sparkSession, name))
    with swept(df.sparkSession):
        df.write.parquet(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Like cut, but as Parquet, so later passes read only the columns they need."""
    return df.sparkSession.read.schema(df.schema).parquet(staged_at(df, name))


_TABLES: ContextVar = ContextVar("tables", default=None)  # paths staged in the innermost `passing`


def noted(path: str) -> str:
    """The path of a table about to be written, which goes with the innermost `passing`."""
    if _TABLES.get() is not None:
        _TABLES.get().append(path)
    return path


@contextmanager
def passing(spark: SparkSession):
    """Tables staged inside are deleted at the end."""
    token = _TABLES.set(paths := [])
    try:
        yield
    finally:
        _TABLES.reset(token)
        remove(spark, *paths)


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The rows of build(), staged; what it staged on the way is deleted."""
    path = noted(scratch_path(spark, name))
    with passing(spark), swept(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete tables that staged_at wrote and nothing reads any more."""
    jvm = spark._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
