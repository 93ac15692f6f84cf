"""Reliable intermediate storage in the folder the cluster shares for checkpoints."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCOPE: ContextVar[list[str] | None] = ContextVar("tidemark_scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; without one, a folder below the warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder is None:
        folder = context.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidemark-scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, for tables a job writes and reads back."""
    path = f"{shared_folder(spark).rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


#: Shuffle files go when the query that wrote them has ended, not when the driver's memory is cleaned.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def clean_shuffles(spark: SparkSession) -> None:
    """From now on every query's shuffle files go with its end; for sessions that read stored tables only."""
    spark.conf.set(_SHUFFLE_CLEANUP, "true")


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Whatever is stored inside is deleted at the end; results must have been written by then.

    Inside, every query's shuffle files go with its end: later steps read stored tables only.
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    clean_shuffles(spark)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)
        for path in paths:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate data, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Compute once into a Parquet table: for large results, which later steps read by column."""
    return stored_at(df, scratch_path(df.sparkSession, name))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute a small result once: later steps neither repeat the work nor depend on living executors."""
    if _SCOPE.get() is not None:
        return stored(df, "step")
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
