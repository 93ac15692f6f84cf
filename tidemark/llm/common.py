"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import shutil
import tempfile
from weakref import WeakSet

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

import tidemark

_SHIPPED: WeakSet[SparkContext] = WeakSet()
#: Bytes of rows that an executor hands to a Python task at a time; Spark's own limit is 10,000 rows of any length.
BATCH_BYTES = 2 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Give executors, present and future, the code of this library, once per Spark context."""
    context = spark.sparkContext
    if context not in _SHIPPED:
        code = os.path.dirname(os.path.abspath(tidemark.__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark")
        archive = shutil.make_archive(target, "zip", os.path.dirname(code), os.path.basename(code))
        context.addPyFile(archive)
        _SHIPPED.add(context)


def bound_batches(spark: SparkSession) -> None:
    """From now on Python tasks get rows in batches of about ``BATCH_BYTES``, unless the session has a limit of its own."""
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name like ``base`` that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column name for use in expressions, also with dots or backticks in it."""
    return "`" + name.replace("`", "``") + "`"


def as_table(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the keyword's names: ``as_table(df, id="doc_id")``; ready for Python tasks.

    A ``text`` may be of any length, so tables with one are handed to these in batches of bounded bytes.
    """
    ship_package(df.sparkSession)
    if "text" in columns:
        bound_batches(df.sparkSession)
    return df.select([df[quoted(old)].alias(new) for new, old in columns.items()])


def replace_column(df: DataFrame, name: str, new: str) -> DataFrame:
    """Column ``new`` in the place and under the name of ``name``."""
    kept = [c for c in df.columns if c != new]
    return df.select([df[quoted(new if c == name else c)].alias(c) for c in kept])
