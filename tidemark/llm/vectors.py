"""Vectors of a table as rows of 64-bit floats."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_table


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and without null or non-finite components."""
    wide = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(wide, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(wide, lambda v: v != 0), F.lit(False))


def vector_rows(rows: DataFrame, id_col: str, vector_col: str, **others: str) -> DataFrame:
    """(id, vector as array<double>, others) of the rows whose id is not null and whose vector is usable."""
    found = as_table(rows, id=id_col, vector=vector_col, **others).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    return found.withColumn("vector", F.col("vector").cast("array<double>"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an array<double> column of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    n = len(column)
    return np.asarray(column.flatten()).reshape(n, -1) if n else np.zeros((0, 1))
