"""Running sums over ordered rows, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import stored


def with_running(df: DataFrame, group: Sequence[str], order: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Add, for each ``column: name`` of ``sums``, ``before_<name>`` and ``total_<name>``: the sum of the column over
    the rows of the group that come before, and over all of them.

    Rows are dealt by range over (group, order), nulls first, so that a group which holds a large share of the rows
    spans many parts. Sums run inside a part; the totals of a group's earlier parts (one row per group and part) are
    joined in. The parts are stored, because they must stay as they are. Rows that agree on group and order stand in
    any order; the order must tell apart what matters. Null groups are groups.
    """
    key = F.struct(*[F.col(c) for c in group]) if group else F.lit(0)
    laid = df.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()) if df.columns else df
    laid = stored(laid, "range").withColumn("of", key)
    whole = Window.partitionBy("of")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("of", "part").agg(*[F.sum(c).alias(f"part_{n}") for c, n in sums.items()])
    offsets = parts.select(
        "of",
        "part",
        *[F.coalesce(F.sum(f"part_{n}").over(earlier), F.lit(0)).alias(f"earlier_{n}") for n in sums.values()],
        *[F.sum(f"part_{n}").over(whole).alias(f"total_{n}") for n in sums.values()],
    )
    inside = Window.partitionBy("of", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = laid.withColumns({f"inside_{n}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c, n in sums.items()})
    return running.join(offsets, ["of", "part"]).select(
        *df.columns,
        *[(F.col(f"earlier_{n}") + F.col(f"inside_{n}")).alias(f"before_{n}") for n in sums.values()],
        *[F.col(f"total_{n}") for n in sums.values()],
    )
