"""Segment power set: every combination of segment columns, the grand total included."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.config import TOTAL_LABEL


def segment_subsets(segments: Sequence[str]) -> list[tuple[str, ...]]:
    """All 2^k subsets, from the empty one (grand total) to the full one."""
    return [c for size in range(len(segments) + 1) for c in itertools.combinations(segments, size)]


def grouping_bits(segments: Sequence[str], subset: Sequence[str]) -> int:
    """The number ``grouping_id`` gives a subset: a set bit for each column totalled away."""
    last = len(segments) - 1
    return sum(1 << (last - i) for i, s in enumerate(segments) if s not in subset)


def checked_segment(name: str, total_label: str = TOTAL_LABEL) -> Column:
    """The segment as a string; a level spelled like the total label stops the job."""
    level = F.col(name).cast("string")
    message = f"segment {name} has a level equal to the total label {total_label}"
    return F.when(level == total_label, F.raise_error(message).cast("string")).otherwise(level).alias(name)


def segment_cube(
    df: DataFrame,
    keys: Sequence[str],
    segments: Sequence[str],
    aggregates: Sequence[Column],
    total_label: str = TOTAL_LABEL,
) -> DataFrame:
    """Aggregate rows for every segment combination in one scan with GROUPING SETS.

    The fixed ``keys`` are part of every set. ``gid`` tells a null level from the total, which
    carries ``total_label``.
    """
    checked = df.withColumns({s: checked_segment(s, total_label) for s in segments})
    sets = [[*keys, *subset] for subset in segment_subsets(segments)]
    # grouping_id() also spans the keys; those are never totalled away, so they add zero bits.
    cubed = checked.groupingSets(sets, *keys, *segments).agg(
        F.grouping_id().cast("int").alias("gid"),
        *[F.grouping(s).alias(f"_total_{s}") for s in segments],
        *aggregates,
    )
    labelled = {
        s: F.when(F.col(f"_total_{s}") == 1, F.lit(total_label)).otherwise(F.col(s)) for s in segments
    }
    return cubed.withColumns(labelled).drop(*[f"_total_{s}" for s in segments])


def expand_levels(
    df: DataFrame, segments: Sequence[str], total_label: str = TOTAL_LABEL, level: str = "level"
) -> DataFrame:
    """Replace the segment columns by one ``level`` struct, one row per segment combination.

    This is the expansion GROUPING SETS makes, kept apart from the aggregate so that the caller can
    choose the partitioning. As a struct, the level compares equal on null members, so it serves as
    a plain join and window key.
    """
    others = [c for c in df.columns if c not in segments]
    return df.select(*others, F.explode(F.array(*level_structs(segments, total_label))).alias(level))


def level_structs(segments: Sequence[str], total_label: str = TOTAL_LABEL) -> list[Column]:
    """The levels that a row with segment columns belongs to."""
    return [
        F.struct(
            F.lit(grouping_bits(segments, subset)).alias("gid"),
            *[(F.col(s) if s in subset else F.lit(total_label)).cast("string").alias(s) for s in segments],
        )
        for subset in segment_subsets(segments)
    ]


def level_columns(segments: Sequence[str]) -> list[Column]:
    """The segment columns back out of a ``level`` struct."""
    return [F.col(f"level.{s}").alias(s) for s in segments]


def level_of_labels(segments: Sequence[str], total_label: str = TOTAL_LABEL) -> Column:
    """Rebuild the ``level`` struct from labelled segment columns, as stored in result tables."""
    bits = F.lit(0)
    for s in segments:
        bits = bits * 2 + F.coalesce((F.col(s) == total_label).cast("int"), F.lit(0))
    return F.struct(bits.cast("int").alias("gid"), *[F.col(s).cast("string").alias(s) for s in segments])
