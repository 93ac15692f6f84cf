"""Percentile cut-offs and the volume of the tails beyond them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import doubles, texts
from tidemark.functions.scores import percent
from tidemark.operators.histogram import GROUP
from tidemark.operators.profile import from_value
from tidemark.operators.segments import expand_levels, level_columns, level_of_labels
from tidemark.plans.config import MonitorConfig
from tidemark.plans.percentile_plan import percentile_plan, may_reach_any, plan_percentiles, reaches


def tail_count(count: str) -> Column:
    """Rows in the tail that starts at the value, in the score's own direction."""
    return F.when(F.col("high_tail"), from_value(count)).otherwise(F.col(f"cum_{count}"))


def milestones(profile: DataFrame, config: MonitorConfig) -> DataFrame:
    """The few profile rows that matter for percentiles: where one is reached, or a point was placed.

    The cut-off of a percentile is the smallest value whose cumulative count reaches the target rank.
    Exactly one histogram row crosses each rank, so this is a filter, without a shuffle; the quick
    test leaves few rows for the join with the plan.
    """
    plan = percentile_plan(profile.sparkSession, config.scores).withColumnRenamed("score", "plan_score")
    return (
        profile.where(F.col("is_point") | may_reach_any(config.scores))
        .join(F.broadcast(plan), F.expr(f"score = plan_score AND {reaches()}"), "left")
        .where(F.col("pctl").isNotNull() | F.col("is_point"))
        .drop("plan_score", "pctl_milli")
    )


def own_tails(marks: DataFrame) -> DataFrame:
    """Exact cut-offs with their tails, one row per (cohort, score, level, percentile)."""
    return marks.filter(F.col("pctl").isNotNull()).select(
        *GROUP,
        "pctl",
        "is_ppv",
        "high_tail",
        F.col("value").alias("cutoff"),
        tail_count("n").alias("tail_n"),
        tail_count("pos").alias("tail_pos"),
        "total_n",
        "total_pos",
    )


def cutoff_points(base_tails: DataFrame, groups: DataFrame, value_type: T.DataType) -> DataFrame:
    """The baseline cut-offs as points on the score axes of the monitored groups (``present_groups``).

    A group gets the points of its own level, so there are as many as groups times percentiles at most; baseline levels
    that a month does not have get none there.
    """
    cutoffs = base_tails.select("score", "level", _point(value_type).alias("value"))
    return groups.join(cutoffs, ["score", "level"]).select(*GROUP, "value")


def _point(value_type: T.DataType) -> Column:
    """Cut-off in the type of the scores; for whole scores a fraction moves to the next one inside the tail."""
    cutoff = F.col("cutoff")
    if isinstance(value_type, T.IntegralType):
        cutoff = F.when(F.col("high_tail"), F.ceil(cutoff)).otherwise(F.floor(cutoff))
    return cutoff.cast(value_type)


def own_points(tails: DataFrame, value_type: T.DataType) -> DataFrame:
    """Each cohort's own cut-offs as points on its score axis."""
    return tails.select("cohort", "score", "level", _point(value_type).alias("value"))


def tails_under_baseline(marks: DataFrame, base_tails: DataFrame) -> DataFrame:
    """Monitored rows beyond the baseline cut-offs, read off the points placed in the profile."""
    tails = tails_at_points(marks, base_tails.drop("cohort"))
    return tails.select(
        *GROUP,
        "pctl",
        F.col("cutoff").alias("base_cutoff"),
        F.col("tail_n").alias("base_tail_n"),
        F.col("tail_pos").alias("base_tail_pos"),
    )


def tails_at_points(marks: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Tails beyond given cut-offs that were placed in the profile as points.

    Cut-offs with a cohort apply to that cohort, others to every cohort.
    """
    at = cutoffs.select(
        *[c for c in GROUP if c in cutoffs.columns],
        "pctl",
        "is_ppv",
        "high_tail",
        "cutoff",
        _point(marks.schema["value"].dataType).alias("value"),
    )
    # A point on which several of the cohort's own percentiles fall is in the marks once for each.
    points = marks.filter("is_point").drop("pctl", "is_ppv", "high_tail").distinct()
    return points.join(at, [*[c for c in GROUP if c in cutoffs.columns], "value"]).select(
        *GROUP,
        "pctl",
        "is_ppv",
        "cutoff",
        tail_count("n").alias("tail_n"),
        tail_count("pos").alias("tail_pos"),
        "total_n",
        "total_pos",
    )


def compared_tails(marks: DataFrame, base_tails: DataFrame) -> DataFrame:
    """Own tails next to the tails under baseline cut-offs.

    A level the baseline does not have keeps a null cut-off and an empty baseline tail.
    """
    return own_tails(marks).join(tails_under_baseline(marks, base_tails), [*GROUP, "pctl"], "left")


def baseline_report(tails: DataFrame, segments: Sequence[str]) -> DataFrame:
    return tails.select(
        "score",
        "cohort",
        *level_columns(segments),
        "pctl",
        "cutoff",
        "tail_n",
        percent(F.col("tail_n"), F.col("total_n")).alias("tail_pct"),
    )


def production_report(tails: DataFrame, segments: Sequence[str]) -> DataFrame:
    """The percentile table of monitored cohorts, with their tails under the baseline cut-offs."""
    base_n = F.coalesce("base_tail_n", F.lit(0).cast("bigint"))
    return tails.select(
        "score",
        "cohort",
        *level_columns(segments),
        "pctl",
        "cutoff",
        "tail_n",
        percent(F.col("tail_n"), F.col("total_n")).alias("tail_pct"),
        "base_cutoff",
        base_n.alias("base_tail_n"),
        percent(base_n, F.col("total_n")).alias("base_tail_pct"),
    )


def tails_of_report(report: DataFrame, config: MonitorConfig) -> DataFrame:
    """Turn a stored percentile table back into tails that cohorts can be measured against."""
    plan = percentile_plan(report.sparkSession, config.scores)
    return (
        report.join(F.broadcast(plan), ["score", "pctl"])
        .select(
            "score",
            "cohort",
            level_of_labels(config.segments, config.total_label).alias("level"),
            "pctl",
            "is_ppv",
            "high_tail",
            "cutoff",
            "tail_n",
            "tail_pct",
        )
    )


# The largest sketch Spark offers; and how a sketch's size relates to its rank error, from the sketch's own description.
MOST_SKETCH = 65_535
_ERROR_FACTOR, _ERROR_POWER = 2.296, 0.9021


def sketch_size(accuracy: int) -> int:
    """Size parameter of a sketch whose ranks are off by ``1 / accuracy`` of the rows at most, with 99 % confidence."""
    return min(MOST_SKETCH, max(8, math.ceil((_ERROR_FACTOR * accuracy) ** (1 / _ERROR_POWER))))


def quantile_sketches(long_rows: DataFrame, config: MonitorConfig, accuracy: int = 100) -> DataFrame:
    """A mergeable sketch of the values of every group: ``cohort, score, gid, <segments>, sketch``.

    Rows feed one sketch per finest cell, combined map-side. Only those sketches are expanded to the segment
    combinations and merged, again map-side, so a group receives one sketch of bounded size per task.
    """
    size, kind = F.lit(sketch_size(accuracy)), _sketch_kind(long_rows)
    feed, merge = getattr(F, f"kll_sketch_agg_{kind}"), getattr(F, f"kll_merge_agg_{kind}")
    cells = long_rows.groupBy("cohort", "score", *config.segments).agg(feed(F.col("value").cast(kind), size).alias("sketch"))
    levels = expand_levels(cells, config.segments, config.total_label)
    flat = levels.select(F.col("cohort").cast("string").alias("cohort"), "score", "level.gid", *level_columns(config.segments), "sketch")
    return flat.groupBy("cohort", "score", "gid", *config.segments).agg(merge("sketch", size).alias("sketch"))


def _sketch_kind(long_rows: DataFrame) -> str:
    return "bigint" if isinstance(long_rows.schema["value"].dataType, T.IntegralType) else "double"


def approximate_cutoffs(long_rows: DataFrame, config: MonitorConfig, accuracy: int = 100) -> DataFrame:
    """Cut-offs from mergeable quantile sketches instead of the histogram.

    One sketch per group answers all percentiles; the rank error is about ``1 / accuracy``. Groups of fewer values than
    the sketch's size are exact.
    """
    wanted = plan_percentiles(config.scores)
    sketches = quantile_sketches(long_rows, config, accuracy)
    ranks = F.expr(doubles(p / 100 for p in wanted))
    cutoffs = getattr(F, f"kll_sketch_get_quantile_{_sketch_kind(long_rows)}")("sketch", ranks)
    plan = percentile_plan(long_rows.sparkSession, config.scores).select("score", "pctl")
    return (
        sketches.select(
            "score",
            "cohort",
            *config.segments,
            F.inline(F.arrays_zip(F.expr(doubles(wanted)).alias("pctl"), cutoffs.alias("cutoff"))),
        )
        .withColumn("cutoff", F.col("cutoff").cast(long_rows.schema["value"].dataType))
        .join(F.broadcast(plan), ["score", "pctl"], "left_semi")
    )


def percentile_column(pctl: float) -> str:
    return f"pctl_{pctl:g}".replace(".", "_")


def wide_cutoffs(report: DataFrame, segments: Sequence[str], percentiles: Sequence[float]) -> DataFrame:
    """One row per distribution, one column per percentile. Stating the percentiles saves a pass."""
    pivoted = (
        report.groupBy("score", "cohort", *segments)
        .pivot("pctl", [float(p) for p in percentiles])
        .agg(F.max("cutoff"))
    )
    return pivoted.toDF("score", "cohort", *segments, *[percentile_column(p) for p in percentiles])


def long_cutoffs(wide: DataFrame, segments: Sequence[str], percentiles: Sequence[float]) -> DataFrame:
    """Back from one column per percentile to one row per percentile."""
    columns = {percentile_column(p): float(p) for p in percentiles}
    names = F.create_map(*[F.lit(x) for pair in columns.items() for x in pair])
    return (
        wide.unpivot(["score", "cohort", *segments], list(columns), "column", "cutoff")
        .filter(F.col("cutoff").isNotNull())
        .select("score", "cohort", *segments, names[F.col("column")].alias("pctl"), "cutoff")
    )
