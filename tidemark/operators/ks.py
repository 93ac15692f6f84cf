"""Kolmogorov-Smirnov separation of positives and negatives along a descending score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.histogram import GROUP
from tidemark.operators.profile import from_value
from tidemark.operators.segments import level_columns


def ks_curve(profile: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Cumulative rates at each score, highest score first; equal scores share one step."""
    return profile.filter(F.col("n") > 0).select(
        "cohort",
        "score",
        *level_columns(segments),
        "value",
        from_value("pos").alias("cum_pos"),
        from_value("neg").alias("cum_neg"),
        _rate("pos", F.col("total_pos")).alias("pos_rate"),
        _rate("neg", F.col("total_neg")).alias("neg_rate"),
    )


def cohort_totals(base: DataFrame) -> DataFrame:
    """Positives and negatives of whole cohorts, from the base histogram: one row per cohort and score."""
    return base.groupBy("cohort", "score").agg(F.sum("pos").alias("cohort_pos"), F.sum("neg").alias("cohort_neg"))


def ks(profile: DataFrame, segments: Sequence[str], whole: DataFrame | None = None) -> DataFrame:
    """Largest gap between the two rates; null when a class is empty.

    Rates are taken of the positives and negatives of the segment itself. With ``whole`` (see
    ``cohort_totals``) they are taken of the whole cohort's, which scales a segment's value by its
    share of either class.
    """
    profile, gap = with_gap(profile, whole)
    return profile.groupBy(*GROUP).agg(F.max(gap).alias("ks")).select("cohort", "score", *level_columns(segments), "ks")


def with_gap(profile: DataFrame, whole: DataFrame | None = None) -> tuple[DataFrame, Column]:
    """The profile and the gap between its two rates, of the segment's classes or of the whole cohort's."""
    pos, neg = F.col("total_pos"), F.col("total_neg")
    if whole is not None:
        # At most one row per configured month and score.
        profile = profile.join(F.broadcast(whole), ["cohort", "score"])
        pos, neg = F.col("cohort_pos"), F.col("cohort_neg")
    return profile, F.abs(_rate("pos", pos) - _rate("neg", neg))


def _rate(count: str, total: Column) -> Column:
    return F.try_divide(from_value(count).cast("double"), total.cast("double"))
