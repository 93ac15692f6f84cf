"""How many of a cohort's positives (frauds) the risky tail captures, and how pure that tail is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scores import percent
from tidemark.operators.histogram import GROUP
from tidemark.operators.segments import expand_levels, level_columns
from tidemark.plans.config import MonitorConfig


def positive_totals(base: DataFrame, config: MonitorConfig) -> DataFrame:
    """Positives per distribution, from the base histogram."""
    return (
        expand_levels(base.select("cohort", "score", *config.segments, "pos"), config.segments, config.total_label)
        .groupBy(*GROUP)
        .agg(F.sum("pos").alias("total_hits"))
        .select("cohort", "score", *level_columns(config.segments), "total_hits")
    )


def _hits(tail_pos: str, tail_n: str) -> Column:
    """Null when the tail holds no row at all, zero when it holds rows but no positive."""
    return F.when(F.col(tail_n) > 0, F.col(tail_pos))


def _ppv_tails(tails: DataFrame) -> DataFrame:
    """PPV percentiles of levels that the baseline has."""
    return tails.filter(F.col("is_ppv") & F.col("base_cutoff").isNotNull())


def capture(tails: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Share of the cohort's positives inside the tail, under baseline and under own cut-offs."""
    base, own = _hits("base_tail_pos", "base_tail_n"), _hits("tail_pos", "tail_n")
    return _ppv_tails(tails).select(
        *level_columns(segments),
        "pctl",
        base.alias("base_hits"),
        own.alias("prod_hits"),
        F.col("total_pos").alias("total_hits"),
        percent(base, F.col("total_pos")).alias("base_capture_pct"),
        percent(own, F.col("total_pos")).alias("prod_capture_pct"),
        "cohort",
        "score",
    )


def precision(tails: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Share of positives among the rows of the tail, under baseline and under own cut-offs."""
    return _ppv_tails(tails).select(
        *level_columns(segments),
        "pctl",
        "base_tail_n",
        "tail_n",
        percent(F.col("base_tail_pos"), F.col("base_tail_n")).alias("base_precision_pct"),
        percent(F.col("tail_pos"), F.col("tail_n")).alias("prod_precision_pct"),
        "cohort",
        "score",
    )
