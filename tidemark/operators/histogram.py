"""The score histogram: rows, positives and negatives per (cohort, score, segment level, value).

Every result table is a function of it. Raw rows are read once, combined map-side and only then
expanded to the segment combinations, so the 2^k expansion acts on combined rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scores import is_valid
from tidemark.operators.segments import checked_segment, expand_levels
from tidemark.plans.config import MonitorConfig

# Keys of one distribution: the histogram of one score, in one cohort, at one segment level.
GROUP = ("cohort", "score", "level")


def score_rows(rows: DataFrame, config: MonitorConfig) -> DataFrame:
    """Long form: one row per valid score, as ``cohort, <segments>, flag, score, value``.

    Scores of different types come out in their common type.
    """
    valid = [is_valid(s, config.derive_status) for s in config.scores]
    any_valid = valid[0]
    for v in valid[1:]:
        any_valid = any_valid | v
    wide = rows.filter(any_valid).select(
        F.col(config.cohort_column).alias("cohort"),
        *[checked_segment(s, config.total_label) for s in config.segments],
        F.col(config.response_column).alias("flag"),
        *[F.when(v, F.col(s.name)).alias(s.name) for v, s in zip(valid, config.scores)],
    )
    return wide.unpivot(
        ["cohort", *config.segments, "flag"], list(config.score_names), "score", "value"
    ).filter(F.col("value").isNotNull())


def base_histogram(long_rows: DataFrame, config: MonitorConfig) -> DataFrame:
    """Combine score rows that agree on everything: one row per value at the finest segment level.

    A null response counts as a row but in neither class.
    """
    return (
        long_rows.groupBy("cohort", "score", *config.segments, "value")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("flag") == 1).alias("pos"),
            F.count_if(F.col("flag") == 0).alias("neg"),
        )
        .withColumn("cohort", F.col("cohort").cast("string"))
    )


def leveled_histogram(base: DataFrame, config: MonitorConfig) -> DataFrame:
    """The base histogram once per segment combination."""
    return expand_levels(base, config.segments, config.total_label)


def present_groups(base: DataFrame, config: MonitorConfig) -> DataFrame:
    """The groups that have any entry, ``cohort, score, level``: from the finest cells, not from the entries."""
    cells = base.select("cohort", "score", *config.segments).distinct()
    return expand_levels(cells, config.segments, config.total_label).distinct()


def cubed_histogram(leveled: DataFrame) -> DataFrame:
    """One entry per (group, value).

    The grand total of a cohort gets every entry of the base histogram; they are combined on the map
    side, so what is shuffled for a value is one entry per task at most.
    """
    return leveled.groupBy(*GROUP, "value").agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
    )
