"""Population stability between the baseline and each monitored cohort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.segments import level_columns, level_of_labels
from tidemark.plans.config import TOTAL_LABEL

# Fixed value: added to both shares so that an empty tail has a finite logarithm.
SMOOTHING = 1e-10


def cumulative_psi(
    production: DataFrame, baseline: DataFrame, segments: Sequence[str], total_label: str = TOTAL_LABEL
) -> DataFrame:
    """PSI over the cumulative tails of two percentile tables, in percentage points.

    For each percentile it compares the share of monitored rows beyond the baseline cut-off with the
    baseline's own share. Levels or percentiles missing on either side drop out.
    """
    level = level_of_labels(segments, total_label)
    monitored = production.select(
        "score", "cohort", level.alias("level"), "pctl", (F.col("base_tail_pct") + SMOOTHING).alias("p")
    )
    expected = baseline.select("score", level.alias("level"), "pctl", (F.col("tail_pct") + SMOOTHING).alias("q"))
    term = ((F.col("p") - F.col("q")) * F.ln(F.col("p") / F.col("q"))).alias("term")
    # One term per percentile of the plan, added in their order: the last digit does not depend on the layout.
    terms = F.array_sort(F.collect_list(F.struct("pctl", term)))
    return (
        monitored.join(expected, ["score", "level", "pctl"])
        .groupBy("score", "cohort", "level")
        .agg(F.aggregate(terms, F.lit(0.0), lambda total, t: total + t["term"]).alias("psi"))
        .select("score", "cohort", *level_columns(segments), "psi")
    )


# Fixed value: added to both shares of a bin, as a fraction of the rows.
BIN_SMOOTHING = 1e-6


def binned_psi(
    production: DataFrame, baseline: DataFrame, segments: Sequence[str], total_label: str = TOTAL_LABEL
) -> DataFrame:
    """PSI over the bins between neighbouring baseline cut-offs, the form whose usual limits are 0.1 and 0.25.

    A bin's share is the difference of two tails, so the percentile tables are all it takes; the first bin lies beyond
    the outermost cut-off, the last one holds what no tail does. Percentiles with one cut-off make an empty bin on both
    sides, which adds nothing. Equal tables give 0. Levels missing on either side drop out.
    """
    level = level_of_labels(segments, total_label)
    monitored = production.select("score", "cohort", level.alias("level"), "pctl", (F.col("base_tail_pct") / 100).alias("p"))
    expected = baseline.select("score", level.alias("level"), "pctl", (F.col("tail_pct") / 100).alias("q"))
    whole = F.array(F.struct(F.lit(1.0).alias("q"), F.lit(1.0).alias("p")))
    tails = F.concat(F.array_sort(F.collect_list(F.struct("q", "p"))), whole)

    def term(at, i):
        before = F.get("tails", i - 1)
        p = at["p"] - F.coalesce(before["p"], F.lit(0.0)) + BIN_SMOOTHING
        q = at["q"] - F.coalesce(before["q"], F.lit(0.0)) + BIN_SMOOTHING
        return (p - q) * F.ln(p / q)

    return (
        monitored.join(expected, ["score", "level", "pctl"])
        .groupBy("score", "cohort", "level")
        .agg(tails.alias("tails"))
        .withColumn("terms", F.transform("tails", term))
        .select("score", "cohort", *level_columns(segments), F.aggregate("terms", F.lit(0.0), lambda a, b: a + b).alias("psi"))
    )
