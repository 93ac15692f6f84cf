"""The percentile plan: one row per (score, percentile) that the configuration asks for."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.literals import doubles, text
from tidemark.plans.config import PERCENTILE_SCALE, ScoreSpec

WHOLE = 100 * PERCENTILE_SCALE


def percentile_plan(spark: SparkSession, scores: tuple[ScoreSpec, ...]) -> DataFrame:
    """``score, pctl, pctl_milli, is_ppv, high_tail``: at most a few hundred rows, safe to broadcast.

    PPV percentiles are tail sizes, so with a high tail the top 5% starts at percentile 95. Both
    lists are then merged without duplicates.
    """
    specs = ", ".join(
        f"({text(s.name)}, {doubles(s.ppv_percentiles)}, {doubles(s.dist_percentiles)}, {s.high_tail})"
        for s in scores
    )
    return spark.sql(
        f"""
        WITH specs AS (SELECT * FROM VALUES {specs} AS t(score, ppv, dist, high_tail)),
        flipped AS (SELECT score, dist, high_tail,
                           IF(high_tail, transform(ppv, p -> 100D - p), ppv) AS ppv FROM specs),
        merged AS (SELECT score, ppv, high_tail,
                          explode(array_sort(array_distinct(array_union(ppv, dist)))) AS pctl FROM flipped)
        SELECT score, pctl, CAST(round(pctl * {PERCENTILE_SCALE}) AS BIGINT) AS pctl_milli,
               array_contains(ppv, pctl) AS is_ppv, high_tail FROM merged
        """
    )


def plan_percentiles(scores: Iterable[ScoreSpec]) -> list[float]:
    """All percentiles any score asks for, ascending."""
    wanted: set[float] = set()
    for s in scores:
        wanted.update(100.0 - p if s.high_tail else float(p) for p in s.ppv_percentiles)
        wanted.update(map(float, s.dist_percentiles))
    return sorted(wanted)


def target_rank(total: str = "total_n", milli: str = "pctl_milli") -> Column:
    """1-based rank of the percentile among ``total`` rows: ceil(total * p / 100), never below 1.

    Whole-number arithmetic; holds for groups of up to 9e13 rows.
    """
    return F.expr(f"greatest(({total} * {milli} + {WHOLE - 1}) div {WHOLE}, 1)")


def reaches(milli: str = "pctl_milli") -> str:
    """SQL condition: a profile row is the one that reaches the percentile's target rank.

    Same as ``cum_n - n < target_rank <= cum_n``, without the division.
    """
    rank = f"greatest(total_n * {milli}, 1L)"
    return f"(cum_n - n) * {WHOLE} < {rank} AND {rank} <= cum_n * {WHOLE}"


def may_reach_any(scores: Iterable[ScoreSpec]) -> Column:
    """Quick test on every profile row, true at least where some percentile of the plan is reached.

    All percentiles are multiples of their greatest common divisor. A row that reaches one also moves
    on to a later cell of that grid; p = 0 is reached by the first row.
    """
    grid = math.gcd(*(round(p * PERCENTILE_SCALE) for p in plan_percentiles(scores))) or WHOLE
    before, upto = (f"({n}) * {WHOLE} div (total_n * {grid}L)" for n in ("cum_n - n", "cum_n"))
    return F.expr(f"n > 0 AND (cum_n = n OR {before} < {upto})")
