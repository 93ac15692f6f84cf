"""Running totals over the histogram, the common ground of cut-offs, tails and KS.

Base entries are dealt once, by (cohort, score, bucket); a bucket is a stretch of the score's axis, and groups that hold
few entries are one. All segment levels of a stretch are then at one place: they are expanded, combined and summed up
there, without another exchange. What the earlier stretches of a group hold comes along as the stretch's first entry.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import is_one_of, text
from tidemark.operators.histogram import GROUP, base_histogram
from tidemark.operators.segments import expand_levels, level_structs
from tidemark.plans.config import MonitorConfig
from tidemark.plans.percentile_plan import may_reach_any
from tidemark.sources.scratch import cut_lineage, stored

COUNTS = ("n", "pos", "neg")
#: Stretches a score's axis is cut into at most, and base entries that a stretch, and a task on average, is meant for.
STRETCHES = 64
LEAST_ENTRIES = 100_000
#: Size of the sketches that ends come from: ranks are off by less than a fifth of a finest stretch.
SKETCH_SIZE = 1600


def from_value(count: str) -> Column:
    """Rows at the value or above it."""
    return F.col(f"total_{count}") - F.col(f"cum_{count}") + F.col(count)


@dataclass(frozen=True)
class Histogram:
    """Base histogram by cohort."""

    base: DataFrame

    def of(self, cohorts: Sequence[int], label: str | None = None) -> Histogram:
        """Some cohorts only; with a label they count as a single cohort."""
        chosen = self.base.filter(is_one_of("cohort", map(str, cohorts)))
        return replace(self, base=chosen if label is None else chosen.withColumn("cohort", F.lit(label)))


def score_histogram(long_rows: DataFrame, config: MonitorConfig) -> Histogram:
    """Histogram of score rows, the only scan of them; stored, since more than one step reads it."""
    return Histogram(stored(base_histogram(long_rows, config), "histogram"))


@dataclass(frozen=True)
class Buckets:
    """How large groups are cut: stretches by (cohort, score), and the ends of a score's finest stretches; how many tasks
    share the entries."""

    tasks: int
    stretches: Mapping[tuple[str, str], int] = field(default_factory=dict)
    ends: Mapping[str, Sequence[float]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return ["bucket"] if self.stretches else []

    def placed(self, entries: DataFrame) -> DataFrame:
        """Entries with their ``bucket``, where there is any; it never falls along the axis."""
        if not self.stretches:
            return entries
        rows = [(c, s, n) for (c, s), n in self.stretches.items()]
        counts = entries.sparkSession.createDataFrame(rows, "cohort string, score string, stretches int")
        finest = "0"
        for score, ends in self.ends.items():
            finest = f"IF(score = {text(score)}, {_stretch(ends, 0, len(ends))}, {finest})"
        bucket = F.expr(f"coalesce(({finest}) * stretches div {STRETCHES}, 0)").cast("int")
        # A row for each month and score of the configuration at most.
        return entries.join(F.broadcast(counts), ["cohort", "score"], "left").withColumn("bucket", bucket).drop("stretches")


def _stretch(ends: Sequence[float], low: int, high: int) -> str:
    """SQL of a binary search: how many of the ends are below the value."""
    if low == high:
        return str(low)
    middle = (low + high) // 2
    end = f"{ends[middle]}L" if isinstance(ends[middle], int) else f"{ends[middle]!r}D"
    return f"IF(value > {end}, {_stretch(ends, middle + 1, high)}, {_stretch(ends, low, middle)})"


def buckets_of(base: DataFrame) -> Buckets:
    """Stretches in proportion to the entries of each cohort and score, with ends from a quantile sketch per score.

    To the driver go a number for each month and score, and the ends.
    """
    sizes = {(r["cohort"], r["score"]): r["count"] for r in base.groupBy("cohort", "score").count().collect()}
    tasks = max(base.sparkSession.sparkContext.defaultParallelism, math.ceil(sum(sizes.values()) / LEAST_ENTRIES))
    stretches = {g: min(STRETCHES, math.ceil(n / LEAST_ENTRIES)) for g, n in sizes.items() if n > LEAST_ENTRIES}
    if not stretches:
        return Buckets(tasks)
    kind = "bigint" if isinstance(base.schema["value"].dataType, T.IntegralType) else "double"
    sketch = getattr(F, f"kll_sketch_agg_{kind}")(F.col("value").cast(kind), SKETCH_SIZE)
    ranks = F.array(*[F.lit(i / STRETCHES) for i in range(1, STRETCHES)])
    ends = getattr(F, f"kll_sketch_get_quantile_{kind}")(sketch, ranks).alias("ends")
    cut = base.filter(is_one_of("score", {s for _, s in stretches})).groupBy("score").agg(ends).collect()
    return Buckets(tasks, stretches, {r["score"]: sorted({e for e in r["ends"] if math.isfinite(e)}) for r in cut})


def _starts(entries: DataFrame, points: DataFrame | None, config: MonitorConfig, bucket: Sequence[str]) -> DataFrame:
    """An entry without a value for each stretch of a group: what the earlier stretches hold, and the whole group."""
    sums = [F.sum(c).alias(c) for c in COUNTS]
    cells = entries.groupBy("cohort", "score", *config.segments, *bucket).agg(*sums)
    cells = expand_levels(cells, config.segments, config.total_label)
    if bucket and points is not None:  # a point may lie in a stretch where its group has no entry
        cells = cells.unionByName(points.select(*cells.columns))
    cells = cells.groupBy(*GROUP, *bucket).agg(*sums)
    group = Window.partitionBy(*GROUP)
    earlier = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    return cells.select(
        *GROUP,
        *bucket,
        *[(F.coalesce(F.sum(c).over(earlier), zero) if bucket else zero).alias(c) for c in COUNTS],
        *[(F.sum(c).over(group) if bucket else F.col(c)).alias(f"total_{c}") for c in COUNTS],
    )


def score_profile(histogram: Histogram, config: MonitorConfig, points: DataFrame | None = None) -> DataFrame:
    """Histogram at all segment levels with ``cum_*`` (up to and including the value, ascending) and ``total_*`` (whole group).

    ``points`` are extra empty entries (``cohort, score, level, value``) at which running totals will be read; they add
    no rows to any count. Points of groups without entries are dropped.
    """
    buckets = buckets_of(histogram.base)
    bucket, zero, segments = buckets.columns, F.lit(0).cast("bigint"), config.segments
    entries = buckets.placed(histogram.base)
    if points is not None:
        points = buckets.placed(points.withColumns({c: zero for c in COUNTS}))
    starts = _starts(entries, points, config, bucket)
    dealt = entries.withColumn("is_point", F.lit(False)).unionByName(starts, allowMissingColumns=True)
    if points is not None:
        dealt = dealt.unionByName(points.withColumn("is_point", F.lit(True)), allowMissingColumns=True)

    place = ["cohort", "score", *bucket]
    levels = F.when(F.col("level").isNull(), F.array(*level_structs(segments, config.total_label))).otherwise(F.array("level"))
    totals = [f"total_{c}" for c in COUNTS]
    # As a struct the totals are combined in the order of the keys: a task sorts its entries once, for the sums and the
    # window, and holds no table of all its groups. The number of tasks grows with the entries, so that a task's do not.
    cubed = (
        dealt.repartition(buckets.tasks, *place)
        .select(*place, "value", *COUNTS, "is_point", F.struct(*totals).alias("whole"), F.explode(levels).alias("level"))
        .groupBy(*place, "level", "value")
        .agg(*[F.sum(c).alias(c) for c in COUNTS], F.bool_or("is_point").alias("is_point"), F.max("whole").alias("whole"))
    )
    # The entry without a value comes first.
    upto = Window.partitionBy(*place, "level").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = {f"cum_{c}": F.sum(c).over(upto) for c in COUNTS} | {"whole": F.first("whole").over(upto)}
    profile = cubed.withColumns(running).withColumns({t: F.col(f"whole.{t}") for t in totals})
    return profile.filter("value IS NOT NULL AND total_n > 0").drop("whole", *bucket)


def profile_summary(profile: DataFrame, config: MonitorConfig, gap: Column) -> tuple[DataFrame, DataFrame]:
    """Both things a run needs of a profile, in one pass over it: (largest ``gap`` per group as ``ks``, the
    profile rows at which a percentile may be reached or a point was placed).

    A group keeps about one row per percentile and point, collected on the map side.
    """
    fields = [c for c in profile.columns if c not in GROUP]
    marked = F.when(F.col("is_point") | may_reach_any(config.scores), F.struct(*fields))
    summary = cut_lineage(profile.groupBy(*GROUP).agg(F.max(gap).alias("ks"), F.collect_list(marked).alias("marks")))
    return summary.select(*GROUP, "ks"), summary.select(*GROUP, F.inline("marks"))
