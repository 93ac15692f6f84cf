"""Complete monitoring runs: from cohort rows to the four result tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.literals import cohorts_in, is_one_of
from tidemark.operators.capture import capture, precision
from tidemark.operators.counters import RunCounts
from tidemark.operators.cohorts import cohort_list, missing_cohorts, pending_cohorts
from tidemark.operators.histogram import GROUP, present_groups, score_rows
from tidemark.operators.ks import cohort_totals, ks, with_gap
from tidemark.operators.percentiles import (
    baseline_report,
    compared_tails,
    cutoff_points,
    milestones,
    own_points,
    own_tails,
    production_report,
    tails_at_points,
    tails_of_report,
    tails_under_baseline,
)
from tidemark.operators.profile import Histogram, profile_summary, score_histogram, score_profile
from tidemark.operators.segments import level_columns
from tidemark.operators.psi import cumulative_psi
from tidemark.plans.config import BASELINE_COHORT, MonitorConfig
from tidemark.sources.cohort_tables import baseline_csv, cohort_csv, cohort_rows, has_status, needed_columns
from tidemark.sources.histogram_state import HistogramState, fingerprint
from tidemark.sources.results import ResultStore, complete, csv_path, export_csv, read_csv, result_schema
from tidemark.sources.scratch import cut_lineage, scratch_scope


@dataclass(frozen=True)
class Reports:
    """Results of a run: small plans over tables that the run has computed and stored."""

    percentiles_baseline: DataFrame
    percentiles: DataFrame
    psi: DataFrame
    ks: DataFrame
    capture: DataFrame
    precision: DataFrame
    missing: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "percentiles": self.percentiles,
            "psi": self.psi,
            "capture": self.capture,
            "precision": self.precision,
            "ks": self.ks,
        }


def monitored_histogram(
    rows: DataFrame, config: MonitorConfig, baseline_rows: DataFrame | None = None, counts: RunCounts | None = None
) -> Histogram:
    """One histogram for all cohorts a run needs, the baseline's included: one scan of the rows, which ``counts`` watches."""
    wanted = cohort_rows(rows, config, {*config.production_cohorts, *config.baseline_cohorts})
    if baseline_rows is not None:
        labelled = baseline_rows.select(*needed_columns(config)).withColumn(
            config.cohort_column, F.lit(BASELINE_COHORT)
        )
        wanted = wanted.withColumn(config.cohort_column, F.col(config.cohort_column).cast("string"))
        wanted = wanted.unionByName(labelled)
    watched = wanted if counts is None else counts.watch(wanted)
    histogram = score_histogram(score_rows(watched, config), config)
    if counts is not None:
        counts.read(wanted, histogram.base)
    return histogram


def state_histogram(state: HistogramState, rows: DataFrame | None, config: MonitorConfig) -> Histogram:
    """The histogram from stored state; only cohorts that it doesn't have are scanned, where there are rows."""
    if fingerprint(config) != fingerprint(state.config):
        raise ValueError("the stored histogram was made under another configuration")
    wanted = sorted({*config.production_cohorts, *config.baseline_cohorts})
    if rows is not None:
        state.refresh(rows, wanted)
    if not state.cohorts():
        if rows is None:
            raise ValueError("the stored histogram is empty and there are no rows to make it of")
        return monitored_histogram(rows, config)
    return Histogram(state.base(wanted))


def baseline_tails(histogram: Histogram, config: MonitorConfig) -> DataFrame:
    """Baseline cut-offs and tails, computed once and kept: a few rows per segment level and score."""
    cohorts = config.baseline_cohorts or (BASELINE_COHORT,)
    profile = score_profile(histogram.of(cohorts, BASELINE_COHORT), config)
    return cut_lineage(own_tails(milestones(profile, config)))


def production_profile(histogram: Histogram, config: MonitorConfig, base_tails: DataFrame) -> DataFrame:
    """Profile of the monitored cohorts, with the baseline cut-offs as points in it."""
    monitored = histogram.of(config.production_cohorts)
    groups = present_groups(monitored.base, config)
    points = cutoff_points(base_tails, groups, monitored.base.schema["value"].dataType)
    return score_profile(monitored, config, points)


def production_tails(profile: DataFrame, base_tails: DataFrame, config: MonitorConfig) -> DataFrame:
    """Tails of the monitored cohorts under own and baseline cut-offs."""
    return compared_tails(cut_lineage(milestones(profile, config)), base_tails)


def percentile_tables(
    rows: DataFrame, config: MonitorConfig, baseline_rows: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Percentile tables of the baseline and of the monitored cohorts."""
    histogram = monitored_histogram(rows, config, baseline_rows)
    base_tails = baseline_tails(histogram, config)
    tails = production_tails(production_profile(histogram, config, base_tails), base_tails, config)
    return baseline_report(base_tails, config.segments), production_report(tails, config.segments)


def ks_table(rows: DataFrame, config: MonitorConfig, totals: str = "segment") -> DataFrame:
    """KS of the monitored cohorts; needs no baseline. ``totals`` is ``segment`` or ``cohort``."""
    wanted = cohort_rows(rows, config, config.production_cohorts)
    histogram = score_histogram(score_rows(wanted, config), config)
    return ks(score_profile(histogram, config), config.segments, _whole(histogram, totals))


def _whole(histogram: Histogram, totals: str) -> DataFrame | None:
    if totals not in ("segment", "cohort"):
        raise ValueError(f"totals must be 'segment' or 'cohort', not {totals!r}")
    return cohort_totals(histogram.base) if totals == "cohort" else None


def capture_table(
    rows: DataFrame, config: MonitorConfig, baseline_table: DataFrame, production_table: DataFrame
) -> DataFrame:
    """Capture of the monitored cohorts under cut-offs stored in percentile tables."""
    histogram = monitored_histogram(rows, replace(config, baseline_cohorts=()))
    value_type = histogram.base.schema["value"].dataType
    base = tails_of_report(baseline_table, config)
    own = tails_of_report(production_table, config)
    months = config.production_cohorts
    points = cutoff_points(base, present_groups(histogram.base, config), value_type).unionByName(
        own_points(own.filter(is_one_of("cohort", map(str, months))), value_type)
    )
    marks = cut_lineage(milestones(score_profile(histogram, config, points), config))
    tails = tails_at_points(marks, own).join(tails_under_baseline(marks, base), [*GROUP, "pctl"], "left")
    return capture(tails, config.segments)


def monitor(
    rows: DataFrame | None,
    config: MonitorConfig,
    baseline_rows: DataFrame | None = None,
    baseline_table: DataFrame | None = None,
    ks_totals: str = "segment",
    state: HistogramState | None = None,
    counts: RunCounts | None = None,
) -> Reports:
    """Compute every report for the configured cohorts.

    ``rows`` holds all cohorts in one table. The baseline comes from ``baseline_table`` (a percentile
    table of an earlier run), else from ``baseline_rows``, else from the baseline cohorts in ``rows``.
    The rows are scanned once, whatever the number of cohorts, scores, segments and reports. With ``state`` only
    cohorts that the state lacks are scanned, and none without ``rows``; its baseline is that of the baseline cohorts.
    ``counts`` learns what kinds of rows were read.
    """
    if state is not None and (baseline_rows is not None or counts is not None):
        raise ValueError("the baseline of a stored histogram is one of its cohorts, and its rows are not read")
    spark, segments = (rows.sparkSession if rows is not None else state.store.spark), config.segments
    if baseline_table is not None:
        config = replace(config, baseline_cohorts=())
    if state is not None:
        histogram = state_histogram(state, rows, config)
    else:
        histogram = monitored_histogram(rows, config, baseline_rows, counts)
    if baseline_table is not None:
        base_table = baseline_table.filter(F.col("cohort") == BASELINE_COHORT)
        base_tails = tails_of_report(base_table, config)
    else:
        base_tails = baseline_tails(histogram, config)
        base_table = baseline_report(base_tails, segments)

    whole = _whole(histogram.of(config.production_cohorts), ks_totals)
    profile, gap = with_gap(production_profile(histogram, config, base_tails), whole)
    largest, marked = profile_summary(profile, config, gap)
    tails = cut_lineage(compared_tails(milestones(marked, config), base_tails))
    percentiles = production_report(tails, segments)
    requested = cohort_list(spark, config.production_cohorts)
    # Months without any valid score are reported like months without input.
    present = largest.select(F.col("cohort").cast("int").alias("cohort"))
    return Reports(
        percentiles_baseline=base_table,
        percentiles=percentiles,
        psi=cumulative_psi(percentiles, base_table, segments, config.total_label),
        ks=largest.select("cohort", "score", *level_columns(segments), "ks"),
        capture=capture(tails, segments),
        precision=precision(tails, segments),
        missing=missing_cohorts(requested, present),
    )


def run_and_store(
    rows: DataFrame,
    config: MonitorConfig,
    store: ResultStore,
    baseline_rows: DataFrame | None = None,
    ks_totals: str = "segment",
    state: HistogramState | None = None,
) -> list[int]:
    """Monitor the cohorts that have no stored result yet (all of them when overwriting) and publish them.

    All tables of a run, its baseline included, are published in one step: a run that is cut short anywhere leaves the
    store as it was. A baseline without any valid score stops the run. Returns the cohorts that were computed.
    """
    spark = rows.sparkSession
    done = store.cohorts("ks").select(F.expr("try_cast(cohort AS int)").alias("cohort"))
    todo = pending_cohorts(cohort_list(spark, config.production_cohorts), done, config.overwrite)
    months = sorted(r["cohort"] for r in todo.collect())  # no more rows than months asked for
    if not months:
        return []

    known = None
    if store.exists("percentiles_baseline") and not (config.include_baseline and config.overwrite):
        columns = ["score", *config.segments, "pctl", "cutoff", "tail_n", "tail_pct", "cohort"]
        known = store.read("percentiles_baseline", result_schema(columns, config.segments))
    # Exactly the pending months, and the baseline's only where it is computed: finished ones stay as they are.
    read = (*months, *(config.baseline_cohorts if known is None else ()))
    run = store.run()
    with scratch_scope(spark):
        reports = monitor(
            rows.filter(cohorts_in(rows, config.cohort_column, read)),
            replace(config, only_cohorts=tuple(months)),
            baseline_rows,
            known,
            ks_totals,
            state,
        )
        if known is None:
            found = run.write("percentiles_baseline", reports.percentiles_baseline)
            if not found and (config.baseline_cohorts or baseline_rows is not None):
                raise ValueError("the baseline has no valid score; nothing is published")
        for name, table in reports.tables().items():
            run.write(name, table)
    run.commit()
    return months


def monitor_files(
    spark: SparkSession, execution: str | Mapping[str, Any], monitoring: str | Mapping[str, Any]
) -> list[int]:
    """The file-based run: two JSON parameter documents (paths or contents) in, one CSV directory per result and cohort out.

    Months that have all results are left alone unless ``overwrite_percentis`` says so; likewise the
    baseline's percentiles, which also stand in where there is no baseline file. Scores with configured
    special values and no status column in the files have their status derived. The number of jobs does not depend on
    the number of months. Returns the months that were written.
    """
    config = MonitorConfig.from_files(execution, monitoring, cohort_column="safra")
    names = ("percentiles", "psi", "capture", "ks")

    def finished(month: int) -> bool:
        return all(complete(spark, csv_path(n, config.result_folder, month)) for n in names)

    pending = [c for c in config.production_cohorts if config.overwrite or not finished(c)]
    if not pending:
        return []
    config = replace(config, only_cohorts=tuple(pending), derive_status=not has_status(spark, config, pending))
    baseline = known = None
    is_stored = complete(spark, csv_path("percentiles", config.result_folder, BASELINE_COHORT))
    if config.include_baseline and (config.overwrite or not is_stored):
        baseline = baseline_csv(spark, config)
    if baseline is None:
        if not is_stored:
            raise FileNotFoundError(f"neither a baseline file nor stored baseline percentiles for {config.data_prefix}")
        known = stored_baseline_csv(spark, config)
    with scratch_scope(spark):
        reports = monitor(cohort_csv(spark, config, pending), config, baseline, known, ks_totals="cohort")
        if baseline is not None:
            export_csv("percentiles", reports.percentiles_baseline, config.result_folder, [BASELINE_COHORT])
        missing = {r["cohort"] for r in reports.missing.collect()}
        months = [c for c in pending if c not in missing]
        for name in names:
            export_csv(name, reports.tables()[name], config.result_folder, months)
    return months


def stored_baseline_csv(spark: SparkSession, config: MonitorConfig) -> DataFrame:
    """The baseline percentile table an earlier file-based run exported."""
    return read_csv(spark, "percentiles", config.result_folder, [BASELINE_COHORT], config.segments)
