"""

The main fixture turns ``lineitem`` into scored rows: month of shipping as cohort, return flag and
line status as segments, two integer scores (one risky at the high end, one at the low end) and a
binary response. The months of 1995 are the baseline, all later months up to the last one in the table are
monitored, so every query works on the whole table.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace
from importlib.util import find_spec

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scores import band_midpoint as midpoint_of
from tidemark.functions.scores import clip, fill_null
from tidemark.functions.scores import score_status as status_of
from tidemark.operators import capture as capture_ops
from tidemark.operators import cohorts as cohort_ops
from tidemark.operators import ks as ks_ops
from tidemark.operators import percentiles as pctl_ops
from tidemark.operators.histogram import base_histogram, cubed_histogram, leveled_histogram, score_rows
from tidemark.operators.profile import score_histogram as histogram_of
from tidemark.operators.profile import score_profile
from tidemark.operators.counters import RunCounts
from tidemark.operators.psi import binned_psi, cumulative_psi
from tidemark.operators.segments import level_columns, segment_cube as cube_rows
from tidemark.plans.config import BASELINE_COHORT, MonitorConfig, ScoreSpec, SpecialValue, month_list
from tidemark.plans.jobs import (
    baseline_tails,
    capture_table,
    ks_table,
    monitor,
    monitor_files,
    monitored_histogram,
    percentile_tables,
    production_profile,
    production_tails,
    run_and_store,
)
from tidemark.plans.percentile_plan import percentile_plan as plan_table
from tidemark.plans.percentile_plan import target_rank
from tidemark.sources.cohort_tables import (
    baseline_csv,
    baseline_rows,
    cohort_csv,
    cohort_table,
    cohort_tables,
    write_cohort_csv,
)
from tidemark.sources.histogram_state import HistogramState
from tidemark.sources.results import ResultStore, read_csv, result_schema
from tidemark.sources.scratch import cut_lineage, scratch_path

# The package works without its training-data operators; where they are there, a broken import shows.
if find_spec("tidemark.llm") and find_spec("tidemark.llm.queries") and find_spec("corpus_pipeline"):
    from tidemark.llm import queries as llm_queries
else:
    llm_queries = None

FIRST = 199601  # the last month is the table's own, see _to_the_end
PPV, DIST = (5, 15, 25), tuple(range(10, 101, 10))
CONFIG = MonitorConfig(
    scores=(
        ScoreSpec("score_1", PPV, DIST, special_values=(SpecialValue(-1, "score especial"),)),
        ScoreSpec("score_2", PPV, DIST, high_tail=False, valid_range=(0, 1000)),
    ),
    segments=("group_ab", "group_xy"),
    first_cohort=FIRST,
    last_cohort=FIRST,
    baseline_cohorts=month_list(199501, 199512),
)
SEGMENTS = list(CONFIG.segments)
PRICE = MonitorConfig(
    scores=(ScoreSpec("price", PPV, DIST),),
    segments=("o_orderstatus", "o_orderpriority"),
    first_cohort=199501,
    last_cohort=199501,
    derive_status=True,
)

# The same text runs in Spark and in DuckDB.
MON_SQL = """
SELECT CAST(extract(year FROM l_shipdate) * 100 + extract(month FROM l_shipdate) AS INT) AS safra,
       l_returnflag AS group_ab,
       l_linestatus AS group_xy,
       CASE WHEN l_orderkey % 100 = 0 THEN -1
            ELSE CAST(floor(l_extendedprice / 105) AS INT) END AS score_1,
       CASE WHEN l_orderkey % 100 = 0 THEN 'score especial'
            ELSE 'score válido' END AS score_1_status,
       CAST(l_quantity AS INT) * 21 AS score_2,
       CASE WHEN CAST(l_quantity AS INT) * 21 BETWEEN 0 AND 1000 THEN 'score válido'
            ELSE 'score inválido' END AS score_2_status,
       CASE WHEN (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 5000
                 < floor(l_extendedprice / 105) THEN 1 ELSE 0 END AS flag_1
FROM lineitem"""
PRICE_SQL = """
SELECT CAST(extract(year FROM o_orderdate) * 100 + extract(month FROM o_orderdate) AS INT) AS safra,
       o_orderstatus, o_orderpriority, o_totalprice AS price,
       CASE WHEN (o_orderkey * 7919) % 2500000 < o_totalprice THEN 1 ELSE 0 END AS flag_1
FROM orders"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mon(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    return spark.sql(MON_SQL.replace("FROM lineitem", "FROM {lineitem}"), lineitem=lineitem)


def _price(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return spark.sql(PRICE_SQL.replace("FROM orders", "FROM {orders}"), orders=orders)


def _to_the_end(rows: DataFrame, config: MonitorConfig) -> MonitorConfig:
    """The configuration with the table's last month as the last one: one number to the driver."""
    return replace(config, last_cohort=rows.agg(F.max(config.cohort_column)).first()[0] or config.first_cohort)


def _as_double(df: DataFrame, *names: str) -> DataFrame:
    """Nullable counts as doubles, the one numeric type that clients represent alike when it has nulls."""
    return df.withColumns({c: F.col(c).cast("double") for c in names})


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_rows(_mon(spark, sf_dir), CONFIG)


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_profile(histogram_of(_long(spark, sf_dir), CONFIG), CONFIG)


def _compared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _mon(spark, sf_dir)
    config = _to_the_end(rows, CONFIG)
    histogram = monitored_histogram(rows, config)
    base = baseline_tails(histogram, config)
    return base, production_tails(production_profile(histogram, config, base), base, config)


def _own_tails(profile: DataFrame, config: MonitorConfig) -> DataFrame:
    return pctl_ops.own_tails(pctl_ops.milestones(profile, config))


# --- sources, sinks and cohorts ---------------------------------------------------------------


def cohort_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _mon(spark, sf_dir)
    rows.createOrReplaceTempView("scored_rows")
    config = _to_the_end(rows, CONFIG)
    return cohort_table(spark, "scored_rows", config, config.production_cohorts)


def _yearly(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, MonitorConfig, list[int]]:
    """The fixture with one cohort a year."""
    rows = _mon(spark, sf_dir).withColumn("safra", F.expr("safra div 100 * 100 + 1").cast("int"))
    config = _to_the_end(rows, MonitorConfig(CONFIG.scores, CONFIG.segments, 199501, data_folder=scratch_path(spark, "csv")))
    return rows, config, [c for c in config.production_cohorts if c % 100 == 1]


def csv_cohort_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly cohorts written as one CSV directory each and read back as one table."""
    rows, config, years = _yearly(spark, sf_dir)
    write_cohort_csv(rows, config, years)
    read = cohort_csv(spark, config, config.production_cohorts)
    return read.withColumns({s: F.col(s).cast("int") for s in CONFIG.score_names})


def cohort_tables_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalog table for each yearly cohort; months without a table are absent."""
    rows, config, years = _yearly(spark, sf_dir)
    for year in years:
        rows.filter(F.col("safra") == year).createOrReplaceTempView(f"scored_{year}")
    return cohort_tables(spark, "scored_{cohort}", config, config.production_cohorts)


def baseline_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline months written as the baseline file and read back."""
    config = replace(CONFIG, data_folder=scratch_path(spark, "csv"))
    write_cohort_csv(baseline_rows(_mon(spark, sf_dir), CONFIG), config, [BASELINE_COHORT])
    return baseline_csv(spark, config).withColumns({s: F.col(s).cast("int") for s in CONFIG.score_names})


def baseline_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline_rows(_mon(spark, sf_dir), CONFIG)


def _period(spark: SparkSession, sf_dir: str, pad: int = 0) -> DataFrame:
    ends = _mon(spark, sf_dir).agg(F.min("safra").alias("a"), F.max("safra").alias("b"))
    return ends.select(
        cohort_ops.shift_cohort(F.col("a"), -pad).alias("first_cohort"),
        cohort_ops.shift_cohort(F.col("b"), pad).alias("last_cohort"),
    )


def month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort_ops.month_spine(_period(spark, sf_dir))


def missing_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = cohort_ops.month_spine(_period(spark, sf_dir, pad=3))
    present = _mon(spark, sf_dir).select(F.col("safra").alias("cohort"))
    return cohort_ops.missing_cohorts(requested, present)


def incremental_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months still to compute after a first run stored everything up to 1998."""
    store = ResultStore(spark, scratch_path(spark, "incremental"))
    rows = _mon(spark, sf_dir)
    totals = capture_ops.positive_totals(base_histogram(score_rows(rows, CONFIG), CONFIG), CONFIG)
    store.write("totals", totals.filter(F.col("cohort") <= "199812"))
    requested = cohort_ops.month_spine(_period(spark, sf_dir))
    done = store.cohorts("totals").select(F.col("cohort").cast("int").alias("cohort"))
    return cohort_ops.pending_cohorts(requested, done)


def results_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KS results stored as CSV; one year is then written again and replaces only itself."""
    store = ResultStore(spark, scratch_path(spark, "results"), "csv")
    table = cut_lineage(ks_ops.ks(_profile(spark, sf_dir), SEGMENTS))
    store.write("ks", table.withColumn("ks", F.when(F.col("cohort") < "199601", -1.0).otherwise(F.col("ks"))))
    store.write("ks", table.filter(F.col("cohort") < "199601"))
    stored = store.read("ks", result_schema(["score", *SEGMENTS, "ks", "cohort"], SEGMENTS))
    return _rounded(stored, ks=9)


def union_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, tails = _compared(spark, sf_dir)
    both = cohort_ops.union_results(
        pctl_ops.baseline_report(base, SEGMENTS), pctl_ops.production_report(tails, SEGMENTS)
    )
    return _as_double(_rounded(both, tail_pct=9, base_tail_pct=9), "base_cutoff", "base_tail_n")


# --- scalar functions and the plan ------------------------------------------------------------


def score_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, two = CONFIG.scores
    return _mon(spark, sf_dir).select(
        "safra", "score_1", status_of(one).alias("status_1"), "score_2", status_of(two).alias("status_2")
    )


def valid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(spark, sf_dir)


BAND_SQL = """
SELECT c_custkey,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN '<1k' WHEN c_acctbal < 2000 THEN '1k~3k'
            WHEN c_acctbal < 3000 THEN '3k~5k' WHEN c_acctbal < 4000 THEN '5k~10k'
            WHEN c_acctbal < 5000 THEN '10k~20k' WHEN c_acctbal < 6000 THEN '20k~30k'
            WHEN c_acctbal < 7000 THEN '30k+' ELSE 'outra' END AS band
FROM customer"""


def band_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    bands = spark.sql(BAND_SQL.replace("FROM customer", "FROM {customer}"), customer=customer)
    return bands.withColumn("midpoint", midpoint_of(F.col("band")))


def clip_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    return _table(spark, sf_dir, "customer").select(
        "c_custkey",
        clip(balance, 0.0, 5000.0).alias("clipped"),
        fill_null(balance).alias("filled"),
        clip(balance, low=0.0).alias("floored"),
    )


def percentile_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan applied to the data: which rank each percentile is, per cohort and score."""
    totals = _long(spark, sf_dir).groupBy("cohort", "score").agg(F.count("*").alias("total_n"))
    plan = plan_table(spark, CONFIG.scores)
    return totals.join(F.broadcast(plan), "score").select(
        "cohort", "score", "pctl", "is_ppv", "high_tail", "total_n", target_rank().alias("target_rank")
    )


# --- segments, histogram, percentiles, tails --------------------------------------------------


def segment_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube_rows(
        _mon(spark, sf_dir),
        ["safra"],
        SEGMENTS,
        [
            F.count("*").alias("n"),
            F.count_if(F.col("flag_1") == 1).alias("hits"),
            F.max("score_1").alias("max_score"),
        ],
    )


def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = base_histogram(_long(spark, sf_dir), CONFIG)
    cubed = cubed_histogram(leveled_histogram(base, CONFIG))
    return cubed.select(
        "cohort", "score", F.col("level.gid").alias("gid"), *level_columns(SEGMENTS), "value", "n", "pos", "neg"
    )


def _cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tails = _own_tails(_profile(spark, sf_dir), CONFIG)
    return tails.select("score", "cohort", *level_columns(SEGMENTS), "pctl", "cutoff")


def cutoffs_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cutoffs(spark, sf_dir)


def cutoffs_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pctl_ops.approximate_cutoffs(_long(spark, sf_dir), CONFIG, accuracy=1_000_000)


def cutoffs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pctl_ops.wide_cutoffs(_cutoffs(spark, sf_dir), SEGMENTS, DIST)


def cutoffs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pctl_ops.long_cutoffs(cutoffs_wide(spark, sf_dir), SEGMENTS, DIST)


def _tail_counts(spark: SparkSession, sf_dir: str, score: ScoreSpec) -> DataFrame:
    config = MonitorConfig((score,), CONFIG.segments)
    profile = score_profile(histogram_of(score_rows(_mon(spark, sf_dir), config), config), config)
    report = pctl_ops.baseline_report(_own_tails(profile, config), SEGMENTS)
    return _rounded(report, tail_pct=9)


def tail_counts_ge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tail_counts(spark, sf_dir, CONFIG.scores[0])


def tail_counts_le(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tail_counts(spark, sf_dir, CONFIG.scores[1])


def prod_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tails = _compared(spark, sf_dir)
    return _rounded(pctl_ops.production_report(tails, SEGMENTS), tail_pct=9, base_tail_pct=9)


# --- metrics ----------------------------------------------------------------------------------


def psi_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, tails = _compared(spark, sf_dir)
    psi = cumulative_psi(
        pctl_ops.production_report(tails, SEGMENTS), pctl_ops.baseline_report(base, SEGMENTS), SEGMENTS
    )
    return _rounded(psi, psi=6)


def psi_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, tails = _compared(spark, sf_dir)
    psi = binned_psi(pctl_ops.production_report(tails, SEGMENTS), pctl_ops.baseline_report(base, SEGMENTS), SEGMENTS)
    return _rounded(psi, psi=6)


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run has read of each score, observed while its histogram was made."""
    rows = _mon(spark, sf_dir)
    config = _to_the_end(rows, CONFIG)
    counts = RunCounts(config)
    monitored_histogram(rows, config, counts=counts)
    return counts.table(spark)


def ks_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ks_ops.ks_curve(_profile(spark, sf_dir), SEGMENTS), pos_rate=9, neg_rate=9)


def ks_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _mon(spark, sf_dir)
    config = _to_the_end(rows, replace(CONFIG, first_cohort=199501, baseline_cohorts=()))
    return _rounded(ks_table(rows, config), ks=9)


def ks_global_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _mon(spark, sf_dir)
    config = _to_the_end(rows, replace(CONFIG, first_cohort=199501, baseline_cohorts=()))
    return _rounded(ks_table(rows, config, totals="cohort"), ks=9)


def fraud_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_ops.positive_totals(base_histogram(_long(spark, sf_dir), CONFIG), CONFIG)


def fraud_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tails = _compared(spark, sf_dir)
    capture = capture_ops.capture(tails, SEGMENTS)
    return _as_double(_rounded(capture, base_capture_pct=9, prod_capture_pct=9), "base_hits")


def fraud_capture_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture under percentile tables that were stored by an earlier step."""
    rows = _mon(spark, sf_dir)
    config = _to_the_end(rows, CONFIG)
    store = ResultStore(spark, scratch_path(spark, "percentiles"))
    for table in percentile_tables(rows, config):
        store.write("percentiles", table.select("score", "cohort", *SEGMENTS, "pctl", "cutoff", "tail_n", "tail_pct"))
    stored = store.read("percentiles")
    is_base = F.col("cohort") == BASELINE_COHORT
    capture = capture_table(rows, config, stored.filter(is_base), stored.filter(~is_base))
    return _as_double(_rounded(capture, base_capture_pct=9, prod_capture_pct=9), "base_hits")


def fraud_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tails = _compared(spark, sf_dir)
    return _rounded(capture_ops.precision(tails, SEGMENTS), base_precision_pct=9, prod_precision_pct=9)


def _price_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = histogram_of(score_rows(_price(spark, sf_dir), PRICE), PRICE)
    return score_profile(histogram, PRICE)


def cutoffs_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut-offs and tails of a score with almost no repeated value."""
    tails = _own_tails(_price_profile(spark, sf_dir), PRICE)
    return _rounded(pctl_ops.baseline_report(tails, PRICE.segments), tail_pct=9)


def ks_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ks_ops.ks(_price_profile(spark, sf_dir), PRICE.segments), ks=9)


def _stacked(tables: dict[str, DataFrame], segments) -> DataFrame:
    """Result tables as (report, keys, measured value)."""
    keys = ["cohort", "score", *segments]
    no_pctl = F.lit(None).cast("double").alias("pctl")
    pctl = F.col("pctl")
    measured = {
        "percentiles": (pctl, "tail_pct"),
        "percentiles_baseline": (pctl, "tail_pct"),
        "psi": (no_pctl, "psi"),
        "ks": (no_pctl, "ks"),
        "capture": (pctl, "base_capture_pct"),
    }
    return cohort_ops.union_results(
        *(
            tables[name].select(F.lit(name).alias("report"), *keys, at, F.round(value, 6).alias("measured"))
            for name, (at, value) in measured.items()
        )
    )


def _monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run, its four result tables stacked."""
    rows = _mon(spark, sf_dir)
    reports = monitor(rows, _to_the_end(rows, CONFIG))
    return _stacked(reports.tables() | {"percentiles_baseline": reports.percentiles_baseline}, SEGMENTS)


def monitor_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run over a score with almost no repeated value; the baseline is 1995."""
    rows = _price(spark, sf_dir)
    config = _to_the_end(rows, replace(PRICE, first_cohort=FIRST, baseline_cohorts=month_list(199501, 199512)))
    reports = monitor(rows, config)
    return _stacked(reports.tables() | {"percentiles_baseline": reports.percentiles_baseline}, PRICE.segments)


def monitor_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored runs, the second only over the months the first has left out; all tables read back."""
    rows, store = _mon(spark, sf_dir), ResultStore(spark, scratch_path(spark, "monitor"))
    run_and_store(rows, replace(CONFIG, last_cohort=199812), store)
    run_and_store(rows, _to_the_end(rows, CONFIG), store)
    return _stored(store)


def _stored(store: ResultStore) -> DataFrame:
    names = ("percentiles", "percentiles_baseline", "psi", "ks", "capture")
    return _stacked({name: store.read(name) for name in names}, SEGMENTS)


class _Killed(Exception):
    """Stands for the end of a driver."""


class _KilledStore(ResultStore):
    """A store whose runs end in the middle: after so many writes, before they publish anything."""

    writes = 3

    def run(self):
        run, write = super().run(), ResultStore.run(self).write
        left = iter(range(self.writes))

        def some(*table):
            if next(left, None) is None:
                raise _Killed
            return write(*table)

        run.write = some
        return run


def crash_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is killed between two of its writes, the same run again, and all tables read back."""
    rows, folder = _mon(spark, sf_dir), scratch_path(spark, "crash")
    config = _to_the_end(rows, CONFIG)
    try:
        run_and_store(rows, config, _KilledStore(spark, folder))
    except _Killed:
        pass
    store = ResultStore(spark, folder)
    if store.exists("percentiles_baseline") or run_and_store(rows, config, store) != list(config.production_cohorts):
        raise AssertionError("the killed run has left results behind")
    return _stored(store)


def monitor_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run from a stored histogram: made under other percentiles and directions, a tenth of the rows added
    late and twice under one name, and no rows at hand when the reports are made."""
    rows, store = _mon(spark, sf_dir), ResultStore(spark, scratch_path(spark, "state"))
    config = _to_the_end(rows, CONFIG)
    others = tuple(replace(s, ppv_percentiles=(1,), dist_percentiles=(), high_tail=not s.high_tail) for s in config.scores)
    is_late = F.col("score_1") % 10 == 3
    early = HistogramState(store, replace(config, scores=others))
    early.refresh(rows.filter(~is_late), month_list(199501, config.last_cohort))
    for _ in range(2):
        early.add(rows.filter(is_late), "late")
    reports = monitor(None, config, state=HistogramState(store, config))
    return _stacked(reports.tables() | {"percentiles_baseline": reports.percentiles_baseline}, SEGMENTS)


def monitor_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file-based run: months and baseline as CSV directories, two parameter documents, results as CSV."""
    rows, folder = _mon(spark, sf_dir), scratch_path(spark, "files")
    config = replace(_to_the_end(rows, CONFIG), data_folder=f"{folder}/data", result_folder=f"{folder}/results")
    months = list(config.production_cohorts)
    write_cohort_csv(rows, config, months)
    write_cohort_csv(baseline_rows(rows, config), config, [BASELINE_COHORT])
    scores = {
        s.name: {"percentis_ppv": s.ppv_percentiles, "percentis_dist": s.dist_percentiles, "acumula_maiores": s.high_tail}
        for s in config.scores
    }
    period = {"data_inicio": config.first_cohort, "data_fim": config.last_cohort}
    execution = {"periodo_monitoramento": period, "incluir_baseline": True}
    monitoring = {"aberturas": SEGMENTS, "data_folder": config.data_folder, "result_folder": config.result_folder, "scores": scores}
    monitor_files(spark, execution, monitoring)
    done = [c for c in months if c in {r["safra"] for r in rows.select("safra").distinct().collect()}]
    names = ("percentiles", "psi", "ks", "capture")
    tables = {n: read_csv(spark, n, config.result_folder, done, SEGMENTS) for n in names}
    tables["percentiles_baseline"] = read_csv(spark, "percentiles", config.result_folder, [BASELINE_COHORT], SEGMENTS)
    return _stacked(tables, SEGMENTS)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: a complete monitoring run on sf0.001."""
    return _monitor(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "cohort_source": cohort_source,
        "csv_cohort_source": csv_cohort_source,
        "cohort_tables_source": cohort_tables_source,
        "baseline_source": baseline_source,
        "baseline_csv_source": baseline_csv_source,
        "month_spine": month_spine,
        "missing_cohorts": missing_cohorts,
        "incremental_cohorts": incremental_cohorts,
        "results_roundtrip": results_roundtrip,
        "union_results": union_results,
        "score_status": score_status,
        "valid_scores": valid_scores,
        "band_midpoint": band_midpoint,
        "clip_fill": clip_fill,
        "percentile_plan": percentile_plan,
        "segment_cube": segment_cube,
        "score_histogram": score_histogram,
        "cutoffs_exact": cutoffs_exact,
        "cutoffs_approx": cutoffs_approx,
        "cutoffs_wide": cutoffs_wide,
        "cutoffs_long": cutoffs_long,
        "cutoffs_continuous": cutoffs_continuous,
        "tail_counts_ge": tail_counts_ge,
        "tail_counts_le": tail_counts_le,
        "prod_vs_baseline": prod_vs_baseline,
        "psi_cumulative": psi_cumulative,
        "psi_binned": psi_binned,
        "run_counts": run_counts,
        "ks_curve": ks_curve,
        "ks_segment": ks_segment,
        "ks_global_totals": ks_global_totals,
        "ks_continuous": ks_continuous,
        "fraud_totals": fraud_totals,
        "fraud_capture": fraud_capture,
        "fraud_capture_stored": fraud_capture_stored,
        "fraud_precision": fraud_precision,
        "monitor_run": _monitor,
        "monitor_continuous": monitor_continuous,
        "monitor_stored": monitor_stored,
        "monitor_state": monitor_state,
        "monitor_csv": monitor_csv,
        "crash_rerun": crash_rerun,
    } | (llm_queries.queries() if llm_queries else {})


# --- the same results in plain SQL over the raw rows ------------------------------------------

_SEGS = "group_ab, group_xy"


def _cube_of(source: str, first: str, second: str, others: str) -> str:
    """Every combination of two segment columns, as four selects."""
    picks = [(first, second), (f"'TODOS' AS {first}", second), (first, f"'TODOS' AS {second}")]
    picks.append((f"'TODOS' AS {first}", f"'TODOS' AS {second}"))
    return " UNION ALL ".join(f"SELECT {others}, {a}, {b} FROM {source}" for a, b in picks)


def _plan_sql(config: MonitorConfig) -> str:
    rows = []
    for s in config.scores:
        ppv = {100 - p if s.high_tail else p for p in s.ppv_percentiles}
        for p in sorted(ppv | set(s.dist_percentiles)):
            rows.append(f"('{s.name}', {p}, {str(p in ppv).lower()}, {str(s.high_tail).lower()})")
    return f"plan(score, p, is_ppv, high_tail) AS (VALUES {', '.join(rows)})"


def _scored_sql(cohort: str) -> str:
    """CTEs: fixture, long rows, segment cube, plan, cut-offs by row number."""
    long_rows = " UNION ALL ".join(
        f"SELECT {cohort} AS cohort, '{s}' AS score, {_SEGS}, CAST({s} AS INT) AS value, flag_1 AS flag "
        f"FROM mon WHERE {s}_status = 'score válido'"
        for s in CONFIG.score_names
    )
    cube = _cube_of("scored", "group_ab", "group_xy", "cohort, score, value, flag")
    return f"""WITH mon AS ({MON_SQL}),
scored AS ({long_rows}),
cubed AS ({cube}),
{_plan_sql(CONFIG)},
{_CUT_SQL.format(segs=_SEGS)}"""


_CUT_SQL = """ranked AS (SELECT *,
    row_number() OVER (PARTITION BY cohort, score, {segs} ORDER BY value) AS rn,
    count(*) OVER (PARTITION BY cohort, score, {segs}) AS total
  FROM cubed),
cut AS (SELECT cohort, score, {segs}, p, is_ppv, high_tail, value AS cutoff, total
  FROM ranked JOIN plan USING (score) WHERE rn = greatest((total * p + 99) // 100, 1)),
totals AS (SELECT cohort, score, {segs}, count(*) AS total, count(*) FILTER (flag = 1) AS hits
  FROM cubed GROUP BY ALL),
own AS (SELECT cohort, score, {segs}, p, is_ppv, high_tail, cutoff,
    count(*) AS tail_n, count(*) FILTER (flag = 1) AS tail_pos, any_value(total) AS total
  FROM cut JOIN cubed USING (cohort, score, {segs})
  WHERE CASE WHEN high_tail THEN value >= cutoff ELSE value <= cutoff END GROUP BY ALL)"""

_MONTH = "CAST(safra AS VARCHAR)"
_SPLIT = f"CASE WHEN safra < {FIRST} THEN 'baseline' ELSE CAST(safra AS VARCHAR) END"

# Monitored tails under baseline cut-offs, next to own tails.
_BOTH_SQL = f""",
base AS (SELECT * EXCLUDE (cohort) FROM own WHERE cohort = 'baseline'),
under AS (SELECT c.cohort, c.score, c.group_ab, c.group_xy, b.p, b.cutoff AS base_cutoff,
    count(*) FILTER (CASE WHEN high_tail THEN value >= b.cutoff ELSE value <= b.cutoff END) AS base_tail_n,
    count(*) FILTER (flag = 1 AND CASE WHEN high_tail THEN value >= b.cutoff ELSE value <= b.cutoff END) AS base_pos
  FROM cubed c JOIN base b USING (score, {_SEGS}) WHERE c.cohort <> 'baseline' GROUP BY ALL),
prod AS (SELECT o.*, u.base_cutoff, coalesce(u.base_tail_n, 0) AS base_tail_n, u.base_pos, t.hits
  FROM own o LEFT JOIN under u USING (cohort, score, {_SEGS}, p) JOIN totals t USING (cohort, score, {_SEGS})
  WHERE o.cohort <> 'baseline')"""

_PROD_COLUMNS = f"""score, cohort, {_SEGS}, CAST(p AS DOUBLE) AS pctl, cutoff, tail_n,
  round(tail_n / total * 100, 9) AS tail_pct"""
_PSI_SELECT = f"""SELECT score, cohort, {_SEGS}, round(sum((pp - qq) * ln(pp / qq)), 6) AS psi FROM (
  SELECT prod.score, prod.cohort, group_ab, group_xy, prod.base_tail_n / prod.total * 100 + 1e-10 AS pp,
    base.tail_n / base.total * 100 + 1e-10 AS qq
  FROM prod JOIN base USING (score, {_SEGS}, p)) GROUP BY ALL"""


def _curve_sql(segs: str) -> str:
    """Cumulative positives and negatives over raw rows, highest score first, ties together."""
    w = f"OVER (PARTITION BY cohort, score, {segs} ORDER BY value DESC)"
    whole = f"OVER (PARTITION BY cohort, score, {segs})"
    return f"""curve AS (SELECT DISTINCT cohort, score, {segs}, value,
    CAST(sum(CASE WHEN flag = 1 THEN 1 ELSE 0 END) {w} AS BIGINT) AS cum_pos,
    CAST(sum(CASE WHEN flag = 0 THEN 1 ELSE 0 END) {w} AS BIGINT) AS cum_neg,
    count(*) FILTER (flag = 1) {whole} AS tot_pos, count(*) FILTER (flag = 0) {whole} AS tot_neg
  FROM cubed)"""


def _ks_select(segs: str, digits: int = 9) -> str:
    gap = "abs(cum_pos / nullif(tot_pos, 0) - cum_neg / nullif(tot_neg, 0))"
    return f"SELECT cohort, score, {segs}, round(max({gap}), {digits}) AS ks FROM curve GROUP BY ALL"


def _price_cte(cohort: str = _MONTH) -> str:
    segs = "o_orderstatus, o_orderpriority"
    cube = _cube_of("scored", "o_orderstatus", "o_orderpriority", "cohort, score, value, flag")
    return f"""WITH mon AS ({PRICE_SQL}),
scored AS (SELECT {cohort} AS cohort, 'price' AS score, {segs}, price AS value, flag_1 AS flag
  FROM mon WHERE price IS NOT NULL),
cubed AS ({cube}), {_plan_sql(PRICE)}, {_CUT_SQL.format(segs=segs)}"""


def oracle_sql() -> dict[str, str]:
    """The queries in SQL for DuckDB, written over raw rows without histogram."""
    mon = f"WITH mon AS ({MON_SQL})"
    monthly, split = _scored_sql(_MONTH), _scored_sql(_SPLIT) + _BOTH_SQL
    inputs = f"{_SEGS}, score_1, score_2, score_1_status, score_2_status, flag_1"
    ends = f"""{mon}, ends AS (SELECT strptime(CAST(min(safra) AS VARCHAR) || '01', '%Y%m%d') AS a,
  strptime(CAST(max(safra) AS VARCHAR) || '01', '%Y%m%d') AS b FROM mon)"""
    spine = "unnest(generate_series(a - INTERVAL {pad} MONTH, b + INTERVAL {pad} MONTH, INTERVAL 1 MONTH)) AS m"
    as_cohort = "CAST(year(m) * 100 + month(m) AS INT) AS cohort"
    tail_columns = f"""SELECT score, cohort, {_SEGS}, CAST(p AS DOUBLE) AS pctl, cutoff, tail_n,
  round(tail_n / total * 100, 9) AS tail_pct FROM own"""
    cutoffs = f"SELECT score, cohort, {_SEGS}, CAST(p AS DOUBLE) AS pctl, cutoff FROM cut"
    price_segs = "o_orderstatus, o_orderpriority"
    hits = "CASE WHEN base_tail_n > 0 THEN base_pos END"
    ks_pieces = _curve_sql(_SEGS)
    capture = f"""{split} SELECT {_SEGS}, CAST(p AS DOUBLE) AS pctl, CAST({hits} AS DOUBLE) AS base_hits,
  tail_pos AS prod_hits, hits AS total_hits, round({hits} / nullif(hits, 0) * 100, 9) AS base_capture_pct,
  round(tail_pos / nullif(hits, 0) * 100, 9) AS prod_capture_pct, cohort, score
FROM prod WHERE is_ppv AND base_cutoff IS NOT NULL"""
    run = f"""{split}, {ks_pieces}
SELECT 'percentiles' AS report, cohort, score, {_SEGS}, CAST(p AS DOUBLE) AS pctl,
  round(tail_n / total * 100, 6) AS measured FROM prod
UNION ALL SELECT 'percentiles_baseline', cohort, score, {_SEGS}, CAST(p AS DOUBLE), round(tail_n / total * 100, 6)
  FROM own WHERE cohort = 'baseline'
UNION ALL SELECT 'psi', cohort, score, {_SEGS}, NULL, psi FROM ({_PSI_SELECT})
UNION ALL SELECT 'ks', cohort, score, {_SEGS}, NULL, ks FROM ({_ks_select(_SEGS, 6)}) WHERE cohort <> 'baseline'
UNION ALL SELECT 'capture', cohort, score, {_SEGS}, CAST(p AS DOUBLE), round({hits} / nullif(hits, 0) * 100, 6)
  FROM prod WHERE is_ppv AND base_cutoff IS NOT NULL"""
    whole_ks = f"""SELECT cohort, score, {_SEGS}, max(abs(cum_pos / nullif(p, 0) - cum_neg / nullif(n, 0))) AS raw
FROM curve JOIN (SELECT DISTINCT cohort, score, tot_pos AS p, tot_neg AS n FROM curve
  WHERE group_ab = 'TODOS' AND group_xy = 'TODOS') USING (cohort, score) GROUP BY ALL"""
    return {
        "cohort_source": f"{mon} SELECT safra, {inputs} FROM mon WHERE safra >= {FIRST}",
        "csv_cohort_source": f"{mon} SELECT CAST(safra // 100 * 100 + 1 AS INT) AS safra, {inputs} FROM mon",
        "cohort_tables_source": f"{mon} SELECT CAST(safra // 100 * 100 + 1 AS INT) AS safra, {inputs} FROM mon",
        "baseline_source": f"{mon} SELECT 'baseline' AS safra, {inputs} FROM mon WHERE safra < {FIRST}",
        "baseline_csv_source": f"{mon} SELECT 'baseline' AS safra, {inputs} FROM mon WHERE safra < {FIRST}",
        "month_spine": f"{ends} SELECT {as_cohort} FROM (SELECT {spine.format(pad=0)} FROM ends)",
        "missing_cohorts": f"""{ends} SELECT {as_cohort} FROM (SELECT {spine.format(pad=3)} FROM ends)
WHERE year(m) * 100 + month(m) NOT IN (SELECT safra FROM mon)""",
        "incremental_cohorts": f"""{ends} SELECT {as_cohort} FROM (SELECT {spine.format(pad=0)} FROM ends)
WHERE year(m) * 100 + month(m) > 199812""",
        "results_roundtrip": f"{monthly}, {ks_pieces} {_ks_select(_SEGS)}",
        "union_results": f"""{split} SELECT {_PROD_COLUMNS}, NULL::DOUBLE AS base_cutoff, NULL::DOUBLE AS base_tail_n,
  NULL::DOUBLE AS base_tail_pct FROM own WHERE cohort = 'baseline' UNION ALL
SELECT {_PROD_COLUMNS}, CAST(base_cutoff AS DOUBLE), CAST(base_tail_n AS DOUBLE),
  round(base_tail_n / total * 100, 9) FROM prod""",
        "score_status": f"""{mon} SELECT safra, score_1,
  CASE WHEN score_1 = -1 THEN 'score especial' ELSE 'score válido' END AS status_1, score_2,
  CASE WHEN score_2 < 0 OR score_2 > 1000 THEN 'score inválido' ELSE 'score válido' END AS status_2 FROM mon""",
        "valid_scores": f"""{mon} SELECT safra AS cohort, {_SEGS}, flag_1 AS flag, 'score_1' AS score,
  CAST(score_1 AS INT) AS value FROM mon WHERE score_1_status = 'score válido' UNION ALL
SELECT safra, {_SEGS}, flag_1, 'score_2', CAST(score_2 AS INT) FROM mon WHERE score_2_status = 'score válido'""",
        "band_midpoint": f"""SELECT c_custkey, band, CAST(CASE band WHEN '<1k' THEN 0.5 WHEN '1k~3k' THEN 2
  WHEN '3k~5k' THEN 4 WHEN '5k~10k' THEN 7.5 WHEN '10k~20k' THEN 15 WHEN '20k~30k' THEN 25
  WHEN '30k+' THEN 35 END AS DOUBLE) AS midpoint FROM ({BAND_SQL})""",
        "clip_fill": """SELECT c_custkey, CASE WHEN v < 0 THEN 0 WHEN v > 5000 THEN 5000 ELSE v END AS clipped,
  coalesce(v, 0) AS filled, CASE WHEN v < 0 THEN 0 ELSE v END AS floored
FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS v FROM customer)""",
        "percentile_plan": f"""{monthly} SELECT CAST(t.cohort AS INT) AS cohort, score, CAST(p AS DOUBLE) AS pctl,
  is_ppv, high_tail, total AS total_n, greatest((total * p + 99) // 100, 1) AS target_rank
FROM totals t JOIN plan USING (score) WHERE group_ab = 'TODOS' AND group_xy = 'TODOS'""",
        "segment_cube": f"""{mon} SELECT safra, CASE WHEN grouping(group_ab) = 1 THEN 'TODOS' ELSE group_ab END AS group_ab,
  CASE WHEN grouping(group_xy) = 1 THEN 'TODOS' ELSE group_xy END AS group_xy,
  CAST(grouping(group_ab) * 2 + grouping(group_xy) AS INT) AS gid, count(*) AS n,
  count(*) FILTER (flag_1 = 1) AS hits, max(score_1) AS max_score
FROM mon GROUP BY GROUPING SETS ((safra), (safra, group_ab), (safra, group_xy), (safra, group_ab, group_xy))""",
        "score_histogram": f"""{monthly} SELECT cohort, score,
  CAST((CASE WHEN group_ab = 'TODOS' THEN 2 ELSE 0 END) + (CASE WHEN group_xy = 'TODOS' THEN 1 ELSE 0 END) AS INT) AS gid,
  {_SEGS}, value, count(*) AS n, count(*) FILTER (flag = 1) AS pos, count(*) FILTER (flag = 0) AS neg
FROM cubed GROUP BY ALL""",
        "cutoffs_exact": f"{monthly} {cutoffs}",
        "cutoffs_approx": f"{monthly} {cutoffs}",
        "cutoffs_wide": f"{monthly} SELECT score, cohort, {_SEGS}, "
        + ", ".join(f"max(cutoff) FILTER (p = {p}) AS pctl_{p}" for p in DIST)
        + " FROM cut GROUP BY ALL",
        "cutoffs_long": f"{monthly} {cutoffs} WHERE p IN ({', '.join(map(str, DIST))})",
        "cutoffs_continuous": f"""{_price_cte()} SELECT score, cohort, {price_segs}, CAST(p AS DOUBLE) AS pctl,
  cutoff, tail_n, round(tail_n / total * 100, 9) AS tail_pct FROM own""",
        "tail_counts_ge": f"{monthly} {tail_columns} WHERE score = 'score_1'",
        "tail_counts_le": f"{monthly} {tail_columns} WHERE score = 'score_2'",
        "prod_vs_baseline": f"""{split} SELECT {_PROD_COLUMNS}, base_cutoff, base_tail_n,
  round(base_tail_n / total * 100, 9) AS base_tail_pct FROM prod""",
        "psi_cumulative": f"{split} {_PSI_SELECT}",
        "psi_binned": f"""{split}, tails AS (
  SELECT prod.score, prod.cohort, group_ab, group_xy, prod.base_tail_n / prod.total * 100 / 100 AS pt,
    base.tail_n / base.total * 100 / 100 AS qt FROM prod JOIN base USING (score, {_SEGS}, p)
  UNION ALL SELECT DISTINCT prod.score, prod.cohort, group_ab, group_xy, 1, 1 FROM prod JOIN base USING (score, {_SEGS}, p)),
bins AS (SELECT score, cohort, {_SEGS}, pt - lag(pt, 1, 0) OVER w + 1e-6 AS pp, qt - lag(qt, 1, 0) OVER w + 1e-6 AS qq
  FROM tails WINDOW w AS (PARTITION BY score, cohort, {_SEGS} ORDER BY qt, pt))
SELECT score, cohort, {_SEGS}, round(sum((pp - qq) * ln(pp / qq)), 6) AS psi FROM bins GROUP BY ALL""",
        "run_counts": f"""{mon} SELECT 'score_1' AS score, count(*) AS rows, count(*) FILTER (score_1 <> -1) AS valid,
  count(*) FILTER (score_1 = -1) AS special, CAST(0 AS BIGINT) AS invalid, CAST(0 AS BIGINT) AS missing FROM mon
UNION ALL SELECT 'score_2', count(*), count(*) FILTER (score_2 BETWEEN 0 AND 1000), 0,
  count(*) FILTER (score_2 NOT BETWEEN 0 AND 1000), 0 FROM mon""",
        "ks_curve": f"""{monthly}, {ks_pieces} SELECT cohort, score, {_SEGS}, value, cum_pos, cum_neg,
  round(cum_pos / nullif(tot_pos, 0), 9) AS pos_rate, round(cum_neg / nullif(tot_neg, 0), 9) AS neg_rate FROM curve""",
        "ks_segment": f"{monthly}, {ks_pieces} {_ks_select(_SEGS)}",
        "ks_global_totals": f"""{monthly}, {ks_pieces}
SELECT * EXCLUDE (raw), round(raw, 9) AS ks FROM ({whole_ks})""",
        "ks_continuous": f"{_price_cte()}, {_curve_sql(price_segs)} {_ks_select(price_segs)}",
        "fraud_totals": f"{monthly} SELECT cohort, score, {_SEGS}, hits AS total_hits FROM totals",
        "fraud_capture": capture,
        "fraud_capture_stored": capture,
        "fraud_precision": f"""{split} SELECT {_SEGS}, CAST(p AS DOUBLE) AS pctl, base_tail_n, tail_n,
  round(base_pos / nullif(base_tail_n, 0) * 100, 9) AS base_precision_pct,
  round(tail_pos / nullif(tail_n, 0) * 100, 9) AS prod_precision_pct, cohort, score
FROM prod WHERE is_ppv AND base_cutoff IS NOT NULL""",
        "monitor_run": run,
        "monitor_stored": run,
        "monitor_state": run,
        "monitor_csv": run.replace(_ks_select(_SEGS, 6), f"SELECT *, round(raw, 6) AS ks FROM ({whole_ks})"),
        "crash_rerun": run,
        "monitor_continuous": run.replace(split, _price_cte(_SPLIT) + _BOTH_SQL)
        .replace("group_ab", "o_orderstatus")
        .replace("group_xy", "o_orderpriority"),
    } | (llm_queries.oracle_sql() if llm_queries else {})
