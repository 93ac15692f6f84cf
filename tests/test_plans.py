"""The physical plans have the shape that carries to large data."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import profile as profile_ops
from tidemark.operators.histogram import GROUP, base_histogram, cubed_histogram, leveled_histogram, present_groups, score_rows
from tidemark.operators.percentiles import cutoff_points, milestones
from tidemark.operators.profile import score_histogram, score_profile
from tidemark.plans.config import MonitorConfig, ScoreSpec
from tidemark.plans.jobs import baseline_tails, ks_table, monitor, run_and_store
from tidemark.sources.cohort_tables import cohort_rows
from tidemark.sources.results import ResultStore
from tidemark.sources.scratch import scratch_path, shared_folder

CONFIG = MonitorConfig(
    (ScoreSpec("score_1", (5,), (10, 50)),), ("group_ab",), 202304, 202305, baseline_cohorts=(202301,)
)


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "scored")
    spark.range(300).select(
        F.expr("element_at(array(202301, 202304, 202305, 202312), CAST(id % 4 AS INT) + 1)").alias("safra"),
        F.expr("IF(id % 2 = 0, 'A', 'B')").alias("group_ab"),
        F.expr("CAST(id % 97 AS INT)").alias("score_1"),
        F.lit("score válido").alias("score_1_status"),
        F.expr("CAST(id % 5 = 0 AS INT)").alias("flag_1"),
        F.lit("never read").alias("other"),
    ).write.partitionBy("safra").parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_needed_columns_and_months(rows):
    text = plan(base_histogram(score_rows(cohort_rows(rows, CONFIG, [202304]), CONFIG), CONFIG))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(safra" in scan and "202304" in scan
    assert "EqualTo(score_1_status,score válido)" in scan
    assert "other" not in re.search(r"ReadSchema: \S+", scan).group()
    assert text.count("Exchange") == 1
    # Counts are combined before they are shuffled.
    assert text.index("partial_count") > text.index("Exchange")


def test_entries_are_combined_before_they_are_shuffled(rows):
    histogram = score_histogram(score_rows(rows, CONFIG), CONFIG)
    text = plan(cubed_histogram(leveled_histogram(histogram.base, CONFIG)))
    assert text.count("Exchange") == 1
    assert text.index("partial_sum") > text.index("Exchange")


def test_the_grand_total_gets_few_entries(spark):
    """1,001 values at 2,000 levels: a reducer holds no more than an entry per value and map task."""
    tasks, values, levels = 4, 1001, 2000
    base = spark.range(0, 200_000, 1, tasks).select(
        F.lit("202304").alias("cohort"), F.lit("s").alias("score"), (F.col("id") % levels).cast("string").alias("group_ab"),
        (F.col("id") * 7919 % values).cast("int").alias("value"), F.lit(1).cast("bigint").alias("n"),
        F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("neg"),
    )
    leveled = leveled_histogram(base, CONFIG).filter("level.gid = 1")  # the cohort's total
    combined = leveled.groupBy(F.spark_partition_id(), "value").count()
    assert leveled.count() == 200_000 and combined.count() <= tasks * values
    laid = cubed_histogram(leveled_histogram(base, CONFIG))
    assert laid.filter("level.gid = 1").count() == values


def test_entries_move_once(rows, monkeypatch):
    """The base entries are dealt once; cube, windows and running totals stay where they are."""
    histogram = score_histogram(score_rows(rows, CONFIG), CONFIG)
    for least, place in ((10**6, "cohort, score"), (10, "cohort, score, bucket")):
        monkeypatch.setattr(profile_ops, "LEAST_ENTRIES", least)
        profile = score_profile(histogram, CONFIG)
        text = re.sub(r"#\d+L?", "", plan(profile))
        above = text[: text.index("Generate")]  # from the result down to the expansion to levels
        assert "Window" in above and "HashAggregate" in above and "Exchange" not in above
        dealt = text[text.index("Generate") :]
        assert f"hashpartitioning({place}, " in dealt.split("Exchange ")[1]
        # What else moves are sums by finest cell and by group.
        others = [part.split(", 4)")[0] for part in dealt.split("Exchange hashpartitioning(")[2:]]
        assert others and all("value" not in keys for keys in others)
        assert plan(milestones(profile, CONFIG)).count("BroadcastExchange") >= 1


def test_points_are_placed_only_where_a_group_is(rows):
    """The baseline and 202305 have level A, 202304 has level B: it gets points at its total only."""
    histogram = score_histogram(score_rows(rows, CONFIG), CONFIG)
    tails = baseline_tails(histogram, CONFIG)
    groups = present_groups(histogram.of([202304, 202305]).base, CONFIG)
    assert groups.count() == 4
    points = cutoff_points(tails, groups, histogram.base.schema["value"].dataType)
    found = {(r["cohort"], r["group_ab"]) for r in points.select("cohort", "level.group_ab").collect()}
    assert found == {("202304", "TODOS"), ("202305", "TODOS"), ("202305", "A")}
    assert points.count() == 3 * len(found)


def test_nothing_is_left_in_scratch(spark, rows, tmp_path):
    folder = shared_folder(spark)
    before = set(glob.glob(f"{folder}/tidemark-*"))
    assert run_and_store(rows, CONFIG, ResultStore(spark, str(tmp_path))) == [202304, 202305]
    assert set(glob.glob(f"{folder}/tidemark-*")) == before
    assert scratch_path(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_no_python_and_no_cross_join(rows):
    reports = monitor(rows, CONFIG)
    everything = "".join(plan(t) for t in reports.tables().values())
    everything += plan(ks_table(rows, CONFIG, totals="cohort"))
    for forbidden in ("Python", "Cartesian", "NestedLoop", "Pandas"):
        assert forbidden not in everything
