import math
import random

import pytest
from brute_force import assert_same, report, table
from pyspark.sql import functions as F

from tidemark.operators import percentiles as pctl
from tidemark.operators.counters import RunCounts
from tidemark.operators.ks import ks
from tidemark.operators.psi import binned_psi
from tidemark.operators import profile as profile_ops
from tidemark.operators.profile import score_histogram, score_profile
from tidemark.operators.histogram import score_rows
from tidemark.plans.config import MonitorConfig, ScoreSpec
from tidemark.plans.jobs import monitor

SEGMENTS = ("group_ab", "group_xy")


def schema(score_type):
    scores = ", ".join(f"{s} {score_type}, {s}_status string" for s in ("score_1", "score_2"))
    return f"safra int, group_ab string, group_xy string, {scores}, flag_1 int"


def make_rows(seed, n, draw):
    """Random rows with ties, nulls everywhere, an unbalanced month and levels on one side only."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        month = rng.choice([202301, 202302, 202304, 202304, 202304, 202306])
        level = rng.choice(["A", "B", None, "only_base" if month < 202304 else "only_prod"])
        status = lambda: rng.choice(["score válido"] * 8 + ["score especial", None])
        score = lambda: None if rng.random() < 0.03 else draw(rng)
        rows.append(
            dict(
                safra=month,
                group_ab=level,
                group_xy=rng.choice(["X", "Y", "Y", None]),
                score_1=score(),
                score_1_status=status(),
                score_2=score(),
                score_2_status=status(),
                flag_1=rng.choice([0, 0, 0, 1, None]),
            )
        )
    return rows


def config(**changes):
    values = dict(
        scores=(
            ScoreSpec("score_1", (5, 15, 25), (0, 10, 20, 50, 90, 100)),
            ScoreSpec("score_2", (2.5, 10), (0, 10, 33.3, 66.667, 100), high_tail=False),
        ),
        segments=SEGMENTS,
        first_cohort=202304,
        last_cohort=202306,
        baseline_cohorts=(202301, 202302),
    )
    return MonitorConfig(**(values | changes))


def check(rows, spark_rows, cfg):
    expected = report(rows, cfg)
    found = monitor(spark_rows, cfg)
    keys = ["score", "cohort", *cfg.segments]
    base, tail = ["cutoff", "tail_n", "tail_pct"], ["base_cutoff", "base_tail_n", "base_tail_pct"]
    hits = ["base_hits", "prod_hits", "total_hits", "base_capture_pct", "prod_capture_pct"]
    assert_same(table(found.percentiles_baseline, [*keys, "pctl"], base), expected["baseline"])
    assert_same(table(found.percentiles, [*keys, "pctl"], base + tail), expected["percentiles"])
    assert_same(table(found.psi, keys, ["psi"]), expected["psi"])
    assert_same(table(found.ks, keys, ["ks"]), expected["ks"])
    assert_same(table(found.capture, [*keys, "pctl"], hits), expected["capture"])
    precision = ["base_precision_pct", "prod_precision_pct"]
    assert_same(table(found.precision, [*keys, "pctl"], precision), expected["precision"])
    whole = monitor(spark_rows, cfg, ks_totals="cohort").ks
    assert_same(table(whole, keys, ["ks"]), expected["ks_cohort"])
    return found


@pytest.mark.parametrize(
    "score_type, draw",
    [
        ("int", lambda rng: rng.randint(0, 30)),
        ("bigint", lambda rng: rng.choice([-(10**12), 5, 10**12 + rng.randint(0, 9)])),
        ("double", lambda rng: rng.choice([0.0, rng.gauss(0, 1)])),
    ],
)
def test_all_reports(spark, score_type, draw):
    rows = make_rows(score_type, 400, draw)
    found = check(rows, spark.createDataFrame(rows, schema(score_type)), config())
    assert [r["cohort"] for r in found.missing.collect()] == [202305]


def test_one_segment_and_none(spark):
    rows = make_rows(3, 150, lambda rng: rng.randint(0, 9))
    frame = spark.createDataFrame(rows, schema("int"))
    check(rows, frame, config(segments=("group_xy",)))
    check(rows, frame, config(segments=()))


@pytest.mark.parametrize("score_type", ["int", "double"])
def test_more_stretches_change_nothing(spark, score_type, monkeypatch):
    """Running totals over many stretches of the axis are those over one."""
    cfg = config()
    odd = [7.0, math.inf, -math.inf, math.nan]
    draw = lambda rng: rng.randint(0, 500) if score_type == "int" else rng.choice([*odd, *(rng.gauss(0, 50) for _ in odd)])
    rows = spark.createDataFrame(make_rows(9, 600, draw), schema(score_type))
    histogram = score_histogram(score_rows(rows, cfg), cfg)
    counts = ["n", "pos", "neg", "cum_n", "cum_pos", "cum_neg", "total_n", "total_pos", "total_neg"]
    flat = ["cohort", "score", "level.*", "value", *counts]
    one = score_profile(histogram, cfg).select(*flat).cache()
    assert not profile_ops.buckets_of(histogram.base).stretches
    monkeypatch.setattr(profile_ops, "LEAST_ENTRIES", 5)
    buckets = profile_ops.buckets_of(histogram.base)
    assert buckets.placed(histogram.base).select("cohort", "score", "bucket").distinct().count() > len(buckets.stretches) + 5
    many = score_profile(histogram, cfg).select(*flat).cache()
    assert one.count() > 500
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


@pytest.mark.parametrize("score_type", ["int", "double"])
def test_all_reports_over_many_stretches(spark, score_type, monkeypatch):
    """Baseline cut-offs also fall into stretches in which a group has no entry."""
    monkeypatch.setattr(profile_ops, "LEAST_ENTRIES", 4)
    rows = make_rows(11, 400, lambda rng: rng.randint(0, 90) if score_type == "int" else rng.gauss(0, 50))
    check(rows, spark.createDataFrame(rows, schema(score_type)), config())


def test_a_value_holding_a_third_of_all_rows(spark):
    """The hot value is one histogram row."""
    cfg = config(scores=(ScoreSpec("score_1", (5,), (10, 50, 90)),))
    rows = [
        dict(safra=202304, group_ab="A", group_xy="X", score_1=0.5 if i % 3 == 0 else i / 900,
             score_1_status="score válido", score_2=None, score_2_status=None, flag_1=i % 2)
        for i in range(900)
    ]
    histogram = score_histogram(score_rows(spark.createDataFrame(rows, schema("double")), cfg), cfg)
    profile = score_profile(histogram, cfg)
    top = profile.filter((F.col("value") == 0.5) & (F.col("level.gid") == 3)).select("n", "total_n").collect()
    assert [tuple(r) for r in top] == [(300, 900)]
    assert ks(profile, SEGMENTS).count() == 4


def test_baseline_equal_to_production_has_no_psi(spark):
    rows = make_rows(5, 200, lambda rng: rng.randint(0, 20))
    twice = [r | {"safra": m} for r in rows for m in (202301, 202304)]
    cfg = config(baseline_cohorts=(202301,), last_cohort=202304)
    counts = RunCounts(cfg)
    reports = monitor(spark.createDataFrame(twice, schema("int")), cfg, counts=counts)
    assert {round(r["psi"], 12) for r in reports.psi.collect()} == {0.0}
    binned = binned_psi(reports.percentiles, reports.percentiles_baseline, SEGMENTS).collect()
    assert len(binned) == reports.psi.count() and {round(r["psi"], 12) for r in binned} == {0.0}
    for r in counts.table(spark).collect():
        own = [(x[r["score"]], x[f"{r['score']}_status"]) for x in twice]
        assert (r["rows"], r["missing"]) == (len(twice), sum(v is None for v, _ in own))
        assert r["valid"] == sum(v is not None and status == "score válido" for v, status in own)
        assert r["valid"] + r["special"] + r["invalid"] + r["missing"] == len(twice)


def test_a_cohort_in_both_baseline_and_production(spark):
    rows = make_rows(6, 300, lambda rng: rng.randint(0, 20))
    cfg = config(baseline_cohorts=(202301, 202304))
    check(rows, spark.createDataFrame(rows, schema("int")), cfg)


def test_results_do_not_depend_on_partitioning(spark):
    rows = spark.createDataFrame(make_rows(8, 300, lambda rng: rng.randint(0, 40)), schema("int"))
    first = monitor(rows.coalesce(1), config()).percentiles
    second = monitor(rows.repartition(7), config()).percentiles
    assert first.exceptAll(second).count() == 0 and second.exceptAll(first).count() == 0


def test_approximate_cutoffs_meet_exact_ones_at_high_accuracy(spark):
    cfg = config()
    rows = spark.createDataFrame(make_rows(4, 500, lambda rng: rng.randint(0, 300)), schema("int"))
    long_rows = score_rows(rows, cfg)
    exact = pctl.own_tails(pctl.milestones(score_profile(score_histogram(long_rows, cfg), cfg), cfg))
    exact = exact.select("score", "cohort", "level.group_ab", "level.group_xy", "pctl", "cutoff")
    near = pctl.approximate_cutoffs(long_rows, cfg, accuracy=1_000_000)
    key = ["score", "cohort", *SEGMENTS, "pctl"]
    a, b = table(exact, key, ["cutoff"]), table(near, key, ["cutoff"])
    assert a.keys() == b.keys()
    differing = [k for k in a if a[k] != b[k]]
    # Sketches rank with binary fractions, which may miss a rank where p * n / 100 is whole.
    assert len(differing) <= len(a) * 0.02


def test_approximate_cutoffs_keep_their_rank_error(spark):
    """At the default accuracy a cut-off's rank is off by 1 % of its group at most, also in merged levels."""
    spec = ScoreSpec("score_1", (1, 5), (10, 25, 50, 75, 90, 100))
    cfg = MonitorConfig((spec,), SEGMENTS, 202304, 202304)
    rows = spark.range(60_000).select(
        F.lit(202304).alias("safra"),
        F.expr("IF(id % 7 = 0, 'A', concat('B', id % 5))").alias("group_ab"),
        F.expr("IF(id % 3 = 0, NULL, 'X')").alias("group_xy"),
        F.expr("exp(10 * rand(3)) + id / 1e9").alias("score_1"),
        F.lit("score válido").alias("score_1_status"),
        F.lit(1).alias("flag_1"),
    )
    long_rows = score_rows(rows, cfg).cache()
    profile = score_profile(score_histogram(long_rows, cfg), cfg).select(
        "level.*", "value", "cum_n", "n", "total_n"
    ).toPandas()
    found = pctl.approximate_cutoffs(long_rows, cfg).toPandas()
    assert len(found) == len(profile.groupby(["gid", "group_ab", "group_xy"], dropna=False)) * 8
    worst = 0
    for group, own in profile.groupby(["group_ab", "group_xy"], dropna=False):
        ranks = own.set_index("value")
        same = found[(found.group_ab == group[0]) & ((found.group_xy == group[1]) | (found.group_xy.isna() & (group[1] != group[1])))]
        assert len(same) == 8
        for r in same.itertuples():
            worst = max(worst, abs(ranks.loc[r.cutoff, "cum_n"] / ranks["total_n"].iloc[0] - r.pctl / 100))
    assert 0 < worst <= 0.01


def test_sketches_are_fed_rows_once(spark):
    cfg = config()
    rows = spark.createDataFrame(make_rows(4, 50, lambda rng: rng.randint(0, 300)), schema("int"))
    text = pctl.approximate_cutoffs(score_rows(rows, cfg), cfg)._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("partial_kll_sketch_agg") : text.index("BroadcastExchange")]
    assert "Generate" not in below and below.count("Expand") == 1  # the expansion that makes scores rows
    assert text.count("partial_kll_merge_agg") == 1


def test_counts_of_a_run_without_any_valid_score(spark):
    """Nothing reaches the histogram, and the counts are there all the same."""
    cfg = config()
    rows = [r | {"score_1_status": "score inválido", "score_2_status": "óbito"} for r in make_rows(4, 60, lambda rng: rng.randint(0, 9))]
    for data in (rows, []):
        counts = RunCounts(cfg)
        reports = monitor(spark.createDataFrame(data, schema("int")), cfg, counts=counts)
        assert reports.ks.count() == 0
        found = {r["score"]: (r["rows"], r["valid"], r["special"], r["invalid"]) for r in counts.table(spark).collect()}
        own = [r for r in data if r["safra"] in {*cfg.production_cohorts, *cfg.baseline_cohorts}]
        present = [sum(r[s] is not None for r in own) for s in ("score_1", "score_2")]
        assert found == {"score_1": (len(own), 0, 0, present[0]), "score_2": (len(own), 0, present[1], 0)}


def test_a_tasks_entries_stay_few(spark, monkeypatch):
    """Stretches and tasks follow from the entries alone, and a task's entries are sorted, not gathered in a table."""
    rows = spark.createDataFrame(make_rows(5, 800, lambda rng: rng.random()), schema("double"))
    histogram = score_histogram(score_rows(rows, config()), config())
    monkeypatch.setattr(profile_ops, "LEAST_ENTRIES", 20)
    sizes = [r["count"] for r in histogram.base.groupBy("cohort", "score").count().collect()]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        buckets = profile_ops.buckets_of(histogram.base)
        profile = score_profile(histogram, config())
        placed = profile.select("cohort", "score").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert buckets.tasks == math.ceil(sum(sizes) / 20) > 4
    assert sorted(buckets.stretches.values()) == sorted(math.ceil(n / 20) for n in sizes if n > 20)
    assert placed > buckets.tasks / 3
    dealt = profile._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in dealt.split("REPARTITION_BY_NUM")[0]
