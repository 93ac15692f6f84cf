import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import scores as fn
from tidemark.operators import cohorts as coh
from tidemark.operators.histogram import base_histogram, score_rows
from tidemark.operators.ks import ks, ks_curve
from tidemark.operators.percentiles import milestones, own_tails, wide_cutoffs
from tidemark.operators.profile import score_histogram, score_profile
from tidemark.operators.segments import expand_levels, grouping_bits, segment_cube, segment_subsets
from tidemark.plans.config import MonitorConfig, ScoreSpec, SpecialValue, month_list
from tidemark.plans.percentile_plan import percentile_plan

SCHEMA = "safra int, group_ab string, score_1 int, score_1_status string, flag_1 int"


def rows(spark, data, schema=SCHEMA):
    return spark.createDataFrame([(202304, g, s, "score válido", f) for g, s, f in data], schema)


def config(spec=ScoreSpec("score_1", (), (0, 50, 100)), segments=("group_ab",), **more):
    return MonitorConfig((spec,), segments, 202304, 202304, **more)


def profile(df, cfg):
    return score_profile(score_histogram(score_rows(df, cfg), cfg), cfg)


def test_ties_share_one_step(spark):
    cfg = config(segments=())
    p = profile(rows(spark, [("A", 5, 1), ("A", 5, 0), ("A", 3, 0)]), cfg)
    curve = {r["value"]: (r["cum_pos"], r["cum_neg"]) for r in ks_curve(p, ()).collect()}
    assert curve == {5: (1, 1), 3: (1, 2)}
    tails = {r["pctl"]: (r["cutoff"], r["tail_n"]) for r in own_tails(milestones(p, cfg)).collect()}
    assert tails == {0.0: (3, 3), 50.0: (5, 2), 100.0: (5, 2)}


def test_null_score_and_null_response(spark):
    cfg = config(segments=())
    base = base_histogram(score_rows(rows(spark, [("A", None, 1), ("A", 4, None), ("A", 4, 1)]), cfg), cfg)
    assert [(r["value"], r["n"], r["pos"], r["neg"]) for r in base.collect()] == [(4, 2, 1, 0)]


def test_null_segment_is_a_level_of_its_own(spark):
    cfg = config()
    tails = own_tails(milestones(profile(rows(spark, [(None, 1, 0), (None, 3, 0), ("A", 9, 0)]), cfg), cfg))
    top = {tuple(r["level"]): (r["cutoff"], r["tail_n"]) for r in tails.filter("pctl = 50").collect()}
    assert top == {(0, None): (1, 2), (0, "A"): (9, 1), (1, "TODOS"): (3, 2)}


def test_level_spelled_like_the_total_is_rejected(spark):
    data = rows(spark, [("TODOS", 1, 0), ("A", 2, 1)])
    with pytest.raises(PySparkException, match="equal to the total label"):
        ks(profile(data, config()), ("group_ab",)).collect()
    with pytest.raises(PySparkException, match="equal to the total label"):
        segment_cube(data, ["safra"], ["group_ab"], [F.count("*").alias("n")]).collect()
    other = config(total_label="ALL")
    assert ks(profile(data, other), ("group_ab",)).count() == 3


def test_numeric_segment_becomes_text(spark):
    schema = SCHEMA.replace("group_ab string", "group_ab int")
    found = ks(profile(rows(spark, [(1, 5, 0), (2, 6, 1)], schema), config()), ("group_ab",))
    assert {r["group_ab"] for r in found.collect()} == {"1", "2", "TODOS"}


def test_no_positives_gives_null_not_an_error(spark):
    found = ks(profile(rows(spark, [("A", 5, 0), ("A", 6, 0)]), config()), ("group_ab",)).collect()
    assert {r["ks"] for r in found} == {None}


def test_low_tail_keeps_ppv_percentiles(spark):
    specs = (ScoreSpec("hi", (5,), (10,)), ScoreSpec("lo", (5,), (5, 10), high_tail=False))
    plan = {(r["score"], r["pctl"], r["is_ppv"], r["high_tail"]) for r in percentile_plan(spark, specs).collect()}
    assert plan == {
        ("hi", 10.0, False, True),
        ("hi", 95.0, True, True),
        ("lo", 5.0, True, False),
        ("lo", 10.0, False, False),
    }


def test_score_without_percentiles_still_has_ks(spark):
    cfg = config(ScoreSpec("score_1"))
    p = profile(rows(spark, [("A", 5, 0), ("A", 6, 1)]), cfg)
    assert own_tails(milestones(p, cfg)).count() == 0
    assert {r["ks"] for r in ks(p, ("group_ab",)).collect()} == {1.0}


def test_score_status(spark):
    spec = ScoreSpec("s", special_values=(SpecialValue(-1, "óbito"), SpecialValue(-2, "no hit")), valid_range=(0, 1000))
    data = spark.createDataFrame([(v,) for v in (-1, -2, -3, 0, 1000, 1001, None)], "s int")
    found = [r[0] for r in data.select(fn.score_status(spec)).collect()]
    inv, ok = "score inválido", "score válido"
    assert found == ["óbito", "no hit", inv, ok, ok, inv, None]


def test_derived_status_selects_rows(spark):
    spec = ScoreSpec("score_1", (), (100,), special_values=(SpecialValue(-1, "especial"),), valid_range=(0, 10))
    cfg = config(spec, derive_status=True)
    data = rows(spark, [("A", -1, 0), ("A", 11, 0), ("A", 10, 1), ("A", None, 1)]).drop("score_1_status")
    assert [r["value"] for r in score_rows(data, cfg).collect()] == [10]


def test_band_clip_fill_percent(spark):
    data = spark.createDataFrame([("<1k", 5.0), ("30k+", -1.0), ("?", 2000.0), (None, None)], "b string, v double")
    found = data.select(
        fn.band_midpoint(F.col("b")), fn.clip(F.col("v"), 0.0, 1000.0), fn.fill_null(F.col("v")),
        fn.percent(F.col("v"), F.lit(0)),
    ).collect()
    assert [tuple(r) for r in found] == [
        (0.5, 5.0, 5.0, None), (35.0, 0.0, -1.0, None), (None, 1000.0, 2000.0, None), (None, None, 0.0, None),
    ]


def test_month_spine(spark):
    periods = spark.createDataFrame([(202311, 202402), (202405, 202404), (202506, 202506)], "first_cohort int, last_cohort int")
    found = sorted(r[0] for r in coh.month_spine(periods).collect())
    assert found == [202311, 202312, 202401, 202402, 202506]
    assert month_list(202311, 202402) == (202311, 202312, 202401, 202402)
    assert month_list(202405, 202404) == ()


def test_missing_and_pending(spark):
    asked = coh.cohort_list(spark, [202301, 202302, 202303])
    have = spark.createDataFrame([(202301,), (202301,), (202303,)], "cohort int")
    assert [r[0] for r in coh.missing_cohorts(asked, have).collect()] == [202302]
    assert [r[0] for r in coh.pending_cohorts(asked, have).collect()] == [202302]
    assert sorted(r[0] for r in coh.pending_cohorts(asked, have, overwrite=True).collect()) == [202301, 202302, 202303]


def test_grouping_sets_and_expansion_agree(spark):
    data = spark.createDataFrame([("A", "X", 1), ("A", None, 2), (None, None, 4), ("B", "X", 8)], "a string, b string, v int")
    segments = ["a", "b"]
    cubed = segment_cube(data, [], segments, [F.sum("v").alias("v")])
    by_hand = expand_levels(data, segments).groupBy("level").agg(F.sum("v").alias("v"))
    one = {(r["gid"], r["a"], r["b"], r["v"]) for r in cubed.collect()}
    two = {(*r["level"], r["v"]) for r in by_hand.collect()}
    assert one == two and (3, "TODOS", "TODOS", 15) in one and (1, None, "TODOS", 4) in one
    assert [grouping_bits(segments, s) for s in segment_subsets(segments)] == [3, 1, 2, 0]


def test_fractional_percentile_columns(spark):
    cfg = config(ScoreSpec("score_1", (), (2.5, 50)), segments=())
    tails = own_tails(milestones(profile(rows(spark, [("A", v, 0) for v in range(1, 101)]), cfg), cfg))
    wide = wide_cutoffs(tails.select("score", "cohort", "pctl", "cutoff"), [], [2.5, 50])
    assert wide.select("pctl_2_5", "pctl_50").collect() == [(3, 50)]


def test_config_is_checked():
    with pytest.raises(ValueError, match="outside 0..100"):
        ScoreSpec("s", (), (101,))
    with pytest.raises(ValueError, match="three decimals"):
        ScoreSpec("s", (), (0.12345,))
    with pytest.raises(ValueError, match="collide"):
        MonitorConfig((ScoreSpec("s"),), ("cutoff",))
    with pytest.raises(ValueError, match="at least one score"):
        MonitorConfig(())
