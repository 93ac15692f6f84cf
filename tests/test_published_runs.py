"""Runs are published as a whole, and the stored histogram serves other questions and late rows."""

import glob
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.plans.config import MonitorConfig, ScoreSpec, SpecialValue
from tidemark.plans.jobs import monitor, run_and_store
from tidemark.sources.histogram_state import HistogramState, fingerprint
from tidemark.sources.results import ResultStore, StagedRun, write_folders

CONFIG = MonitorConfig(
    (ScoreSpec("score_1", (5,), (10, 50)),), ("group_ab",), 202304, 202305, baseline_cohorts=(202301,)
)
RESULTS = ("percentiles", "percentiles_baseline", "psi", "ks", "capture", "precision")
KS = "cohort string, score string, ks double"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(240).select(
        F.expr("element_at(array(202301, 202304, 202305), CAST(id % 3 AS INT) + 1)").alias("safra"),
        F.expr("IF(id % 2 = 0, 'A', 'B')").alias("group_ab"),
        F.expr("CAST(id * 31 % 97 AS INT)").alias("score_1"),
        F.lit("score válido").alias("score_1_status"),
        F.expr("CAST(id % 5 = 0 AS INT)").alias("flag_1"),
    ).cache()


def tables(store):
    return {n: sorted(map(str, store.read(n).collect())) for n in RESULTS}


@pytest.fixture(scope="module")
def unbroken(spark, rows, tmp_path_factory):
    store = ResultStore(spark, str(tmp_path_factory.mktemp("unbroken")))
    assert run_and_store(rows, CONFIG, store) == [202304, 202305]
    return tables(store)


class Killed(Exception):
    pass


@pytest.mark.parametrize("writes", [0, 1, 4, 6])
def test_a_run_killed_after_any_write_changes_nothing(spark, rows, unbroken, tmp_path, monkeypatch, writes):
    store, write, left = ResultStore(spark, str(tmp_path)), StagedRun.write, iter(range(writes))

    def some(self, *table):
        if next(left, None) is None:
            raise Killed
        return write(self, *table)

    def no_commit(self):
        raise Killed

    monkeypatch.setattr(StagedRun, "write", some)
    monkeypatch.setattr(StagedRun, "commit", no_commit)
    with pytest.raises(Killed):
        run_and_store(rows, CONFIG, store)
    monkeypatch.undo()
    assert not any(store.exists(n) for n in RESULTS) and store.cohorts("ks").count() == 0
    assert run_and_store(rows, CONFIG, store) == [202304, 202305]
    assert tables(store) == unbroken
    assert len(store.clean()) == writes and store.clean() == []
    assert tables(store) == unbroken


def test_half_written_folders_and_manifests_are_not_results(spark, rows, unbroken, tmp_path):
    """What a write cut short leaves: an empty folder, a folder without its marker, a draft of a manifest."""
    os.makedirs(tmp_path / "percentiles_baseline" / "_temporary" / "0")
    os.makedirs(tmp_path / "ks" / "run=rdead" / "cohort=202304")
    (tmp_path / "ks" / "run=rdead" / "cohort=202304" / "part-0.parquet").write_bytes(b"PAR1")
    os.makedirs(tmp_path / "_manifests")
    (tmp_path / "_manifests" / ".rdead.json").write_text('{"ks": {"2023')
    store = ResultStore(spark, str(tmp_path))
    assert run_and_store(rows, CONFIG, store) == [202304, 202305]
    assert tables(store) == unbroken
    assert run_and_store(rows, CONFIG, store) == []


def test_an_empty_baseline_stops_the_run(spark, rows, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    with pytest.raises(ValueError, match="baseline has no valid score"):
        run_and_store(rows.filter("safra > 202301"), CONFIG, store)
    assert not store.exists("ks")


def test_two_runs_at_a_time_are_both_published(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    one, two = store.run(), store.run()
    one.write("ks", spark.createDataFrame([("202301", "s", 0.1), ("202302", "s", 0.2)], KS))
    two.write("ks", spark.createDataFrame([("202302", "s", 0.9)], KS))
    assert not store.exists("ks")
    assert (one.commit(), two.commit()) == (1, 2)
    assert {(r["cohort"], r["ks"]) for r in store.read("ks").collect()} == {("202301", 0.1), ("202302", 0.9)}
    assert [r["ks"] for r in store.read("ks", cohorts=[202301]).collect()] == [0.1]
    assert store.read("ks", cohorts=[202309]).count() == 0


def test_a_number_that_is_taken_is_not_overwritten(spark, tmp_path, monkeypatch):
    """Another run publishes between looking at the latest manifest and publishing."""
    store = ResultStore(spark, str(tmp_path))
    one, latest = store.run(), ResultStore._latest
    one.write("ks", spark.createDataFrame([("202301", "s", 0.1)], KS))
    calls = []

    def late(self):
        found = latest(self)
        if not calls:
            calls.append(1)
            self.write("ks", spark.createDataFrame([("202302", "s", 0.2)], KS))
        return found

    monkeypatch.setattr(ResultStore, "_latest", late)
    one.commit()
    assert {r["cohort"] for r in store.read("ks").collect()} == {"202301", "202302"}


def test_readers_keep_their_tables_while_a_run_replaces_them(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    store.write("ks", spark.createDataFrame([("202301", "s", 0.1)], KS))
    before = store.read("ks")
    store.write("ks", before.withColumn("ks", F.col("ks") + 1))  # reads what it replaces
    assert [r["ks"] for r in before.collect()] == [0.1] and [r["ks"] for r in store.read("ks").collect()] == [1.1]
    entry = json.loads(open(sorted(glob.glob(f"{tmp_path}/_manifests/*.json"))[-1]).read())["ks"]["202301"]
    assert all(os.path.exists(f"{tmp_path}/ks/{f}") for f in entry["files"])


# --- the stored histogram --------------------------------------------------------------------------


def reports(found):
    return {n: sorted(map(str, t.collect())) for n, t in found.tables().items()}


@pytest.fixture(scope="module")
def state_folder(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("state"))
    state = HistogramState(ResultStore(spark, folder), CONFIG)
    assert state.refresh(rows.filter("score_1 % 4 > 0"), [202301, 202304, 202305, 202309]) == ["202301", "202304", "202305"]
    assert state.add(rows.filter("score_1 % 4 = 0 AND safra < 202305"), "late 1") == ["202301", "202304"]
    assert state.add(rows.filter("score_1 % 4 = 0 AND safra = 202305"), "late 2") == ["202305"]
    return folder


def test_late_rows_are_added_once(spark, rows, state_folder):
    state = HistogramState(ResultStore(spark, state_folder), CONFIG)
    assert state.add(rows.filter("score_1 % 4 = 0"), "late 1") == ["202305"]  # the others have this batch
    state.invalidate([202305])
    assert state.cohorts() == {"202301", "202304"}
    assert state.refresh(rows, [202301, 202304, 202305]) == ["202305"]
    assert reports(monitor(None, CONFIG, state=state)) == reports(monitor(rows, CONFIG))
    assert state.add(rows.filter("safra = 202309"), "none") == []


def test_other_percentiles_and_directions_need_no_rows(spark, rows, state_folder):
    spec = ScoreSpec("score_1", (1, 30), (25, 99.5), high_tail=False)
    other = replace(CONFIG, scores=(spec,), baseline_cohorts=(202304,), first_cohort=202305)
    state = HistogramState(ResultStore(spark, state_folder), other)
    assert reports(monitor(None, other, state=state)) == reports(monitor(rows, other))


def test_months_in_the_state_are_not_scanned_again(spark, rows, state_folder):
    """A source that fails on any row of a month that is stored."""
    state = HistogramState(ResultStore(spark, state_folder), CONFIG)
    broken = rows.withColumn("score_1", F.raise_error("scanned").cast("int"))
    assert reports(monitor(broken, CONFIG, state=state)) == reports(monitor(None, CONFIG, state=state))
    plan = monitor(None, CONFIG, state=state).ks._jdf.queryExecution().executedPlan().toString()
    assert "InMemory" not in plan and "LocalTable" not in plan


def test_run_and_store_with_state(spark, rows, unbroken, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    state = HistogramState(store, CONFIG)
    assert run_and_store(rows, CONFIG, store, state=state) == [202304, 202305]
    assert tables(store) == unbroken


def test_fingerprint_tells_what_counts_depend_on(spark, rows, state_folder):
    assert fingerprint(CONFIG) == fingerprint(replace(CONFIG, scores=(ScoreSpec("score_1", (9,), (), False),), first_cohort=202201))
    others = [
        replace(CONFIG, response_column="flag_2"),
        replace(CONFIG, segments=()),
        replace(CONFIG, derive_status=True),
        replace(CONFIG, derive_status=True, scores=(ScoreSpec("score_1", special_values=(SpecialValue(-1, "x"),)),)),
    ]
    assert len({fingerprint(c) for c in [CONFIG, *others]}) == 5
    with pytest.raises(ValueError, match="another configuration"):
        monitor(None, others[1], state=HistogramState(ResultStore(spark, state_folder), CONFIG))


def test_late_scores_must_fit(spark, rows, state_folder):
    state = HistogramState(ResultStore(spark, state_folder), CONFIG)
    with pytest.raises(ValueError, match="do not fit"):
        state.add(rows.withColumn("score_1", F.col("score_1") + 0.5), "halves")


def test_an_empty_state_without_rows(spark, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        monitor(None, CONFIG, state=HistogramState(ResultStore(spark, str(tmp_path)), CONFIG))


# --- folders from one job --------------------------------------------------------------------------


def test_any_number_of_folders_is_one_job(spark, tmp_path):
    def jobs(months):
        group = f"folders {months}"
        spark.sparkContext.setJobGroup(group, group)
        table = spark.range(months * 3).select((F.col("id") % months).alias("month"), F.lit(None).cast("string").alias("none"))
        write_folders(table, "month", {str(m): f"{tmp_path}/{months}/t_{m}.csv" for m in range(months + 1)})
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(2) == jobs(30)
    assert not glob.glob(f"{tmp_path}/30/.staging*")
    read = spark.read.option("header", True).csv(f"{tmp_path}/30/t_7.csv")
    assert read.columns == ["month", "none"] and read.count() == 3
    empty = spark.read.option("header", True).csv(f"{tmp_path}/30/t_30.csv")
    assert empty.columns == ["month", "none"] and empty.count() == 0
    assert all(os.path.exists(f"{tmp_path}/30/t_{m}.csv/_SUCCESS") for m in range(31))
