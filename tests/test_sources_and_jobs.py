import csv
import glob
import json
from dataclasses import replace

import pytest
from brute_force import report, table
from pyspark.sql import functions as F

from tidemark.plans.config import MonitorConfig, ScoreSpec
from tidemark.plans.jobs import monitor, monitor_files, run_and_store
from tidemark.sources import cohort_tables as src
from tidemark.sources.results import ResultStore, result_schema, save_table

SCORES = (ScoreSpec("score_1", (5, 25), (10, 50, 100)),)
SEGMENTS = ("group_ab", "group_xy")


def config(**changes):
    values = dict(scores=SCORES, segments=SEGMENTS, first_cohort=202304, last_cohort=202307, baseline_cohorts=(202301,))
    return MonitorConfig(**(values | changes))


@pytest.fixture(scope="module")
def rows(spark):
    """Four months with data; 202306 is a gap."""
    months = "element_at(array(202301, 202304, 202305, 202307), CAST(id % 4 AS INT) + 1)"
    return spark.range(400).select(
        F.expr(months).alias("safra"),
        F.expr("IF(id % 3 = 0, 'A', 'B')").alias("group_ab"),
        F.expr("IF(id % 5 = 0, NULL, 'X')").alias("group_xy"),
        F.expr("CAST(id * 37 % 101 AS INT)").alias("score_1"),
        F.expr("IF(id % 17 = 0, 'score especial', 'score válido')").alias("score_1_status"),
        F.expr("CAST(id % 7 = 0 AS INT)").alias("flag_1"),
    )


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).count() == 0 and b.select(*a.columns).exceptAll(a).count() == 0


def test_csv_source_reads_asked_months_once(spark, rows, tmp_path):
    cfg = config(data_folder=str(tmp_path))
    src.write_cohort_csv(rows, cfg, [202301, 202304, 202305, 202307])
    found = src.cohort_csv(spark, cfg, cfg.production_cohorts)
    expected = src.cohort_rows(rows, cfg, cfg.production_cohorts).withColumn("score_1", F.col("score_1").cast("double"))
    assert dict(found.dtypes) == dict(expected.dtypes)
    assert same(found, expected)
    typed = src.cohort_csv(spark, cfg, [202305], schema=rows.schema)
    assert same(typed.select(*expected.columns), src.cohort_rows(rows, cfg, [202305]))


def test_csv_months_may_differ(spark, tmp_path):
    """Columns in another order, fractional scores, flags as 1.0, a prefix of pattern signs, no month at all."""
    cfg = config(data_folder=str(tmp_path), data_prefix="t.[1]", last_cohort=202305)
    texts = {
        202304: "group_ab,score_1,flag_1,score_1_status,group_xy\nA,10,1,score válido,X\n",
        202305: "flag_1,group_xy,group_ab,score_1_status,score_1,more\n1.0,X,B,score válido,512.7,z\n,,B,score válido,3,z\n",
    }
    assert src.cohort_csv(spark, cfg, cfg.production_cohorts).count() == 0
    assert [r[0] for r in monitor(src.cohort_csv(spark, cfg, cfg.production_cohorts), cfg).missing.collect()] == [202304, 202305]
    assert src.baseline_csv(spark, cfg) is None
    for month, text in texts.items():
        (tmp_path / f"t.[1]_{month}.csv").write_text(text, encoding="utf-8")
    found = {tuple(r) for r in src.cohort_csv(spark, cfg, cfg.production_cohorts).select("safra", "group_ab", "group_xy", "score_1", "flag_1").collect()}
    assert found == {(202304, "A", "X", 10.0, 1), (202305, "B", "X", 512.7, 1), (202305, "B", None, 3.0, None)}


def test_one_table_for_each_cohort(spark, rows):
    for name, month in (("sc_202304", 202304), ("sc_202305", 202305), ("sc_baseline", 202301)):
        rows.filter(F.col("safra") == month).createOrReplaceTempView(name)
    read = src.cohort_tables(spark, "sc_{cohort}", config(), [202304, 202305, 202306])
    assert same(read, src.cohort_rows(rows, config(), [202304, 202305]))
    base = src.cohort_tables(spark, "sc_{cohort}", config(), ["baseline"])
    assert same(base, src.baseline_rows(rows, config()))


def test_cohorts_as_strings(spark, rows):
    named = rows.withColumn("safra", F.when(F.col("safra") == 202301, "baseline").otherwise(F.col("safra").cast("string")))
    assert src.cohort_rows(named, config(), [202304, 202305]).count() == 200
    assert {r[0] for r in src.cohort_rows(named, config(), ["baseline"]).select("safra").distinct().collect()} == {"baseline"}


def test_a_finished_month_inside_the_period_is_kept(spark, rows, tmp_path):
    """The stored month is the baseline's too, and lies between two pending ones."""
    store = ResultStore(spark, str(tmp_path))
    cfg = config(baseline_cohorts=(202305,))
    assert run_and_store(rows, replace(cfg, first_cohort=202305, last_cohort=202305), store) == [202305]
    kept = sorted(map(str, store.read("percentiles").collect()))
    changed = rows.withColumn("score_1", F.lit(1))
    assert run_and_store(changed, cfg, store) == [202304, 202306, 202307]
    assert sorted(map(str, store.read("percentiles").filter("cohort = '202305'").collect())) == kept


def test_catalog_source(spark, rows):
    rows.createOrReplaceTempView("scored")
    assert same(src.cohort_table(spark, "scored", config(), [202304]), src.cohort_rows(rows, config(), [202304]))
    assert {r[0] for r in src.baseline_rows(rows, config()).select("safra").distinct().collect()} == {"baseline"}


def test_store_replaces_only_the_cohorts_written(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    assert not store.exists("ks") and store.cohorts("ks").count() == 0
    store.write("ks", spark.createDataFrame([("202301", "s", 0.1), ("202302", "s", 0.2)], "cohort string, score string, ks double"))
    store.write("ks", spark.createDataFrame([("202302", "s", 0.9)], "cohort string, score string, ks double"))
    assert {(r["cohort"], r["ks"]) for r in store.read("ks").collect()} == {("202301", 0.1), ("202302", 0.9)}
    assert {r[0] for r in store.cohorts("ks").collect()} == {"202301", "202302"}


def test_csv_store_reads_with_schema(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path), "csv")
    store.write("ks", spark.createDataFrame([("202301", "s", None, 0.1)], "cohort string, score string, seg string, ks double"))
    schema = result_schema(["score", "seg", "ks", "cohort"], ["seg"])
    assert store.read("ks", schema).collect() == [("s", None, 0.1, "202301")]
    with pytest.raises(ValueError, match="needs a schema"):
        store.read("ks")


def test_catalog_result_table(spark):
    ddl = "cohort string, score string, psi double"
    spark.sql("DROP TABLE IF EXISTS psi_results")
    save_table(spark.createDataFrame([("202301", "s", 1.0), ("202302", "s", 2.0)], ddl), "psi_results")
    save_table(spark.createDataFrame([("202302", "s", 3.0)], ddl), "psi_results")
    assert {(r["cohort"], r["psi"]) for r in spark.table("psi_results").collect()} == {("202301", 1.0), ("202302", 3.0)}


def test_rerun_keeps_or_replaces(spark, rows, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    early = config(last_cohort=202304)
    assert run_and_store(rows, early, store) == [202304]
    first = store.read("percentiles").filter("cohort = '202304'").collect()
    # A changed input does not touch a finished cohort without overwrite...
    changed = rows.withColumn("score_1", F.when(F.col("safra") == 202304, 7).otherwise(F.col("score_1")))
    assert run_and_store(changed, config(), store) == [202305, 202306, 202307]
    assert sorted(map(str, store.read("percentiles").filter("cohort = '202304'").collect())) == sorted(map(str, first))
    # ...and replaces it with overwrite, leaving the others.
    assert run_and_store(changed, config(last_cohort=202304, overwrite=True), store) == [202304]
    again = store.read("percentiles")
    assert {r[0] for r in again.filter("cohort = '202304'").select("cutoff").distinct().collect()} == {7}
    assert {r[0] for r in again.select("cohort").distinct().collect()} == {"202304", "202305", "202307"}
    whole = monitor(rows.filter("safra > 202304 OR safra = 202301"), config(first_cohort=202305))
    assert same(whole.ks, store.read("ks").filter("cohort > '202304'"))
    assert same(whole.psi, store.read("psi").filter("cohort > '202304'"))


def test_stored_baseline_serves_later_cohorts(spark, rows):
    whole = monitor(rows, config())
    later = monitor(rows.filter("safra >= 202304"), config(baseline_cohorts=()), baseline_table=whole.percentiles_baseline)
    assert same(whole.percentiles, later.percentiles)
    assert same(whole.psi, later.psi)
    assert same(whole.capture, later.capture)


def test_file_based_run(spark, rows, tmp_path):
    data, results = tmp_path / "data", tmp_path / "results"
    cfg = config(data_folder=str(data), result_folder=str(results))
    src.write_cohort_csv(rows, cfg, [202304, 202305, 202307])
    base = rows.filter("safra = 202301")
    base.write.option("header", True).csv(str(data / "tbl_baseline.csv"))
    execution = {
        "periodo_monitoramento": {"data_inicio": 202304, "data_fim": 202307, "maturação": False, "periodo_maturacao": 12},
        "incluir_baseline": True,
        "overwrite_percentis": True,
    }
    monitoring = {
        "aberturas": list(SEGMENTS),
        "data_folder": str(data),
        "data_prefix": "tbl",
        "result_folder": str(results),
        "variavel_resposta": "flag_1",
        "scores": {"score_1": {"percentis_ppv": [5, 25], "percentis_dist": [10, 50, 100], "acumula_maiores": True,
                               "escores_especiais": [{"valor": -1, "significado": "óbito"}]}},
    }
    (tmp_path / "e.json").write_text(json.dumps(execution), encoding="utf-8")
    (tmp_path / "m.json").write_text(json.dumps(monitoring), encoding="utf-8")
    assert monitor_files(spark, str(tmp_path / "e.json"), str(tmp_path / "m.json")) == [202304, 202305, 202307]

    def read(name):
        lines = []
        for part in sorted(glob.glob(str(results / name / "part-*.csv"))):
            with open(part, encoding="utf-8") as f:
                lines += list(csv.DictReader(f))
        return lines

    assert {p.split("/")[-1] for p in glob.glob(str(results / "*"))} == {"percentis_baseline.csv"} | {
        f"{n}_{m}.csv" for n in ("percentis_prod", "psi", "ks", "pct_fraude") for m in (202304, 202305, 202307)
    }
    expected = report([r.asDict() for r in rows.collect()], cfg)
    found = {(r["group_ab"], r["group_xy"] or None, float(r["percentil"])): (float(r["score_percentil"]), int(r["count"]), int(r["count_baseline"]))
             for r in read("percentis_prod_202305.csv")}
    wanted = {(a, x, p): (v[0], v[1], v[4]) for (_, c, a, x, p), v in expected["percentiles"].items() if c == "202305"}
    assert found == wanted
    ks = {(r["group_ab"], r["group_xy"] or None): round(float(r["ks_value"]), 9) for r in read("ks_202304.csv")}
    assert ks == {(a, x): round(v[0], 9) for (_, c, a, x), v in expected["ks_cohort"].items() if c == "202304"}

    # A second run leaves finished months alone, also on changed input and without the baseline file.
    stored = read("psi_202305.csv")
    src.write_cohort_csv(rows.withColumn("score_1", F.col("score_1") + 400), cfg, [202305])
    execution |= {"overwrite_percentis": False}
    (data / "tbl_baseline.csv").rename(data / "other.csv")
    (tmp_path / "e.json").write_text(json.dumps(execution), encoding="utf-8")
    files = str(tmp_path / "e.json"), str(tmp_path / "m.json")
    assert monitor_files(spark, *files) == []
    assert read("psi_202305.csv") == stored

    # A new month is measured against the stored baseline percentiles; its status comes from the special scores.
    late = rows.filter("safra = 202304").drop("score_1_status").withColumn("safra", F.lit(202306))
    late.withColumn("score_1", F.when(F.col("score_1") > 90, -1).otherwise(F.col("score_1"))).write.option("header", True).csv(
        str(data / "tbl_202306.csv")
    )
    assert monitor_files(spark, *files) == [202306]
    assert read("psi_202305.csv") == stored and len(read("psi_202306.csv")) > 0
    assert min(float(r["score_percentil"]) for r in read("percentis_prod_202306.csv")) >= 0
