"""Result tables by cohort, so that cohorts can be replaced or added on their own, and published by whole runs."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import is_one_of
from tidemark.plans.config import BASELINE_COHORT
from tidemark.sources.files import SharedFiles
from tidemark.sources.scratch import scratch_path

# The CSV layout existing consumers read. Per result, the directory prefix and the
# column names of each of our columns.
CSV_NAMES = {
    "percentiles": "percentis_prod",
    "psi": "psi",
    "ks": "ks",
    "capture": "pct_fraude",
}
CSV_COLUMNS = {
    "score": "score",
    "cohort": "safra",
    "pctl": "percentil",
    "cutoff": "score_percentil",
    "tail_n": "count",
    "tail_pct": "percent",
    "base_cutoff": "score_baseline",
    "base_tail_n": "count_baseline",
    "base_tail_pct": "percent_baseline",
    "psi": "psi_value",
    "ks": "ks_value",
    "base_hits": "total_fraudes_baseline",
    "prod_hits": "total_fraudes_producao",
    "total_hits": "total_fraudes_safra",
    "base_capture_pct": "percentual_fraudes_total_baseline",
    "prod_capture_pct": "percentual_fraudes_total_producao",
}

_TYPES = {"score": "string", "cohort": "string", "tail_n": "bigint", "base_tail_n": "bigint"} | {
    name: "bigint" for name in ("base_hits", "prod_hits", "total_hits")
}


def result_schema(columns: Iterable[str], segments: Iterable[str]) -> T.StructType:
    """Explicit schema of a result table: counts are whole numbers, everything measured is a double."""
    segments = set(segments)
    fields = [f"`{c}` {'string' if c in segments else _TYPES.get(c, 'double')}" for c in columns]
    return T.StructType.fromDDL(", ".join(fields))


class ResultStore:
    """Result tables below one folder, published a run at a time.

    A run writes ``<folder>/<result>/run=<id>/cohort=<YYYYMM>/``, which nobody reads yet, and at the end one manifest,
    ``<folder>/_manifests/<number>.json``: for every result and cohort the run and the files that hold it. Reading,
    ``exists`` and ``cohorts`` go by the latest manifest, so a run that is cut short at any write has changed nothing,
    and readers see all tables of a run or none. Manifests have a line per result and cohort.
    """

    def __init__(self, spark: SparkSession, folder: str, fmt: str = "parquet") -> None:
        self.spark, self.folder, self.fmt = spark, folder.rstrip("/"), fmt
        self._files = SharedFiles(spark)

    def path(self, result: str) -> str:
        return f"{self.folder}/{result}"

    def run(self) -> StagedRun:
        """A run of its own: stage tables with ``write``, then ``commit`` them together."""
        return StagedRun(self)

    def write(self, result: str, table: DataFrame) -> None:
        """Publish one table on its own; it replaces the cohorts it holds."""
        run = self.run()
        run.write(result, table)
        run.commit()

    def drop(self, result: str, cohorts: Iterable[object]) -> None:
        """Publish that the cohorts of a result are no longer there."""
        run = self.run()
        run.forget(result, cohorts)
        run.commit()

    def entries(self, result: str) -> dict[str, dict]:
        """The published cohorts of a result: run, files and notes of each."""
        return self._latest()[1].get(result, {})

    def read(self, result: str, schema: T.StructType | None = None, cohorts: Iterable[object] | None = None) -> DataFrame:
        """A published table, or some of its cohorts; only their files are opened."""
        if schema is None and self.fmt != "parquet":
            raise ValueError(f"reading {self.fmt} results needs a schema")
        entries = self.entries(result)
        if not entries:
            raise ValueError(f"no result {result} is stored in {self.folder}")
        wanted = entries if cohorts is None else {str(c) for c in cohorts}
        paths = [f"{self.path(result)}/{f}" for c, e in entries.items() if c in wanted for f in e["files"]]
        if not paths:
            return self.read(result, schema).limit(0)
        reader = self.spark.read.format(self.fmt).option("header", True).option("basePath", self.path(result))
        stored = (reader if schema is None else reader.schema(schema)).load(paths).drop("run")
        return stored.withColumn("cohort", F.col("cohort").cast("string"))

    def exists(self, result: str) -> bool:
        return bool(self.entries(result))

    def cohorts(self, result: str) -> DataFrame:
        """Cohorts already published."""
        return self.spark.createDataFrame([(c,) for c in sorted(self.entries(result))], "cohort string")

    def clean(self) -> list[str]:
        """Remove what runs left behind that no manifest names; only while no other run is writing."""
        _, manifest = self._latest()
        named = {(result, e["run"]) for result, cohorts in manifest.items() for e in cohorts.values()}
        removed = []
        for result in self._files.names(self.folder):
            for run in self._files.names(self.path(result)) if not result.startswith("_") else ():
                if run.startswith("run=") and (result, run.removeprefix("run=")) not in named:
                    self._files.delete(f"{self.path(result)}/{run}")
                    removed.append(f"{result}/{run}")
        return sorted(removed)

    def _latest(self) -> tuple[int, dict[str, dict[str, dict]]]:
        numbers = [n for n in self._files.names(f"{self.folder}/_manifests") if n.endswith(".json") and not n.startswith(".")]
        if not numbers:
            return 0, {}
        last = max(numbers)
        return int(last.removesuffix(".json")), json.loads(self._files.text(f"{self.folder}/_manifests/{last}"))


class StagedRun:
    """Tables of one run, on their way into a ``ResultStore``."""

    def __init__(self, store: ResultStore) -> None:
        self.store, self.id = store, f"r{uuid.uuid4().hex}"
        self._staged: dict[str, dict[str, dict | None]] = {}

    def write(self, result: str, table: DataFrame, notes: Mapping[str, object] | None = None) -> list[str]:
        """Stage a table, once per run and result; returns the cohorts it holds. ``notes`` are kept with each of them.

        Rows are first brought together by cohort, which keeps the files few; the rebalance splits a
        cohort that is too large for one task. Cut-offs are doubles in every cohort, whatever the scores.
        """
        place = f"run={self.id}"
        path = f"{self.store.path(result)}/{place}"
        cutoffs = {c: F.col(c).cast("double") for c in ("cutoff", "base_cutoff") if c in table.columns}
        (
            table.withColumns(cutoffs | {"cohort": F.col("cohort").cast("string")})
            .hint("rebalance", "cohort")
            .write.mode("error")
            .option("header", True)
            .partitionBy("cohort")
            .format(self.store.fmt)
            .save(path)
        )
        files, found = self.store._files, {}
        for folder in files.names(path):
            if folder.startswith("cohort="):
                names = [f"{place}/{folder}/{n}" for n in files.names(f"{path}/{folder}") if not n.startswith(("_", "."))]
                found[folder.removeprefix("cohort=")] = {"run": self.id, "files": sorted(names), **(notes or {})}
        self._staged.setdefault(result, {}).update(found)
        return sorted(found)

    def forget(self, result: str, cohorts: Iterable[object]) -> None:
        self._staged.setdefault(result, {}).update({str(c): None for c in cohorts})

    def commit(self) -> int:
        """Publish all staged tables in one step: the next manifest appears under its name, or it does not.

        Another run may have published meanwhile; then this one adds itself to that run's manifest. Of two runs over
        the same cohorts the later one stands. Returns the manifest's number.
        """
        files, folder = self.store._files, f"{self.store.folder}/_manifests"
        while True:
            number, manifest = self.store._latest()
            for result, staged in self._staged.items():
                kept = manifest.get(result, {}) | staged
                manifest[result] = {c: e for c, e in kept.items() if e is not None}
            draft = f"{folder}/.{self.id}.json"
            files.write_text(draft, json.dumps(manifest, sort_keys=True))
            if files.rename_new(draft, f"{folder}/{number + 1:08d}.json"):
                return number + 1


def save_table(table: DataFrame, name: str) -> None:
    """The same contract on a catalog table: create it, or replace only the cohorts at hand."""
    spark = table.sparkSession
    table = table.withColumn("cohort", F.col("cohort").cast("string")).hint("rebalance", "cohort")
    if not spark.catalog.tableExists(name):
        table.write.partitionBy("cohort").saveAsTable(name)
        return
    # A session of its own: inserting takes the overwrite mode from the session, not from a write option.
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    columns = spark.table(name).columns
    path = scratch_path(spark, "table")
    table.select(*columns).write.parquet(path)
    own.read.schema(table.select(*columns).schema).parquet(path).write.insertInto(name, overwrite=True)


def csv_path(result: str, folder: str, cohort: object) -> str:
    name = "percentis_baseline" if cohort == BASELINE_COHORT else f"{CSV_NAMES[result]}_{cohort}"
    return f"{folder.rstrip('/')}/{name}.csv"


def export_csv(result: str, table: DataFrame, folder: str, cohorts: Iterable[str]) -> list[str]:
    """Write one CSV directory per cohort with the established file and column names, all in one job."""
    renamed = table.withColumnsRenamed({k: v for k, v in CSV_COLUMNS.items() if k in table.columns})
    paths = {str(c): csv_path(result, folder, c) for c in cohorts}
    write_folders(renamed, CSV_COLUMNS["cohort"], paths)
    return list(paths.values())


def read_csv(
    spark: SparkSession, result: str, folder: str, cohorts: Iterable[object], segments: Iterable[str]
) -> DataFrame:
    """Exported directories of one result as a table under our own column names and types."""
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", csv_path(result, folder, c)) for c in cohorts]
    text = spark.read.option("header", True).option("inferSchema", False).csv(paths)
    ours = {theirs: name for name, theirs in CSV_COLUMNS.items()}
    names = [c if c in set(segments) else ours.get(c, c) for c in text.columns]
    return text.toDF(*names).select([F.col(f.name).cast(f.dataType) for f in result_schema(names, segments)])


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a CSV directory is there as a whole."""
    return SharedFiles(spark).exists(f"{path}/_SUCCESS")


def write_folders(table: DataFrame, by: str, paths: Mapping[str, str]) -> None:
    """One CSV directory for each value of column ``by``, at its path, from one job whatever their number.

    Everything is written beside the targets first and then moved into place, where a marker file says that a directory
    is whole. A value without rows gets a directory with the header only.
    """
    if not paths:
        return
    files = SharedFiles(table.sparkSession)
    staging = f"{next(iter(paths.values())).rpartition('/')[0]}/.staging-{uuid.uuid4().hex}"
    try:
        (
            table.withColumn("folder_of", F.col(by).cast("string"))
            .filter(is_one_of("folder_of", list(paths)))
            .hint("rebalance", "folder_of")
            .write.option("header", True)
            .partitionBy("folder_of")
            .csv(staging)
        )
        for value, path in paths.items():
            staged = f"{staging}/folder_of={value}"
            if not files.exists(staged):
                files.write_text(f"{staged}/part-00000.csv", ",".join(table.columns) + "\n")
            files.replace(staged, path)
            files.write_text(f"{path}/_SUCCESS", "")
    finally:
        files.delete(staging)
