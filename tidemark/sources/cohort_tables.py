"""Where cohort data comes from: catalog tables, files partitioned by cohort, or one CSV per cohort."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import cohorts_in
from tidemark.plans.config import BASELINE_COHORT, MonitorConfig
from tidemark.sources.files import SharedFiles
from tidemark.sources.results import write_folders


def input_schema(config: MonitorConfig, score_type: T.DataType = T.DoubleType()) -> T.StructType:
    """The columns a run reads from cohort files; scores may be fractional."""
    fields = [T.StructField(s, T.StringType()) for s in config.segments]
    fields += [T.StructField(s.name, score_type) for s in config.scores]
    if not config.derive_status:
        fields += [T.StructField(s.status_column, T.StringType()) for s in config.scores]
    return T.StructType([*fields, T.StructField(config.response_column, T.IntegerType())])


def needed_columns(config: MonitorConfig) -> list[str]:
    statuses = [] if config.derive_status else [s.status_column for s in config.scores]
    return [config.cohort_column, *config.segments, *config.score_names, *statuses, config.response_column]


def cohort_table(spark: SparkSession, name: str, config: MonitorConfig, cohorts: Iterable[int]) -> DataFrame:
    """Chosen cohorts of a catalog table or view; the filter prunes when the table is partitioned by cohort."""
    return cohort_rows(spark.table(name), config, cohorts)


def cohort_rows(rows: DataFrame, config: MonitorConfig, cohorts: Iterable[int]) -> DataFrame:
    return rows.filter(cohorts_in(rows, config.cohort_column, cohorts)).select(*needed_columns(config))


def baseline_rows(rows: DataFrame, config: MonitorConfig) -> DataFrame:
    """The baseline cohorts of a table, relabelled as one cohort."""
    chosen = cohort_rows(rows, config, config.baseline_cohorts)
    return chosen.withColumn(config.cohort_column, F.lit(BASELINE_COHORT))


def cohort_tables(spark: SparkSession, pattern: str, config: MonitorConfig, cohorts: Iterable[object]) -> DataFrame:
    """One catalog table per cohort, named by ``pattern`` with ``{cohort}``; the cohort is the table's.

    A cohort without a table is absent. Also reads a baseline table: its cohort is ``baseline``.
    """
    found = [(c, name) for c in cohorts if spark.catalog.tableExists(name := pattern.format(cohort=c))]
    columns = [c for c in needed_columns(config) if c != config.cohort_column]
    tables = [spark.table(name).select(_cohort(c, config), *columns) for c, name in found]
    return _stacked(spark, tables, config)


def cohort_csv(
    spark: SparkSession, config: MonitorConfig, cohorts: Iterable[int], schema: T.StructType | None = None
) -> DataFrame:
    """All cohort files ``<folder>/<prefix>_<YYYYMM>.csv`` as one table.

    Every month is read by its own header, so months may order their columns differently; months with
    the same header are one read. The headers are the only thing read ahead. A month without a file is
    absent; without any the table is empty. Types: ``schema``, else that of ``input_schema``; whole
    numbers may be written as ``1.0``.
    """
    by_header: dict[tuple[str, ...], dict[int, str]] = defaultdict(dict)
    for cohort in cohorts:
        header = _header(spark, _file(config, cohort))
        if header is not None:
            by_header[header][cohort] = _csv_path(config, cohort)
    tables = []
    in_path = r"_(\d{6})\.csv(/[^/]*)?$"
    for paths in by_header.values():
        cohort = F.regexp_extract("_metadata.file_path", in_path, 1).cast("int").alias(config.cohort_column)
        text = spark.read.option("header", True).option("inferSchema", False).csv([*paths.values()])
        tables.append(text.select(cohort, *_typed(text, config, schema)))
    return _stacked(spark, tables, config, schema)


def baseline_csv(spark: SparkSession, config: MonitorConfig, schema: T.StructType | None = None) -> DataFrame | None:
    """The baseline file ``<folder>/<prefix>_baseline.csv``; None where there is none."""
    if _header(spark, _file(config, BASELINE_COHORT)) is None:
        return None
    text = spark.read.option("header", True).option("inferSchema", False).csv(_csv_path(config, BASELINE_COHORT))
    return text.select(_cohort(BASELINE_COHORT, config), *_typed(text, config, schema))


def _file(config: MonitorConfig, cohort: object) -> str:
    return f"{config.data_folder.rstrip('/')}/{config.data_prefix}_{cohort}.csv"


def _csv_path(config: MonitorConfig, cohort: object) -> str:
    """The path of a cohort's file, taken as it is: signs that would make it a pattern are escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", _file(config, cohort))


def _header(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Column names of a CSV file or directory, from its first line, without a job; None where there is none."""
    line = SharedFiles(spark).first_line(path)
    return None if line is None else tuple(next(csv.reader([line.removeprefix("\ufeff")]), ()))


def has_status(spark: SparkSession, config: MonitorConfig, cohorts: Iterable[int]) -> bool:
    """Whether the files of the cohorts bring a status for each score; told from their headers."""
    headers = filter(None, (_header(spark, _file(config, c)) for c in cohorts))
    return all(s.status_column in header for header in headers for s in config.scores)


def _typed(text: DataFrame, config: MonitorConfig, schema: T.StructType | None) -> list[Column]:
    columns = []
    for f in (schema or input_schema(config)).fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.IntegralType):
            value = value.cast("double")
        columns.append(value.cast(f.dataType).alias(f.name))
    return [c for c, f in zip(columns, (schema or input_schema(config)).fields) if f.name != config.cohort_column]


def _cohort(cohort: object, config: MonitorConfig) -> Column:
    return F.lit(cohort).alias(config.cohort_column)


def _stacked(
    spark: SparkSession, tables: list[DataFrame], config: MonitorConfig, schema: T.StructType | None = None
) -> DataFrame:
    if not tables:
        fields = [f for f in (schema or input_schema(config)).fields if f.name != config.cohort_column]
        return spark.createDataFrame([], T.StructType([T.StructField(config.cohort_column, T.IntegerType()), *fields]))
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table)
    return stacked


def write_cohort_csv(rows: DataFrame, config: MonitorConfig, cohorts: Iterable[int]) -> None:
    """One CSV directory per cohort, under the names ``cohort_csv`` reads; one job for all."""
    write_folders(rows, config.cohort_column, {str(c): _file(config, c) for c in cohorts})
