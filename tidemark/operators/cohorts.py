"""Monthly cohorts: the calendar spine, gaps in it, and what still has to be computed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.literals import texts


def cohort_month(cohort: Column) -> Column:
    """First day of a YYYYMM cohort."""
    return F.to_date(cohort.cast("string"), "yyyyMM")


def shift_cohort(cohort: Column, months: int) -> Column:
    """The YYYYMM cohort some months later (or earlier)."""
    return F.date_format(F.add_months(cohort_month(cohort), months), "yyyyMM").cast("int")


def month_spine(periods: DataFrame, first: str = "first_cohort", last: str = "last_cohort") -> DataFrame:
    """Every YYYYMM month of each period, both ends included; none when the period is reversed."""
    start, end = cohort_month(F.col(first)), cohort_month(F.col(last))
    months = F.when(start <= end, F.sequence(start, F.greatest(start, end), F.expr("interval 1 month")))
    return periods.select(F.explode(months).alias("month")).select(
        F.date_format("month", "yyyyMM").cast("int").alias("cohort")
    )


def cohort_list(spark: SparkSession, cohorts: Iterable[int]) -> DataFrame:
    return spark.sql(f"SELECT explode(CAST({texts(cohorts)} AS ARRAY<INT>)) AS cohort")


def missing_cohorts(requested: DataFrame, present: DataFrame) -> DataFrame:
    """Requested cohorts without any input."""
    return requested.join(present.select("cohort").distinct(), "cohort", "left_anti")


def pending_cohorts(requested: DataFrame, stored: DataFrame, overwrite: bool = False) -> DataFrame:
    """Cohorts to compute: all of them when overwriting, else those without a stored result."""
    if overwrite:
        return requested.distinct()
    return requested.distinct().join(stored.select("cohort").distinct(), "cohort", "left_anti")


def union_results(*tables: DataFrame) -> DataFrame:
    """Stack result tables by column name; a column one of them lacks is null there."""
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table, allowMissingColumns=True)
    return stacked
