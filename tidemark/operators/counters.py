"""What a run has read, counted while it reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scores import is_valid, score_status
from tidemark.plans.config import INVALID_LABEL, VALID_LABEL, MonitorConfig

KINDS = ("valid", "special", "invalid", "missing")


class RunCounts:
    """Rows by kind of each score, observed on the rows' way into the histogram: no scan of their own.

    ``valid`` counts where the score does; ``missing`` are null scores; ``invalid`` and ``special`` are the others, by
    their status.
    """

    def __init__(self, config: MonitorConfig) -> None:
        self.config, self._seen, self._numbers = config, Observation(), {}

    def _counts(self) -> list[Column]:
        counts = [F.count(F.lit(1)).alias("rows")]
        for s in self.config.scores:
            status = score_status(s) if self.config.derive_status else F.col(s.status_column)
            missing = F.col(s.name).isNull()
            valid = ~missing & F.coalesce(is_valid(s, self.config.derive_status), F.lit(False))
            kinds = {
                "valid": valid,
                "special": ~missing & ~valid & ~F.coalesce(status.isin(VALID_LABEL, INVALID_LABEL), F.lit(False)),
                "invalid": ~missing & (status == INVALID_LABEL),
                "missing": missing,
            }
            counts += [F.count_if(test).alias(f"{s.name} {kind}") for kind, test in kinds.items()]
        return counts

    def watch(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self._seen, *self._counts())

    def read(self, rows: DataFrame, base: DataFrame) -> None:
        """Take the numbers once ``base`` has been made of the watched ``rows``.

        Where no row went into it the planner may have left the observation out, and the rows are counted instead.
        """
        self._numbers = rows.agg(*self._counts()).first().asDict() if base.isEmpty() else self._seen.get

    def table(self, spark: SparkSession) -> DataFrame:
        """``score, rows, valid, special, invalid, missing``: a row for each score."""
        seen = self._numbers
        rows = [(s.name, seen["rows"], *[seen[f"{s.name} {k}"] for k in KINDS]) for s in self.config.scores]
        return spark.createDataFrame(rows, "score string, rows long, " + ", ".join(f"{k} long" for k in KINDS))
