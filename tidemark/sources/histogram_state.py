"""The base histogram as stored state: cohorts are scanned once, late rows are added, and any report can be made of it.

Counts by cohort, score, finest segment level and value do not depend on percentiles, on the scores' directions or on
the baseline, so those may change without a new scan. What they do depend on is in the state's fingerprint.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import cohorts_in, is_one_of
from tidemark.operators.histogram import base_histogram, score_rows
from tidemark.plans.config import MonitorConfig
from tidemark.sources.cohort_tables import cohort_rows
from tidemark.sources.results import ResultStore
from tidemark.sources.scratch import scratch_scope, stored


def fingerprint(config: MonitorConfig) -> str:
    """A short name for everything in the configuration that the histogram depends on."""
    scores = []
    for s in config.scores:
        rules = [[[v.value, v.label] for v in s.special_values], s.valid_range] if config.derive_status else None
        scores.append([s.name, rules])
    parts = [config.cohort_column, config.response_column, config.total_label, config.segments, config.derive_status, scores]
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()[:16]


class HistogramState:
    """Base histograms by cohort in a ``ResultStore``, under the fingerprint of a configuration.

    Every change is published in one step. Files of replaced cohorts stay until the store's ``clean``.
    """

    def __init__(self, store: ResultStore, config: MonitorConfig) -> None:
        self.store, self.config = store, config
        self.result = f"histogram_{fingerprint(config)}"

    def cohorts(self) -> set[str]:
        return set(self.store.entries(self.result))

    def refresh(self, rows: DataFrame, cohorts: Iterable[int]) -> list[str]:
        """Scan the cohorts the state doesn't have, and only those; returns the ones that were found and added."""
        pending = [c for c in cohorts if str(c) not in self.cohorts()]
        if not pending:
            return []
        wanted = cohort_rows(rows, self.config, pending)
        run = self.store.run()
        added = run.write(self.result, base_histogram(score_rows(wanted, self.config), self.config), {"batches": []})
        run.commit()
        return added

    def add(self, rows: DataFrame, batch: str) -> list[str]:
        """Add late rows of cohorts the state has; returns those cohorts.

        ``batch`` names the rows: a batch that a cohort already has is not added to it again, so a repeated call does no
        harm. Rows of other cohorts are left for the first scan of those, which finds them in the source.
        """
        entries = self.store.entries(self.result)
        open_cohorts = [c for c, e in entries.items() if batch not in e["batches"]]
        if not open_cohorts:
            return []
        late_rows = rows.filter(cohorts_in(rows, self.config.cohort_column, open_cohorts))
        run = self.store.run()
        with scratch_scope(rows.sparkSession):
            late = stored(base_histogram(score_rows(late_rows, self.config), self.config), "late")
            touched = [r["cohort"] for r in late.select("cohort").distinct().collect()]  # months only
            if not touched:
                return []
            kept = self.base(touched)
            kind, own = late.schema["value"].dataType, kept.schema["value"].dataType
            if isinstance(own, T.IntegralType) and not isinstance(kind, T.IntegralType):
                raise ValueError(f"late scores of type {kind.simpleString()} do not fit stored ones of type {own.simpleString()}")
            both = kept.unionByName(late.withColumn("value", F.col("value").cast(own)))
            keys = ["cohort", "score", *self.config.segments, "value"]
            merged = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "pos", "neg")])
            for earlier in {tuple(entries[c]["batches"]) for c in touched}:
                same = [c for c in touched if tuple(entries[c]["batches"]) == earlier]
                run.write(self.result, merged.filter(is_one_of("cohort", same)), {"batches": [*earlier, batch]})
        run.commit()
        return sorted(touched)

    def invalidate(self, cohorts: Iterable[object]) -> None:
        """Forget cohorts; the next ``refresh`` that wants them scans them again."""
        self.store.drop(self.result, cohorts)

    def base(self, cohorts: Iterable[object]) -> DataFrame:
        """The base histogram of some cohorts, from their files only."""
        return self.store.read(self.result, cohorts=cohorts)
