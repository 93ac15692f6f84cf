"""Job configuration: which scores, segments, cohorts and percentiles to monitor."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

# The labels that appear in the input and result tables.
TOTAL_LABEL = "TODOS"
VALID_LABEL = "score válido"
INVALID_LABEL = "score inválido"
BASELINE_COHORT = "baseline"

# Percentiles are compared as whole thousandths of a point, so that ranks are exact integers.
PERCENTILE_SCALE = 1000


@dataclass(frozen=True)
class SpecialValue:
    """A score value with a meaning of its own (no hit, deceased...), never a valid score."""

    value: float
    label: str


@dataclass(frozen=True)
class ScoreSpec:
    """One monitored score.

    ``high_tail`` says which end is risky: tails are ``score >= cutoff`` when true and
    ``score <= cutoff`` when false. ``ppv_percentiles`` are sizes of the risky tail, in percent;
    ``dist_percentiles`` are plain percentiles of the distribution.
    """

    name: str
    ppv_percentiles: tuple[float, ...] = ()
    dist_percentiles: tuple[float, ...] = ()
    high_tail: bool = True
    special_values: tuple[SpecialValue, ...] = ()
    valid_range: tuple[float, float] | None = None

    def __post_init__(self) -> None:
        for p in (*self.ppv_percentiles, *self.dist_percentiles):
            if not 0 <= p <= 100:
                raise ValueError(f"score {self.name}: percentile {p} is outside 0..100")
            if (Decimal(str(p)) * PERCENTILE_SCALE) % 1:
                raise ValueError(f"score {self.name}: percentile {p} has more than three decimals")

    @property
    def status_column(self) -> str:
        return f"{self.name}_status"

    @classmethod
    def from_params(cls, name: str, params: Mapping[str, Any]) -> ScoreSpec:
        specials = params.get("escores_especiais", [])
        return cls(
            name=name,
            ppv_percentiles=tuple(params.get("percentis_ppv", [])),
            dist_percentiles=tuple(params.get("percentis_dist", [])),
            high_tail=params.get("acumula_maiores", True),
            special_values=tuple(SpecialValue(s["valor"], s["significado"]) for s in specials),
            valid_range=tuple(params["intervalo_valido"]) if "intervalo_valido" in params else None,
        )


@dataclass(frozen=True)
class MonitorConfig:
    """Everything a monitoring run needs to know; plain driver-side values.

    ``derive_status`` makes the engine compute each score's status from its special values and valid
    range; otherwise the input must carry a ``<score>_status`` column.
    """

    scores: tuple[ScoreSpec, ...]
    segments: tuple[str, ...] = ()
    first_cohort: int = 0
    last_cohort: int = 0
    baseline_cohorts: tuple[int, ...] = ()
    cohort_column: str = "safra"
    response_column: str = "flag_1"
    total_label: str = TOTAL_LABEL
    derive_status: bool = False
    include_baseline: bool = True
    overwrite: bool = False
    data_folder: str = "./"
    data_prefix: str = "tbl"
    result_folder: str = "./results"
    only_cohorts: tuple[int, ...] | None = None
    score_names: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        if not self.scores:
            raise ValueError("at least one score must be configured")
        names = tuple(s.name for s in self.scores)
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate score names: {names}")
        if len(set(self.segments)) != len(self.segments):
            raise ValueError(f"duplicate segment columns: {self.segments}")
        clash = set(self.segments) & RESERVED_COLUMNS
        if clash:
            raise ValueError(f"segment columns {sorted(clash)} collide with result columns")
        object.__setattr__(self, "score_names", names)

    @property
    def production_cohorts(self) -> tuple[int, ...]:
        """The months of the period; only those of ``only_cohorts`` where that is given."""
        months = month_list(self.first_cohort, self.last_cohort)
        return months if self.only_cohorts is None else tuple(m for m in months if m in self.only_cohorts)

    @classmethod
    def from_params(
        cls, execution: Mapping[str, Any], monitoring: Mapping[str, Any], **overrides: Any
    ) -> MonitorConfig:
        """Build a config from the two JSON parameter documents (already parsed)."""
        period = execution["periodo_monitoramento"]
        values: dict[str, Any] = dict(
            scores=tuple(ScoreSpec.from_params(n, p) for n, p in monitoring.get("scores", {}).items()),
            segments=tuple(monitoring.get("aberturas", [])),
            first_cohort=int(period["data_inicio"]),
            last_cohort=int(period["data_fim"]),
            response_column=monitoring.get("variavel_resposta", "flag_1"),
            include_baseline=execution.get("incluir_baseline", False),
            overwrite=execution.get("overwrite_percentis", False),
            data_folder=monitoring.get("data_folder", "./"),
            data_prefix=monitoring.get("data_prefix", "tbl"),
            result_folder=monitoring.get("result_folder", "./results"),
        )
        return cls(**(values | overrides))

    @classmethod
    def from_files(
        cls, execution: str | Mapping[str, Any], monitoring: str | Mapping[str, Any], **overrides: Any
    ) -> MonitorConfig:
        """The same from the paths of the two documents, or from what they hold."""
        return cls.from_params(*[d if isinstance(d, Mapping) else _document(d) for d in (execution, monitoring)], **overrides)


def _document(path: str) -> dict[str, Any]:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


# Column names the result tables use themselves.
RESERVED_COLUMNS = frozenset(
    "cohort score level gid value part n pos neg pctl cutoff tail_n tail_pct base_cutoff base_tail_n "
    "base_tail_pct psi ks base_hits prod_hits total_hits base_capture_pct prod_capture_pct".split()
)


def month_list(first: int, last: int) -> tuple[int, ...]:
    """Inclusive YYYYMM months from ``first`` to ``last``; empty when first is after last."""
    if first <= 0 or first > last:
        return ()
    start, end = (c // 100 * 12 + c % 100 - 1 for c in (first, last))
    return tuple(m // 12 * 100 + m % 12 + 1 for m in range(start, end + 1))
