"""Column functions on scores: status, validity, band mapping, clipping and percentages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.plans.config import INVALID_LABEL, VALID_LABEL, ScoreSpec

# Income bands and their midpoints, in thousands.
INCOME_BAND_MIDPOINTS = {
    "<1k": 0.5,
    "1k~3k": 2.0,
    "3k~5k": 4.0,
    "5k~10k": 7.5,
    "10k~20k": 15.0,
    "20k~30k": 25.0,
    "30k+": 35.0,
}


def score_status(spec: ScoreSpec, score: Column | None = None) -> Column:
    """Status label of a score: a special value's own label, out of range, or valid.

    A null score has a null status, so it never counts as valid.
    """
    value = F.col(spec.name) if score is None else score
    status = F.when(value.isNull(), F.lit(None).cast("string"))
    for special in spec.special_values:
        status = status.when(value == special.value, F.lit(special.label))
    if spec.valid_range is not None:
        low, high = spec.valid_range
        status = status.when(~value.between(low, high), F.lit(INVALID_LABEL))
    return status.otherwise(F.lit(VALID_LABEL))


def is_valid(spec: ScoreSpec, derive_status: bool = False) -> Column:
    """Predicate for rows whose score counts."""
    status = score_status(spec) if derive_status else F.col(spec.status_column)
    return status == VALID_LABEL


def band_midpoint(band: Column, midpoints: Mapping[str, float] = INCOME_BAND_MIDPOINTS) -> Column:
    """Number standing for an ordinal band; null for an unknown or null band."""
    table = F.create_map(*[F.lit(x) for pair in midpoints.items() for x in pair])
    return F.try_element_at(table, band)


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound to [low, high]; a null stays null (greatest and least alone would skip it)."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def fill_null(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(value, F.lit(default))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 as a double; null when the whole is zero or null."""
    return (F.try_divide(part.cast("double"), whole.cast("double")) * 100).cast("double")
