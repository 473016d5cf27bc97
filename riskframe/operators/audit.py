"""Audit of served decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.expr import col, count_where, risk_band


BANDS = ("high_risk", "medium_risk", "low_risk")


def audit_measures(
    probability: str | None = "probability", prediction: str = "prediction", entity: str | None = None, exact: bool = True
) -> list[Column]:
    """Counts, alert rate and bands. Without probabilities the bands follow the decisions.

    ``exact=False`` counts entities approximately, the only way in a streaming window.
    """
    positive = F.coalesce(F.sum(col(prediction)), F.lit(0)).cast("long")
    rows = F.count(F.lit(1))
    band = _band(probability, prediction)
    if entity is None:
        entities = rows
    else:
        entities = F.count_distinct(col(entity)) if exact else F.approx_count_distinct(col(entity))
    measures = [
        rows.alias("entity_count"),
        positive.alias("positive_decisions"),
        F.coalesce(F.try_divide(positive.cast("double"), rows.cast("double")), F.lit(0.0)).alias("alert_rate"),
        entities.alias("unique_entities"),
        *[F.coalesce(count_where(band == b), F.lit(0)).alias(f"band_{b}") for b in BANDS],
    ]
    return measures + ([F.avg(col(probability)).alias("probability_mean")] if probability else [])


def _band(probability: str | None, prediction: str) -> Column:
    return risk_band(probability) if probability else F.when(col(prediction) == 1, "high_risk").otherwise("low_risk")


def audit_sums(probability: str | None = "probability", prediction: str = "prediction") -> list[Column]:
    """What the audit measures of a group can be added up from."""
    band = _band(probability, prediction)
    scores = [F.sum(col(probability)).alias("scores"), F.count(col(probability)).alias("scored")] if probability else []
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(col(prediction)).alias("positive"),
        *[F.coalesce(count_where(band == b), F.lit(0)).alias(f"band_{b}") for b in BANDS],
        *scores,
    ]


def measures_of_sums(probability: str | None, entity: str) -> list[Column]:
    """The audit measures from ``audit_sums`` per entity; a NULL entity is none."""
    rows, positive = F.sum("rows"), F.coalesce(F.sum("positive"), F.lit(0)).cast("long")
    measures = [
        rows.alias("entity_count"),
        positive.alias("positive_decisions"),
        F.coalesce(F.try_divide(positive.cast("double"), rows.cast("double")), F.lit(0.0)).alias("alert_rate"),
        F.count(entity).alias("unique_entities"),
        *[F.sum(f"band_{b}").alias(f"band_{b}") for b in BANDS],
    ]
    return measures + ([F.try_divide(F.sum("scores"), F.sum("scored")).alias("probability_mean")] if probability else [])


def inference_audit(
    scored: DataFrame,
    by: Sequence[str | Column] = (),
    probability: str | None = "probability",
    prediction: str = "prediction",
    entity: str | None = None,
) -> DataFrame:
    return scored.groupBy(*by).agg(*audit_measures(probability, prediction, entity))


def prediction_sample(scored: DataFrame, key: str, n: int = 50) -> DataFrame:
    """The first ``n`` scored rows in key order, kept for audit."""
    return scored.orderBy(col(key)).limit(n)
