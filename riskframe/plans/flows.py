"""The stages from raw tables to a monitored model, each a few operators in order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.expr import col
from riskframe.operators import contract as K
from riskframe.operators.assemble import check_no_overlap
from riskframe.operators.drift import DriftReport, drift_metrics_row, drift_report, retrain_decision
from riskframe.operators.frame import require_columns
from riskframe.operators.gates import CANARY_MAX_DELTA, MINIMUM_METRICS, aggregate_status, canary_compare, run_checks
from riskframe.operators.metrics import evaluate, metrics_table
from riskframe.operators.profile import lineage
from riskframe.operators.sampling import split
from riskframe.operators.storage import stored
from riskframe.plans import loan_features as L
from riskframe.plans.scoring import DECISION_THRESHOLD, add_scores, evaluated_rows
from riskframe.plans.training import SEED, SMOTE_RATIO, TEST_SIZE, rebalance, train

MEASURES = ("accuracy", "precision", "recall", "f1", "roc_auc", "normalized_gini")


def build_feature_store(
    tables: L.LoanTables, required: Sequence[str] = (), check: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Raw contracts, features, feature contract; returns the stored table and its lineage."""
    raw = vars(tables)
    if check:
        K.enforce(K.run_contracts(raw, L.RAW_CONTRACTS), "raw tables")
    features = stored(L.feature_table(tables), "feature-store")
    if check:
        K.enforce(K.run_contract(features, K.feature_store_contract(L.TARGET, L.ENTITY)), "feature_store")
        K.check_features_present(features, required)
    return features, lineage(raw, features)


def split_feature_store(
    features: DataFrame,
    target: str = L.TARGET,
    entity: str = L.ENTITY,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    stratify: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Train and test parts, each checked, without a shared entity."""
    train_part, test_part = split(features, test_size, seed, entity, target if stratify else None)
    for name, part in (("train", train_part), ("test", test_part)):
        K.enforce(K.run_contract(part, K.split_contract(target, entity, name)), f"{name} split")
    check_no_overlap(train_part, test_part, entity)
    return train_part, test_part


@dataclass(frozen=True)
class TrainingRun:
    model: PipelineModel
    metrics: DataFrame
    evaluated: DataFrame


def train_and_evaluate(
    train_part: DataFrame,
    test_part: DataFrame,
    columns: Sequence[str],
    target: str = L.TARGET,
    entity: str = L.ENTITY,
    kind: str = "gbt",
    params: Mapping | None = None,
    smote_ratio: float | None = SMOTE_RATIO,
    downsample: bool = True,
    run_id: str = "run",
) -> TrainingRun:
    """Matrix checks, rebalancing, fit, and the measures of the test part as run metrics.

    The test part is judged by the model's own decision, at one half.
    """
    for name, part in (("train", train_part), ("test", test_part)):
        require_columns(part, columns, f"{name} matrix")
        K.enforce(K.matrix_check(part, columns, f"{name} matrix"), f"{name} matrix")
    if smote_ratio or downsample:
        train_part = stored(rebalance(train_part, columns, target, entity, smote_ratio, downsample), "balanced")
    model = train(train_part, columns, target, kind, params)
    evaluated = evaluated_rows(test_part, model, target, entity)
    measured = evaluate(evaluated, "y_true", "prediction", "probability").withColumn("run_id", F.lit(run_id))
    metrics = metrics_table(measured, "run_id", MEASURES).withColumn("ts", F.current_timestamp())
    return TrainingRun(model, metrics, evaluated)


def validate_runs(
    metrics: DataFrame,
    minimums: Mapping[str, float] = MINIMUM_METRICS,
    must_pass: bool = True,
    reported: DataFrame | None = None,
    tags: DataFrame | None = None,
    expected_tags: Mapping[str, str] | None = None,
) -> DataFrame:
    """All checks of runs and their status; a failing run raises unless ``must_pass`` is off."""
    checks = run_checks(metrics, reported, tags, expected_tags, minimums)
    status = aggregate_status(checks)
    if must_pass:
        failed = [r[0] for r in status.filter("status = 'failed'").select("run_id").limit(5).collect()]
        if failed:
            raise RuntimeError(f"validation failed for: {', '.join(failed)}")
    return status


def canary(
    table: DataFrame,
    candidate: PipelineModel | Column,
    production: PipelineModel | Column | None,
    threshold: float = DECISION_THRESHOLD,
    max_delta: float = CANARY_MAX_DELTA,
    by: Sequence[str] = (),
    must_pass: bool = False,
) -> DataFrame:
    """Scores one table with both models and compares them; a failure raises on request.

    A model without probabilities is compared by its decisions. Without a production model the status is ``skipped``.
    """
    models = {"candidate": candidate} | ({"production": production} if production is not None else {})
    scored = table
    for name, model in models.items():
        one = add_scores(scored, model, threshold)
        value = "probability" if "probability" in one.columns else "prediction"
        scored = one.withColumn(f"__{name}", col(value).cast("double")).drop("probability", "prediction")
    compared = canary_compare(
        scored, "__production" if production is not None else None, "__candidate", threshold, max_delta, by
    )
    if must_pass and compared.filter("status = 'failed'").limit(1).count():
        raise RuntimeError("the candidate departs from the production model")
    return compared


def monitor_production(
    reference: DataFrame,
    current: DataFrame,
    auto_retrain: bool = False,
    force: bool = False,
    command: str | None = None,
    names: tuple[str, str] = ("reference", "current"),
    **options,
) -> tuple[DriftReport, DataFrame]:
    """The drift report and the history row with the retraining decision."""
    report = drift_report(reference, current, **options)
    decided = retrain_decision(report.summary, auto_retrain, force=force, command=command)
    return report, drift_metrics_row(decided, *names)
