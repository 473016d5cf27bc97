"""Release gates over a table of run metrics (run, metric, value), and model comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.expr import col, decide

# Fixed values.
MINIMUM_METRICS = {"roc_auc": 0.75, "normalized_gini": 0.50, "precision": 0.25, "recall": 0.40}
METRIC_TOLERANCE = 0.0005
PROMOTION_METRIC, PROMOTION_MINIMUM, PROMOTION_STAGE = "roc_auc", 0.78, "Staging"
CANARY_MAX_DELTA = 0.02


def metric_gate(run_metrics: DataFrame, minimums: Mapping[str, float] = MINIMUM_METRICS, run: str = "run_id") -> DataFrame:
    """Per run: metrics that are absent, metrics below their minimum, and the status.

    The thresholds become conditional aggregates, so there is one shuffle on
    the run and no join.
    """
    named = list(minimums.items())
    wide = run_metrics.groupBy(col(run)).agg(
        F.count(F.lit(1)).alias("n_metrics"),
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(f"v{i}") for i, (m, _) in enumerate(named)],
    )
    absent = [F.when(F.col(f"v{i}").isNull(), F.lit(m)) for i, (m, _) in enumerate(named)]
    under = [F.when(F.col(f"v{i}") < F.lit(float(low)), F.lit(m)) for i, (m, low) in enumerate(named)]
    failed = F.lit(False)
    for a, u in zip(absent, under):
        failed = failed | a.isNotNull() | u.isNotNull()
    return wide.select(
        col(run),
        F.concat_ws(",", *absent).alias("missing_metrics"),
        F.concat_ws(",", *under).alias("underperforming"),
        F.when(failed, "failed").otherwise("passed").alias("status"),
    )


def metric_reconcile(
    left: DataFrame,
    right: DataFrame,
    tolerance: float = METRIC_TOLERANCE,
    keys: Sequence[str] = ("run_id", "metric"),
) -> DataFrame:
    """Two metric tables side by side: equal within the tolerance, different, or absent on a side."""
    a = left.select(*keys, F.col("value").alias("left_value"))
    b = right.select(*keys, F.col("value").alias("right_value"))
    both = a.join(b, list(keys), "full_outer")
    delta = F.abs(F.col("left_value") - F.col("right_value"))
    return both.withColumn(
        "status",
        F.when(F.col("left_value").isNull() | F.col("right_value").isNull(), "missing")
        .when(delta > tolerance, "mismatch")
        .otherwise("match"),
    )


def tag_reconcile(tags: DataFrame, expected: Mapping[str, str], run: str = "run_id") -> DataFrame:
    """Per run: the expected tags whose value differs or is absent. Input: (run, tag, value)."""
    wide = tags.groupBy(col(run)).agg(
        F.count(F.lit(1)).alias("n_tags"),
        *[F.max(F.when(F.col("tag") == t, F.col("value"))).alias(f"t{i}") for i, t in enumerate(expected)],
    )
    wrong = [
        F.when(~F.col(f"t{i}").eqNullSafe(F.lit(str(v))), F.lit(t)) for i, (t, v) in enumerate(expected.items())
    ]
    return wide.select(col(run), F.concat_ws(",", *wrong).alias("tag_mismatches"))


def aggregate_status(checks: DataFrame, run: str = "run_id") -> DataFrame:
    """Per run: failed if any check failed, skipped if all were skipped, otherwise passed."""
    return checks.groupBy(col(run)).agg(
        F.when(F.bool_or(F.col("status") == "failed"), "failed")
        .when(F.bool_and(F.col("status") == "skipped"), "skipped")
        .otherwise("passed")
        .alias("status")
    )


def run_checks(
    run_metrics: DataFrame,
    reported: DataFrame | None = None,
    tags: DataFrame | None = None,
    expected_tags: Mapping[str, str] | None = None,
    minimums: Mapping[str, float] = MINIMUM_METRICS,
    tolerance: float = METRIC_TOLERANCE,
    run: str = "run_id",
) -> DataFrame:
    """The whole validation of runs as (run, check, status): thresholds, agreement with reported metrics, tags.

    A check without its input is ``skipped``. Only runs of ``run_metrics`` are judged.
    """
    runs = run_metrics.select(col(run)).distinct()
    gate = metric_gate(run_metrics, minimums, run).select(col(run), F.lit("thresholds").alias("check"), "status")
    skipped = lambda name: runs.select(col(run), F.lit(name).alias("check"), F.lit("skipped").alias("status"))
    if reported is None:
        agreement = skipped("agreement")
    else:
        sides = metric_reconcile(run_metrics, reported, tolerance, (run, "metric"))
        per_run = sides.groupBy(col(run)).agg(F.bool_and(F.col("status") == "match").alias("fits"))
        agreement = runs.join(per_run, run, "left").select(
            col(run), F.lit("agreement").alias("check"), F.when(F.col("fits"), "passed").otherwise("failed").alias("status")
        )
    if tags is None or not expected_tags:
        labels = skipped("tags")
    else:
        fits = tag_reconcile(tags, expected_tags, run).withColumn("fits", F.col("tag_mismatches") == "")
        labels = runs.join(fits, run, "left").select(
            col(run), F.lit("tags").alias("check"), F.when(F.col("fits"), "passed").otherwise("failed").alias("status")
        )
    return gate.unionByName(agreement).unionByName(labels)


def validated_promotion(run_metrics: DataFrame, checks: DataFrame, run: str = "run_id", **rule) -> DataFrame:
    """The promotion decision of runs, with their validation status; only a passed run may enter a stage.

    ``rule`` are the options of ``promotion_decision``.
    """
    decided = promotion_decision(run_metrics, run=run, **rule)
    judged = decided.join(aggregate_status(checks, run), run, "left")
    return judged.withColumn("stage", F.when(F.col("status") == "passed", F.col("stage")))


def promotion_decision(
    run_metrics: DataFrame,
    metric: str | None = PROMOTION_METRIC,
    minimum: float | None = PROMOTION_MINIMUM,
    stage: str | None = PROMOTION_STAGE,
    run: str = "run_id",
) -> DataFrame:
    """Per run: the stage it may enter, or NULL.

    Without a metric every run qualifies; with a metric but no minimum, having
    the metric is enough.
    """
    value = F.max(F.when(F.col("metric") == F.lit(metric), F.col("value")))
    per_run = run_metrics.groupBy(col(run)).agg(value.alias("value"), F.max("ts").alias("ts"))
    if metric is None:
        passes = F.lit(True)
    elif minimum is None:
        passes = F.col("value").isNotNull()
    else:
        passes = F.col("value") >= float(minimum)
    return per_run.withColumn("stage", F.when(passes, F.lit(stage)))


def latest_run(per_run: DataFrame, run: str = "run_id", order: str = "ts") -> DataFrame:
    """The row of the most recent run (ties by run id)."""
    picked = F.max_by(F.struct("*"), F.struct(col(order), col(run)))
    return per_run.agg(picked.alias("r")).select("r.*")


def canary_compare(
    scored: DataFrame,
    production: str | None,
    candidate: str,
    threshold: float,
    max_delta: float = CANARY_MAX_DELTA,
    by: Sequence[str] = (),
) -> DataFrame:
    """Approval rate, mean and population deviation of two score columns over one scan.

    Passes when approval rate and mean move by at most ``max_delta``; without a
    production column there is nothing to compare and the status is ``skipped``.
    """
    models = [("candidate", candidate)] + ([("production", production)] if production else [])
    parts = [F.count(F.lit(1)).alias("records_compared")]
    for label, name in models:
        parts += [
            F.avg(decide(name, threshold)).alias(f"{label}_approval_rate"),
            F.avg(col(name)).alias(f"{label}_avg_probability"),
            F.stddev_pop(col(name)).alias(f"{label}_std_probability"),
        ]
    stats = scored.groupBy(*by).agg(*parts)
    if not production:
        return stats.withColumns({"status": F.lit("skipped"), "reason": F.lit("production_missing")})
    stats = stats.withColumns(
        {
            f"{m}_delta": F.abs(F.col(f"candidate_{m}") - F.col(f"production_{m}"))
            for m in ("approval_rate", "avg_probability")
        }
    )
    within = (F.col("approval_rate_delta") <= max_delta) & (F.col("avg_probability_delta") <= max_delta)
    return stats.withColumn("status", F.when(within, "passed").otherwise("failed"))
