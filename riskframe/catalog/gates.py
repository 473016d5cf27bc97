"""Release gates, canary comparison and decision audit."""

from pyspark.sql import functions as F

from riskframe.catalog.base import (
    CANDIDATE,
    CANDIDATE_INTERCEPT,
    SCORED_SQL,
    Catalog,
    event_features,
    load,
    probability,
    r6,
    scored_events,
)
from riskframe.catalog.evaluation import RUN_METRICS_SQL, run_metrics
from riskframe.operators import audit as A
from riskframe.operators import gates as G
from riskframe.plans.flows import canary

Q = Catalog()

MINIMUMS = {"roc_auc": 0.5, "precision": 0.2, "recall": 0.3, "specificity": 0.1}


@Q.add(
    "metric_gate",
    f"""
WITH {RUN_METRICS_SQL},
wide AS (SELECT run_id, max(CASE WHEN metric = 'roc_auc' THEN value END) AS a, max(CASE WHEN metric = 'precision' THEN value END) AS p,
                max(CASE WHEN metric = 'recall' THEN value END) AS r, max(CASE WHEN metric = 'specificity' THEN value END) AS s
         FROM run_metrics GROUP BY run_id)
SELECT run_id, concat_ws(',', CASE WHEN a IS NULL THEN 'roc_auc' END, CASE WHEN p IS NULL THEN 'precision' END,
                         CASE WHEN r IS NULL THEN 'recall' END, CASE WHEN s IS NULL THEN 'specificity' END) AS missing_metrics,
       concat_ws(',', CASE WHEN a < 0.5 THEN 'roc_auc' END, CASE WHEN p < 0.2 THEN 'precision' END,
                 CASE WHEN r < 0.3 THEN 'recall' END, CASE WHEN s < 0.1 THEN 'specificity' END) AS underperforming,
       CASE WHEN a IS NULL OR p IS NULL OR r IS NULL OR s IS NULL OR a < 0.5 OR p < 0.2 OR r < 0.3 OR s < 0.1
            THEN 'failed' ELSE 'passed' END AS status
FROM wide
""",
)
def metric_gate(spark, d):
    return G.metric_gate(run_metrics(spark, d), MINIMUMS)


@Q.add(
    "metric_gate_passes",
    f"""
WITH {RUN_METRICS_SQL}
SELECT run_id, '' AS missing_metrics, CASE WHEN max(CASE WHEN metric = 'recall' THEN value END) < 0.35 THEN 'recall' ELSE '' END AS underperforming,
       CASE WHEN max(CASE WHEN metric = 'recall' THEN value END) < 0.35 THEN 'failed' ELSE 'passed' END AS status
FROM run_metrics GROUP BY run_id
""",
)
def metric_gate_passes(spark, d):
    return G.metric_gate(run_metrics(spark, d), {"recall": 0.35})


@Q.add(
    "metric_reconcile",
    f"""
WITH {RUN_METRICS_SQL},
b AS (SELECT run_id, metric, CASE WHEN metric = 'f1' THEN value + 0.01e0 ELSE value END AS value FROM run_metrics WHERE metric <> 'accuracy'
      UNION ALL SELECT 'extra', 'recall', max(value) FROM run_metrics)
SELECT coalesce(a.run_id, b.run_id) AS run_id, coalesce(a.metric, b.metric) AS metric, round(a.value, 6) AS left_value,
       round(b.value, 6) AS right_value,
       CASE WHEN a.value IS NULL OR b.value IS NULL THEN 'missing' WHEN abs(a.value - b.value) > 0.0005 THEN 'mismatch' ELSE 'match' END AS status
FROM (SELECT run_id, metric, value FROM run_metrics) a FULL JOIN b ON a.run_id = b.run_id AND a.metric = b.metric
""",
)
def metric_reconcile(spark, d):
    left = run_metrics(spark, d).select("run_id", "metric", "value")
    shifted = F.when(F.col("metric") == "f1", F.col("value") + 0.01).otherwise(F.col("value"))
    right = left.filter(F.col("metric") != "accuracy").withColumn("value", shifted)
    extra = left.agg(F.max("value").alias("value")).select(
        F.lit("extra").alias("run_id"), F.lit("recall").alias("metric"), "value"
    )
    both = G.metric_reconcile(left, right.unionByName(extra))
    return both.withColumns({"left_value": r6("left_value"), "right_value": r6("right_value")})


@Q.add(
    "tag_reconcile",
    """
SELECT strftime(ts, '%Y-%m-%d') AS run_id,
       CASE WHEN count(DISTINCT event_type) = 5 THEN '' ELSE 'kinds' END AS tag_mismatches
FROM events GROUP BY 1
""",
)
def tag_reconcile(spark, d):
    events = load(spark, d, "events").withColumn("run_id", F.date_format("ts", "yyyy-MM-dd"))
    kinds = events.groupBy("run_id").agg(F.count_distinct("event_type").cast("string").alias("value"))
    return G.tag_reconcile(kinds.withColumn("tag", F.lit("kinds")), {"kinds": "5"})


@Q.add(
    "status_rollup",
    f"""
WITH {RUN_METRICS_SQL},
checks AS (
  SELECT run_id, metric AS name, CASE WHEN metric = 'f1' THEN 'skipped' WHEN value < 0.3 THEN 'failed' ELSE 'passed' END AS status
  FROM run_metrics WHERE metric IN ('f1', 'recall')
)
SELECT run_id, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_and(status = 'skipped') THEN 'skipped' ELSE 'passed' END AS status
FROM checks GROUP BY run_id
""",
)
def status_rollup(spark, d):
    checks = run_metrics(spark, d).filter(F.col("metric").isin("f1", "recall")).select(
        "run_id",
        F.col("metric").alias("name"),
        F.when(F.col("metric") == "f1", "skipped").when(F.col("value") < 0.3, "failed").otherwise("passed").alias("status"),
    )
    return G.aggregate_status(checks)


@Q.add(
    "promotion_decision",
    f"""
WITH {RUN_METRICS_SQL}
SELECT run_id, max(CASE WHEN metric = 'roc_auc' THEN value END) AS value, max(ts) AS ts,
       CASE WHEN max(CASE WHEN metric = 'roc_auc' THEN value END) >= 0.5 THEN 'Staging' END AS stage
FROM run_metrics GROUP BY run_id
""",
)
def promotion_decision(spark, d):
    return G.promotion_decision(run_metrics(spark, d), "roc_auc", 0.5)


@Q.add(
    "latest_run",
    f"""
WITH {RUN_METRICS_SQL}
SELECT run_id, max(CASE WHEN metric = 'roc_auc' THEN value END) AS value, max(ts) AS ts,
       CASE WHEN max(CASE WHEN metric = 'roc_auc' THEN value END) >= 0.5 THEN 'Staging' END AS stage
FROM run_metrics GROUP BY run_id ORDER BY ts DESC, run_id DESC LIMIT 1
""",
)
def latest_run(spark, d):
    return G.latest_run(promotion_decision(spark, d))


_VALIDATED_SQL = f"""
WITH {RUN_METRICS_SQL},
m AS (SELECT run_id, max(CASE WHEN metric = 'roc_auc' THEN value END) AS a, max(CASE WHEN metric = 'recall' THEN value END) AS r,
             max(ts) AS ts FROM run_metrics GROUP BY run_id),
kinds AS (SELECT strftime(ts, '%Y-%m-%d') AS run_id, count(DISTINCT event_type) AS n FROM events GROUP BY 1),
checks AS (
  SELECT run_id, CASE WHEN r < 0.35 OR r IS NULL THEN 'failed' ELSE 'passed' END AS thresholds,
         CASE WHEN CAST(substr(run_id, 9, 2) AS INT) % 4 = 0 THEN 'failed' ELSE 'passed' END AS agreement,
         CASE WHEN n = 5 THEN 'passed' ELSE 'failed' END AS tags, a, ts
  FROM m LEFT JOIN kinds USING (run_id)
)
"""


def _validated(spark, d):
    """Runs with their metrics, what was reported of them (wrong every fourth day), and their tags."""
    metrics = run_metrics(spark, d).select("run_id", "metric", "value", "ts")
    wrong = (F.substring("run_id", 9, 2).cast("int") % 4 == 0) & (F.col("metric") == "f1")
    reported = metrics.select("run_id", "metric", F.when(wrong, F.col("value") + 0.01).otherwise(F.col("value")).alias("value"))
    events = load(spark, d, "events").withColumn("run_id", F.date_format("ts", "yyyy-MM-dd"))
    tags = events.groupBy("run_id").agg(F.count_distinct("event_type").cast("string").alias("value"))
    return metrics, reported, tags.withColumn("tag", F.lit("kinds"))


@Q.add(
    "run_checks",
    f"""{_VALIDATED_SQL}
SELECT run_id, 'thresholds' AS "check", thresholds AS status FROM checks
UNION ALL SELECT run_id, 'agreement', agreement FROM checks UNION ALL SELECT run_id, 'tags', tags FROM checks
""",
)
def run_checks(spark, d):
    metrics, reported, tags = _validated(spark, d)
    return G.run_checks(metrics, reported, tags, {"kinds": "5"}, {"recall": 0.35})


@Q.add(
    "validated_promotion",
    f"""{_VALIDATED_SQL}
SELECT run_id, a AS value, ts, CASE WHEN 'failed' IN (thresholds, agreement, tags) THEN 'failed' ELSE 'passed' END AS status,
       CASE WHEN 'failed' NOT IN (thresholds, agreement, tags) AND a >= 0.5 THEN 'Staging' END AS stage
FROM checks
""",
)
def validated_promotion(spark, d):
    metrics, reported, tags = _validated(spark, d)
    checks = G.run_checks(metrics, reported, tags, {"kinds": "5"}, {"recall": 0.35})
    return G.validated_promotion(metrics, checks, metric="roc_auc", minimum=0.5)


@Q.add(
    "run_checks_skipped",
    f"""
WITH {RUN_METRICS_SQL}
SELECT run_id, CASE WHEN max(CASE WHEN metric = 'recall' THEN value END) >= 0.35 THEN 'passed' ELSE 'failed' END AS status
FROM run_metrics GROUP BY run_id
""",
)
def run_checks_skipped(spark, d):
    """Without reported metrics and tags only the thresholds count."""
    return G.aggregate_status(G.run_checks(run_metrics(spark, d), minimums={"recall": 0.35}))


def _models(prefix: str, score: str) -> str:
    return (
        f"round(avg(CASE WHEN {score} >= 0.5 THEN 1 ELSE 0 END), 6) AS {prefix}_approval_rate, "
        f"round(avg({score}), 6) AS {prefix}_avg_probability, round(stddev_pop({score}), 6) AS {prefix}_std_probability"
    )


@Q.add(
    "canary_compare",
    f"""
WITH {SCORED_SQL},
s AS (SELECT count(*) AS records_compared, {_models('candidate', 'candidate')}, {_models('production', 'probability')},
             avg(CASE WHEN candidate >= 0.5 THEN 1 ELSE 0 END) - avg(CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END) AS da,
             avg(candidate) - avg(probability) AS dp FROM scored)
SELECT * EXCLUDE (da, dp), round(abs(da), 6) AS approval_rate_delta, round(abs(dp), 6) AS avg_probability_delta,
       CASE WHEN abs(da) <= 0.02 AND abs(dp) <= 0.02 THEN 'passed' ELSE 'failed' END AS status FROM s
""",
)
def canary_compare(spark, d):
    scored = scored_events(spark, d).withColumn("candidate", probability(CANDIDATE, CANDIDATE_INTERCEPT))
    result = G.canary_compare(scored, "probability", "candidate", 0.5)
    return result.select(*[c if c in ("records_compared", "status") else r6(c).alias(c) for c in result.columns])


@Q.add(
    "canary_models",
    f"""
WITH {SCORED_SQL},
s AS (SELECT run_id, count(*) AS records_compared, {_models('candidate', 'candidate')}, {_models('production', 'probability')},
             avg(CASE WHEN candidate >= 0.5 THEN 1 ELSE 0 END) - avg(CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END) AS da,
             avg(candidate) - avg(probability) AS dp FROM scored GROUP BY run_id)
SELECT * EXCLUDE (da, dp), round(abs(da), 6) AS approval_rate_delta, round(abs(dp), 6) AS avg_probability_delta,
       CASE WHEN abs(da) <= 0.03 AND abs(dp) <= 0.03 THEN 'passed' ELSE 'failed' END AS status FROM s
""",
)
def canary_models(spark, d):
    """Both models score the same table; the verdict per day."""
    events = event_features(load(spark, d, "events"))
    result = canary(events, probability(CANDIDATE, CANDIDATE_INTERCEPT), probability(), max_delta=0.03, by=["run_id"])
    return result.select(*[c if c in ("run_id", "records_compared", "status") else r6(c).alias(c) for c in result.columns])


@Q.add(
    "canary_skipped",
    f"""
WITH {SCORED_SQL}
SELECT count(*) AS records_compared, {_models('candidate', 'probability')}, 'skipped' AS status, 'production_missing' AS reason FROM scored
""",
)
def canary_skipped(spark, d):
    result = G.canary_compare(scored_events(spark, d), None, "probability", 0.5)
    return result.select(*[c if c in ("records_compared", "status", "reason") else r6(c).alias(c) for c in result.columns])


AUDIT_COLUMNS = """
count(*) AS entity_count, CAST(sum(prediction) AS BIGINT) AS positive_decisions, round(sum(prediction) / count(*), 6) AS alert_rate,
count(DISTINCT user_id) AS unique_entities, CAST(count_if(probability >= 0.7) AS BIGINT) AS band_high_risk,
CAST(count_if(probability >= 0.4 AND probability < 0.7) AS BIGINT) AS band_medium_risk,
CAST(count_if(probability < 0.4) AS BIGINT) AS band_low_risk, round(avg(probability), 6) AS probability_mean
"""


@Q.add("inference_audit", f"WITH {SCORED_SQL} SELECT run_id, {AUDIT_COLUMNS} FROM scored GROUP BY run_id")
def inference_audit(spark, d):
    audit = A.inference_audit(scored_events(spark, d), ["run_id"], entity="user_id")
    return audit.withColumns({"alert_rate": r6("alert_rate"), "probability_mean": r6("probability_mean")})


@Q.add(
    "inference_audit_decisions",
    f"""
WITH {SCORED_SQL}
SELECT run_id, count(*) AS entity_count, CAST(sum(prediction) AS BIGINT) AS positive_decisions,
       round(sum(prediction) / count(*), 6) AS alert_rate, count(*) AS unique_entities,
       CAST(sum(prediction) AS BIGINT) AS band_high_risk, CAST(0 AS BIGINT) AS band_medium_risk,
       CAST(sum(1 - prediction) AS BIGINT) AS band_low_risk
FROM scored GROUP BY run_id
""",
)
def inference_audit_decisions(spark, d):
    """Bands from hard decisions when a model gives no probability."""
    audit = A.inference_audit(scored_events(spark, d).drop("probability"), ["run_id"], probability=None)
    return audit.withColumn("alert_rate", r6("alert_rate"))


@Q.add(
    "prediction_sample",
    f"WITH {SCORED_SQL} SELECT event_id, prediction, probability FROM scored ORDER BY event_id LIMIT 50",
)
def prediction_sample(spark, d):
    return A.prediction_sample(scored_events(spark, d).select("event_id", "prediction", "probability"), "event_id")
