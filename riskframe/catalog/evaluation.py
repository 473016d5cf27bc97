"""Scoring with known coefficients and evaluation."""

from pyspark.sql import functions as F

from riskframe.catalog.base import SCORED_SQL, Catalog, event_features, load, probability, r6, scored_events
from riskframe.functions import expr as X
from riskframe.operators import metrics as M
from riskframe.plans.scoring import evaluated_rows, score

Q = Catalog()


@Q.add(
    "score_fixed_logit",
    f"""
WITH {SCORED_SQL}
SELECT event_id, prediction, probability,
       CASE WHEN probability >= 0.7 THEN 'high_risk' WHEN probability >= 0.4 THEN 'medium_risk' ELSE 'low_risk' END AS band
FROM scored
""",
)
def score_fixed_logit(spark, d):
    events = event_features(load(spark, d, "events"))
    return score(events, probability(), 0.5, "event_id").withColumn("band", X.risk_band("probability"))


@Q.add(
    "score_row_numbers",
    f"WITH {SCORED_SQL} SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_id, prediction, probability FROM scored",
)
def score_row_numbers(spark, d):
    """Rows without an entity are numbered in key order."""
    return score(event_features(load(spark, d, "events")), probability(), 0.5, None, "event_id")


@Q.add("evaluated_rows", f"WITH {SCORED_SQL} SELECT event_id, y AS y_true, prediction, probability FROM scored")
def evaluated(spark, d):
    return evaluated_rows(event_features(load(spark, d, "events")), probability(), "y", "event_id")


BINARY_SQL = f"""
{SCORED_SQL},
c AS (
  SELECT count_if(y = 1 AND prediction = 1) AS tp, count_if(y = 0 AND prediction = 1) AS fp,
         count_if(y = 1 AND prediction = 0) AS fn, count_if(y = 0 AND prediction = 0) AS tn FROM scored
)
"""


@Q.add(
    "binary_metrics",
    f"""
WITH {BINARY_SQL}
SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
FROM c
""",
)
def binary_metrics(spark, d):
    m = M.binary_metrics(scored_events(spark, d), "y", "prediction")
    return m.select(*[r6(c).alias(c) for c in m.columns])


@Q.add(
    "confusion_counts",
    f"""
WITH {BINARY_SQL}
SELECT 0 AS y_true, 0 AS y_pred, CAST(tn AS BIGINT) AS n_rows FROM c UNION ALL SELECT 0, 1, CAST(fp AS BIGINT) FROM c
UNION ALL SELECT 1, 0, CAST(fn AS BIGINT) FROM c UNION ALL SELECT 1, 1, CAST(tp AS BIGINT) FROM c
""",
)
def confusion_counts(spark, d):
    return M.confusion_counts(scored_events(spark, d), "y", "prediction")


AUC_SQL = f"""
{SCORED_SQL},
per_score AS (SELECT run_id, probability, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM scored GROUP BY 1, 2)
"""


@Q.add(
    "roc_auc_gini",
    f"""
WITH {SCORED_SQL},
s AS (SELECT probability, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM scored GROUP BY 1),
w AS (SELECT pos, neg, sum(neg) OVER (ORDER BY probability) - neg AS below FROM s),
a AS (SELECT sum(pos) AS n_pos, sum(neg) AS n_neg, sum(CAST(pos AS DOUBLE) * (below + neg / 2)) / sum(pos) / sum(neg) AS auc FROM w)
SELECT CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, round(auc, 6) AS roc_auc,
       round(greatest(least(2 * auc - 1, 1), -1), 6) AS normalized_gini FROM a
""",
)
def roc_auc_gini(spark, d):
    area = M.roc_auc(scored_events(spark, d), "y", "probability")
    return area.select(
        "n_pos", "n_neg", r6("roc_auc").alias("roc_auc"), r6(M.normalized_gini("roc_auc")).alias("normalized_gini")
    )


@Q.add(
    "roc_auc_by_run",
    f"""
WITH {AUC_SQL},
w AS (SELECT run_id, pos, neg, sum(neg) OVER (PARTITION BY run_id ORDER BY probability) - neg AS below FROM per_score)
SELECT run_id, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       round(sum(CAST(pos AS DOUBLE) * (below + neg / 2)) / nullif(sum(pos) * sum(neg), 0), 6) AS roc_auc
FROM w GROUP BY run_id
""",
)
def roc_auc_by_run(spark, d):
    area = M.roc_auc(scored_events(spark, d), "y", "probability", ["run_id"])
    return area.withColumn("roc_auc", r6("roc_auc"))


CURVE_SQL = f"""
{SCORED_SQL},
s AS (SELECT probability, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM scored GROUP BY 1),
t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM s),
w AS (SELECT probability, sum(pos) OVER (ORDER BY probability DESC) AS tp, sum(neg) OVER (ORDER BY probability DESC) AS fp FROM s)
"""


@Q.add(
    "roc_points",
    f"""
WITH {CURVE_SQL}
SELECT probability AS threshold, round(fp / (SELECT n FROM t), 6) AS fpr, round(tp / (SELECT p FROM t), 6) AS tpr FROM w
UNION ALL SELECT NULL, 0e0, 0e0
""",
)
def roc_points(spark, d):
    points = M.roc_points(scored_events(spark, d), "y", "probability")
    return points.withColumns({"fpr": r6("fpr"), "tpr": r6("tpr")})


@Q.add(
    "roc_corners",
    f"""
WITH {SCORED_SQL},
s AS (SELECT floor(probability * 1000) / 1000 AS p3, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM scored GROUP BY 1),
t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM s),
w AS (SELECT p3, pos, neg, sum(pos) OVER up AS tp, sum(neg) OVER up AS fp, lead(pos) OVER up AS next_pos, lead(neg) OVER up AS next_neg,
             row_number() OVER up AS place FROM s WINDOW up AS (ORDER BY p3 DESC))
SELECT p3 AS threshold, round(fp / (SELECT n FROM t), 6) AS fpr, round(tp / (SELECT p FROM t), 6) AS tpr FROM w
WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT NULL, 0e0, 0e0
""",
)
def roc_corners(spark, d):
    """The curve over scores of three digits, without the points between equal steps."""
    scored = scored_events(spark, d).withColumn("probability", F.floor(F.col("probability") * 1000) / 1000)
    points = M.roc_points(scored, "y", "probability", compact=True)
    return points.withColumns({"fpr": r6("fpr"), "tpr": r6("tpr")})


@Q.add(
    "pr_points",
    f"""
WITH {CURVE_SQL}
SELECT probability AS threshold, round(tp / (tp + fp), 6) AS "precision", round(tp / (SELECT p FROM t), 6) AS recall FROM w
UNION ALL SELECT NULL, 1e0, 0e0
""",
)
def pr_points(spark, d):
    points = M.pr_points(scored_events(spark, d), "y", "probability")
    return points.withColumns({"precision": r6("precision"), "recall": r6("recall")})


_EDGES = " + ".join(f"CASE WHEN probability > {i}e0 * 1e-1 THEN 1 ELSE 0 END" for i in range(1, 10))


@Q.add(
    "calibration_bins",
    f"""
WITH {SCORED_SQL}
SELECT {_EDGES} AS bin, count(*) AS n_rows, round(avg(probability), 6) AS mean_score, round(avg(y), 6) AS observed_rate
FROM scored GROUP BY 1
""",
)
def calibration_bins(spark, d):
    bins = M.calibration_bins(scored_events(spark, d), "y", "probability")
    return bins.withColumns({"mean_score": r6("mean_score"), "observed_rate": r6("observed_rate")})


RUN_METRICS_SQL = f"""
{AUC_SQL},
w AS (SELECT run_id, pos, neg, sum(neg) OVER (PARTITION BY run_id ORDER BY probability) - neg AS below FROM per_score),
area AS (SELECT run_id, sum(CAST(pos AS DOUBLE) * (below + neg / 2)) / nullif(sum(pos) * sum(neg), 0) AS auc FROM w GROUP BY run_id),
c AS (
  SELECT run_id, count_if(y = 1 AND prediction = 1) AS tp, count_if(y = 0 AND prediction = 1) AS fp,
         count_if(y = 1 AND prediction = 0) AS fn, count_if(y = 0 AND prediction = 0) AS tn, max(ts) AS ts
  FROM scored GROUP BY run_id
),
measured AS (
  SELECT run_id, ts, (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS prec,
         coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, auc,
         greatest(least(2 * auc - 1, 1), -1) AS gini
  FROM c JOIN area USING (run_id)
),
run_metrics AS (
  SELECT run_id, ts, 'accuracy' AS metric, round(accuracy, 6) AS value FROM measured
  UNION ALL SELECT run_id, ts, 'precision', round(prec, 6) FROM measured
  UNION ALL SELECT run_id, ts, 'recall', round(recall, 6) FROM measured
  UNION ALL SELECT run_id, ts, 'f1', round(f1, 6) FROM measured
  UNION ALL SELECT run_id, ts, 'roc_auc', round(auc, 6) FROM measured WHERE auc IS NOT NULL
  UNION ALL SELECT run_id, ts, 'normalized_gini', round(gini, 6) FROM measured WHERE auc IS NOT NULL
)
"""

MEASURES = ["accuracy", "precision", "recall", "f1", "roc_auc", "normalized_gini"]


def run_metrics(spark, d):
    """One run per day of events: (run_id, metric, value, ts)."""
    scored = scored_events(spark, d)
    measured = M.evaluate(scored, "y", "prediction", "probability", ["run_id"])
    rounded = measured.select("run_id", *[r6(m).alias(m) for m in MEASURES])
    times = scored.groupBy("run_id").agg(F.max("ts").alias("ts"))
    return M.metrics_table(rounded, "run_id", MEASURES).join(times, "run_id")


@Q.add("run_metrics", f"WITH {RUN_METRICS_SQL} SELECT run_id, metric, value, ts FROM run_metrics")
def run_metrics_query(spark, d):
    return run_metrics(spark, d)
