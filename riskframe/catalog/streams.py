"""Scoring, audit and drift of the event table read as a file stream."""

from pyspark.sql import functions as F

from riskframe.catalog.base import SCORED_SQL, Catalog, event_features, load, probability, r6
from riskframe.catalog.gates import AUDIT_COLUMNS
from riskframe.catalog.monitoring import distance_sql
from riskframe.catalog.quality import EVENT_CONTRACT
from riskframe.operators.contract import Contract
from riskframe.session import scratch_path
from riskframe.streaming import flows as S

Q = Catalog()


def event_stream(spark, d):
    schema = load(spark, d, "events").schema
    return event_features(S.read_file_stream(spark, d, schema, pathGlobFilter="events.parquet"))


@Q.add(
    "stream_score",
    f"""
WITH {SCORED_SQL}
SELECT event_id, prediction, probability, '' AS reasons FROM scored WHERE value <= 150 AND k > 0
UNION ALL SELECT event_id, NULL, NULL, concat_ws(',', CASE WHEN value > 150 THEN 'value:at_most_150' END, CASE WHEN k <= 0 THEN 'k:positive' END)
FROM scored WHERE value > 150 OR k <= 0
""",
)
def stream_score(spark, d):
    """Valid records are scored, the others land with their reasons."""
    out = scratch_path(spark, "stream-score")
    S.score_to_tables(
        event_stream(spark, d), probability(), EVENT_CONTRACT, f"{out}/scored", f"{out}/rejected", f"{out}/checkpoint"
    )
    done = spark.read.parquet(f"{out}/scored").select("event_id", "prediction", "probability", F.lit("").alias("reasons"))
    refused = spark.read.parquet(f"{out}/rejected").select(
        "event_id",
        F.lit(None).cast("int").alias("prediction"),
        F.lit(None).cast("double").alias("probability"),
        F.concat_ws(",", "reasons").alias("reasons"),
    )
    return done.unionByName(refused)


_EXACT = AUDIT_COLUMNS.replace("count(DISTINCT user_id) AS unique_entities, ", "")


@Q.add(
    "stream_audit",
    f"""
WITH {SCORED_SQL}
SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end, {_EXACT}
FROM scored GROUP BY 1, 2
""",
)
def stream_audit(spark, d):
    """Daily audit in complete mode, so no late row is missing; entity counts are approximate and left out."""
    out = scratch_path(spark, "stream-audit")
    scored, _ = S.score_stream(S.zoned(event_stream(spark, d), "ts"), probability(), Contract("events"))
    S.run_to_table(S.audit_stream(scored, "ts", "1 day", None, entity="user_id"), f"{out}/audit", f"{out}/checkpoint", "complete")
    return _audit_rows(spark, f"{out}/audit")


def _audit_rows(spark, path, *exact):
    audit = spark.read.parquet(path)
    audit = audit.drop(*[c for c in ("unique_entities",) if c not in exact])
    return audit.withColumns(
        {
            "window_start": F.col("window_start").cast("timestamp_ntz"),
            "window_end": F.col("window_end").cast("timestamp_ntz"),
            "alert_rate": r6("alert_rate"),
            "probability_mean": r6("probability_mean"),
        }
    )


@Q.add(
    "stream_audit_closed",
    f"""
WITH {SCORED_SQL}, closed AS (SELECT max(ts) - INTERVAL 2 HOUR AS mark FROM scored)
SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end, {AUDIT_COLUMNS}
FROM scored GROUP BY 1, 2 HAVING date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY <= (SELECT mark FROM closed)
""",
)
def stream_audit_closed(spark, d):
    """Daily audit in append mode with a watermark and exact entity counts: the days that the newest event, less two hours, has closed."""
    out = scratch_path(spark, "stream-closed")
    scored, _ = S.score_stream(S.zoned(event_stream(spark, d), "ts"), probability(), Contract("events"))
    audit = S.audit_stream(scored, "ts", "1 day", "2 hours", entity="user_id", exact=True)
    S.run_to_table(audit, f"{out}/audit", f"{out}/checkpoint")
    return _audit_rows(spark, f"{out}/audit", "unique_entities")


@Q.add(
    "stream_requests",
    """
WITH r AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS turn FROM events)
SELECT event_id, user_id, value, CASE WHEN turn > 1 THEN 'user_id:unique' ELSE '' END AS reasons FROM r
""",
)
def stream_requests(spark, d):
    """Arriving events: the first of each user and day is taken, the others are rejected as repeated."""
    out = scratch_path(spark, "stream-requests")
    events = S.zoned(event_stream(spark, d).select("event_id", "ts", "user_id", "value"), "ts")
    S.run_to_table(S.unique_requests(events, "user_id", "ts", "event_id"), f"{out}/judged", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/judged").select("event_id", "user_id", "value", F.concat_ws(",", "reasons").alias("reasons"))


@Q.add(
    "stream_drift",
    f"""
WITH f AS (SELECT value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, ts < TIMESTAMP '2024-01-16' AS early FROM events),
cells AS (
  SELECT 'value' AS col, value AS v, 1 AS ref FROM f WHERE early UNION ALL SELECT 'k', k, 1 FROM f WHERE early
  UNION ALL SELECT 'value', value, 0 FROM f UNION ALL SELECT 'k', k, 0 FROM f
), {distance_sql('col')}
SELECT 0 AS batch_id, count(*) AS n_tested, CAST(count_if(p < 0.05) AS BIGINT) AS n_drifted,
       round(count_if(p < 0.05) / count(*), 4) AS share_drifted_columns, count_if(p < 0.05) / count(*) >= 0.1 AS dataset_drift,
       'threshold_not_met' AS reason, false AS triggered
FROM tested
""",
)
def stream_drift(spark, d):
    """Every arriving batch of events against the first half of the table."""
    out = scratch_path(spark, "stream-drift")
    reference = event_features(load(spark, d, "events")).filter(F.col("ts") < "2024-01-16").select("value", "k")
    query = S.drift_batches(
        event_stream(spark, d).select("value", "k"), reference, f"{out}/history", f"{out}/checkpoint"
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/history").select(
        "batch_id", "n_tested", "n_drifted", "share_drifted_columns", "dataset_drift", "reason", "triggered"
    )
