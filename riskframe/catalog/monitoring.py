"""Drift between parts of a table, drift verdicts and retraining decisions."""

from pyspark.sql import functions as F

from riskframe.catalog.base import Catalog, event_features, load, r6
from riskframe.operators import drift as D

Q = Catalog()

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SPLIT_DAY = "1998-06-01"


def line_parts(spark, d):
    """Lines shipped before and after a day; later discounts are shifted upwards."""
    lines = load(spark, d, "lineitem").select(*LINE_COLUMNS, "l_shipdate", F.lit(1).alias("constant"))
    early = lines.filter(F.col("l_shipdate") < SPLIT_DAY).drop("l_shipdate")
    late = lines.filter(F.col("l_shipdate") >= SPLIT_DAY).drop("l_shipdate")
    return early, late.withColumn("l_discount", F.round(F.col("l_discount") + 0.003, 3))


_VALUES = " UNION ALL ".join(
    f"SELECT '{c}' AS col, CASE WHEN '{c}' = 'l_discount' AND l_shipdate >= TIMESTAMP '{SPLIT_DAY}' "
    f"THEN round(l_discount + 0.003e0, 3) ELSE {c} END AS v, "
    f"CASE WHEN l_shipdate < TIMESTAMP '{SPLIT_DAY}' THEN 1 ELSE 0 END AS ref FROM lineitem"
    for c in LINE_COLUMNS
)


def distance_sql(keys: str) -> str:
    """From cells(keys, v, ref) to the distance per key."""
    return f"""
counts AS (SELECT {keys}, v, sum(ref) AS r, sum(1 - ref) AS c FROM cells WHERE v IS NOT NULL GROUP BY {keys}, v),
placed AS (
  SELECT {keys}, sum(r) OVER (PARTITION BY {keys} ORDER BY v) AS ru, sum(c) OVER (PARTITION BY {keys} ORDER BY v) AS cu,
         sum(r) OVER (PARTITION BY {keys}) AS rn, sum(c) OVER (PARTITION BY {keys}) AS cn FROM counts
),
ks AS (SELECT {keys}, max(abs(ru / rn - cu / cn)) AS ks, CAST(max(rn) AS BIGINT) AS n_ref, CAST(max(cn) AS BIGINT) AS n_cur
       FROM placed GROUP BY {keys}),
sized AS (SELECT *, sqrt(greatest(round_even(CAST(n_ref AS DOUBLE) * n_cur / (CAST(n_ref AS DOUBLE) + n_cur), 0), 1)) AS root FROM ks),
lam AS (SELECT *, ks * root + 1 / (6 * root) + (ks * root - 1) / (4 * root * root) AS l FROM sized),
tested AS (
  SELECT {keys}, ks, n_ref, n_cur,
         CASE WHEN l < 0.2 THEN 1e0 ELSE least(greatest(2 * list_sum([CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END * exp(-2e0 * k * k * l * l)
                                               for k in range(1, 101)]), 0e0), 1e0) END AS p
  FROM lam
)
"""


LINE_KS_SQL = f"WITH cells AS ({_VALUES}), {distance_sql('col')}"


def line_flags(spark, d):
    early, late = line_parts(spark, d)
    return D.drift_report(early, late)


@Q.add(
    "ks_drift",
    f"""{LINE_KS_SQL}
SELECT col AS "column", round(ks, 6) AS ks_statistic, n_ref, n_cur, round(p, 6) AS p_value, p < 0.05 AS drift_detected FROM tested
""",
)
def ks_drift(spark, d):
    flags = line_flags(spark, d).columns
    return flags.withColumns({"ks_statistic": r6("ks_statistic"), "p_value": r6("p_value")})


@Q.add(
    "drift_summary",
    f"""{LINE_KS_SQL}
SELECT count(*) AS n_tested, CAST(count_if(p < 0.05) AS BIGINT) AS n_drifted,
       round(count_if(p < 0.05) / count(*), 4) AS share_drifted_columns,
       count_if(p < 0.05) / count(*) >= 0.1 AS dataset_drift,
       coalesce(string_agg(CASE WHEN p < 0.05 THEN col END, ',' ORDER BY col), '') AS drifted_columns,
       'constant' AS dropped_constant
FROM tested
""",
)
def drift_summary(spark, d):
    report = line_flags(spark, d)
    return report.summary.withColumns(
        {
            "share_drifted_columns": F.round("share_drifted_columns", 4),
            "drifted_columns": F.concat_ws(",", "drifted_columns"),
            "dropped_constant": F.lit(",".join(report.dropped_constant)),
        }
    )


@Q.add(
    "ks_statistic_events",
    f"""
WITH f AS (SELECT value, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k, epoch_us(ts) % 86400000000 AS time_of_day,
                  CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END AS ref FROM events),
cells AS (SELECT 'value' AS col, value AS v, ref FROM f UNION ALL SELECT 'k', k, ref FROM f
          UNION ALL SELECT 'time_of_day', CAST(time_of_day AS DOUBLE), ref FROM f), {distance_sql('col')}
SELECT col AS "column", round(ks, 6) AS ks_statistic, n_ref, n_cur FROM tested
""",
)
def ks_statistic_events(spark, d):
    """Distances over numbers, numbers kept as text, and times of day."""
    events = load(spark, d, "events").select(
        "ts",
        "value",
        F.get_json_object("props", "$.k").alias("k"),
        (F.unix_micros(F.col("ts").cast("timestamp")) % F.lit(86400000000)).alias("time_of_day"),
    )
    first, second = events.filter(F.col("ts") < "2024-01-16"), events.filter(F.col("ts") >= "2024-01-16")
    stats = D.ks_statistic(first, second, ["value", "k", "time_of_day"])
    return stats.withColumn("ks_statistic", r6("ks_statistic"))


@Q.add(
    "drift_report_exact",
    """
WITH f AS (SELECT event_id, value, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k, ts < TIMESTAMP '2024-01-16' AS old FROM events),
sampled AS (SELECT *, row_number() OVER (PARTITION BY old ORDER BY md5(concat('42:', event_id))) AS place FROM f),
cells AS (SELECT col, v, old FROM (SELECT 'value' AS col, value AS v, old FROM sampled WHERE place <= 400
          UNION ALL SELECT 'k', k, old FROM sampled WHERE place <= 400)),
counts AS (SELECT col, v, count_if(old) AS r, count_if(NOT old) AS c FROM cells GROUP BY col, v),
placed AS (SELECT col, abs(sum(r) OVER (PARTITION BY col ORDER BY v) - sum(c) OVER (PARTITION BY col ORDER BY v)) AS h FROM counts),
top AS (SELECT col, CAST(max(h) AS BIGINT) AS h FROM placed GROUP BY col),
terms AS (SELECT col, h, j, CASE WHEN j % 2 = 1 THEN 2e0 ELSE -2e0 END
            * exp(2 * lgamma(401) - lgamma(401 - j * h) - lgamma(401 + j * h)) AS term
          FROM (SELECT col, h, unnest(range(1, 401 // h + 1)) AS j FROM top WHERE h > 0) WHERE j * h <= 400),
tested AS (SELECT col, max(h) AS h, least(sum(term), 1e0) AS p FROM terms GROUP BY col)
SELECT col AS "column", round(h / 400e0, 6) AS ks_statistic, CAST(400 AS BIGINT) AS n_ref, CAST(400 AS BIGINT) AS n_cur,
       round(p, 6) AS p_value, p < 0.05 AS drift_detected
FROM tested
""",
)
def drift_report_exact(spark, d):
    """The report as monitoring runs it on samples of equal size, with exact p-values."""
    events = event_features(load(spark, d, "events"))
    first, second = events.filter(F.col("ts") < "2024-01-16"), events.filter(F.col("ts") >= "2024-01-16")
    report = D.drift_report(
        first, second, features=["value", "k"], target="y", entity="event_id",
        reference_rows=400, current_rows=400, sample_key="event_id", method="exact",
    )
    return report.columns.withColumns({"ks_statistic": r6("ks_statistic"), "p_value": r6("p_value")})


HALF_COLUMNS = ["value", "k", "is_click"]
_HALVES_SQL = """
f AS (SELECT event_id, value, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k,
             CASE WHEN event_type = 'click' THEN 1e0 ELSE 0e0 END AS is_click, ts < TIMESTAMP '2024-01-16' AS old FROM events)
"""


def event_halves(spark, d):
    events = event_features(load(spark, d, "events"))
    return events.filter(F.col("ts") < "2024-01-16"), events.filter(F.col("ts") >= "2024-01-16")


def _half_cells(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col, {c} AS v, CASE WHEN old THEN 1 ELSE 0 END AS ref FROM {table}" for c in HALF_COLUMNS
    )


@Q.add(
    "drift_report_events",
    f"""
WITH {_HALVES_SQL}, cells AS ({_half_cells("f")}), {distance_sql('col')}
SELECT col AS "column", round(ks, 6) AS ks_statistic, n_ref, n_cur, round(p, 6) AS p_value, p < 0.05 AS drift_detected FROM tested
""",
)
def drift_report_events(spark, d):
    """The report over all rows of both halves."""
    report = D.drift_report(*event_halves(spark, d), features=HALF_COLUMNS, target="y", entity="event_id")
    return report.columns.withColumns({"ks_statistic": r6("ks_statistic"), "p_value": r6("p_value")})


@Q.add(
    "drift_report_halves",
    f"""
WITH {_HALVES_SQL},
size AS (SELECT CAST(least(count_if(old), count_if(NOT old)) AS BIGINT) AS n FROM f),
sampled AS (SELECT *, row_number() OVER (PARTITION BY old ORDER BY md5(concat('42:', event_id))) AS place FROM f),
equal AS (SELECT * FROM sampled WHERE place <= (SELECT n FROM size)),
cells AS ({_half_cells("equal")}),
counts AS (SELECT col, v, sum(ref) AS r, sum(1 - ref) AS c FROM cells GROUP BY col, v),
placed AS (SELECT col, abs(sum(r) OVER (PARTITION BY col ORDER BY v) - sum(c) OVER (PARTITION BY col ORDER BY v)) AS h FROM counts),
top AS (SELECT col, n, CAST(max(h) AS BIGINT) AS h FROM placed, size GROUP BY col, n),
terms AS (SELECT col, CASE WHEN j % 2 = 1 THEN 2e0 ELSE -2e0 END
            * exp(2 * lgamma(n + 1) - lgamma(n + 1 - j * h) - lgamma(n + 1 + j * h)) AS term
          FROM (SELECT col, n, h, unnest(range(1, n // h + 1)) AS j FROM top WHERE h > 0)),
sums AS (SELECT col, least(sum(term), 1e0) AS p FROM terms GROUP BY col)
SELECT col AS "column", round(h / CAST(n AS DOUBLE), 6) AS ks_statistic, n AS n_ref, n AS n_cur,
       round(coalesce(p, 1e0), 6) AS p_value, coalesce(p, 1e0) < 0.05 AS drift_detected
FROM top LEFT JOIN sums USING (col)
""",
)
def drift_report_halves(spark, d):
    """Exact p-values: the smaller half whole, and as many rows of the other."""
    first, second = event_halves(spark, d)
    rows = min(first.count(), second.count())
    report = D.drift_report(
        first, second, features=HALF_COLUMNS, target="y", entity="event_id",
        reference_rows=rows, current_rows=rows, sample_key="event_id", method="exact",
    )
    return report.columns.withColumns({"ks_statistic": r6("ks_statistic"), "p_value": r6("p_value")})


WEEK_SQL = """
week AS (SELECT *, least((CAST(date_part('day', ts) AS BIGINT) - 1) // 7, 3) AS batch FROM events),
moved AS (SELECT batch, value * (1 + batch * 0.05e0) AS value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k,
                 CAST(epoch_us(ts) % 86400000000 AS DOUBLE) AS time_of_day FROM week)
"""


def weekly_flags(spark, d, columns=("value", "k")):
    """Each later week of events against the first; values grow by five percent a week."""
    events = load(spark, d, "events")
    batch = F.least(F.floor((F.dayofmonth("ts") - 1) / 7), F.lit(3)).cast("long")
    weeks = events.select(
        batch.alias("batch"),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        (F.unix_micros(F.col("ts").cast("timestamp")) % F.lit(86400000000)).cast("double").alias("time_of_day"),
    ).withColumn("value", F.col("value") * (F.lit(1) + F.col("batch") * F.lit(0.05)))
    distances = D.ks_statistic_by(weeks, list(columns), "batch", F.col("batch") == 0)
    return D.drift_flags(D.ks_pvalue(distances))


def weekly_sql(columns=("value", "k")):
    cells = " UNION ALL ".join(
        f"SELECT b, '{c}' AS col, {c} AS v, 1 AS ref FROM later, moved WHERE batch = 0 "
        f"UNION ALL SELECT batch, '{c}', {c}, 0 FROM moved WHERE batch > 0"
        for c in columns
    )
    return f"""
WITH {WEEK_SQL},
later AS (SELECT unnest([1, 2, 3]) AS b),
cells AS ({cells}), {distance_sql('b, col')},
summary AS (
  SELECT CAST(b AS BIGINT) AS batch, count(*) AS n_tested, CAST(count_if(p < 0.05) AS BIGINT) AS n_drifted,
         count_if(p < 0.05) / count(*) AS share_drifted_columns, count_if(p < 0.05) / count(*) >= 0.1 AS dataset_drift
  FROM tested GROUP BY b
)
"""


_WEEKLY_SQL = weekly_sql()
_SUMMARY_COLUMNS = "batch, n_tested, n_drifted, round(share_drifted_columns, 4) AS share_drifted_columns, dataset_drift"


def _decision_sql(weekly: str, threshold: str) -> str:
    hit = f"dataset_drift AND share_drifted_columns >= {threshold}"
    return f"""{weekly}
SELECT {_SUMMARY_COLUMNS}, CASE WHEN {hit} THEN 'dataset_drift' ELSE 'threshold_not_met' END AS reason,
       {hit} AS triggered, CASE WHEN {hit} THEN 'retrain' END AS command
FROM summary
"""


def _weekly_decision(spark, d, columns=("value", "k"), **options):
    summary = D.drift_summary(weekly_flags(spark, d, columns), by=["batch"]).drop("drifted_columns")
    decided = D.retrain_decision(summary, command="retrain", **options)
    return decided.withColumn("share_drifted_columns", F.round("share_drifted_columns", 4))


@Q.add("retrain_decision", _decision_sql(_WEEKLY_SQL, "0.3e0"))
def retrain_decision(spark, d):
    return _weekly_decision(spark, d, auto_retrain=True)


@Q.add("retrain_thirds", _decision_sql(weekly_sql(("value", "k", "time_of_day")), "1e0 / 3"))
def retrain_thirds(spark, d):
    """One drifted column of three meets a threshold of one third, which its rounded share would miss."""
    return _weekly_decision(spark, d, ("value", "k", "time_of_day"), auto_retrain=True, threshold=1 / 3)


@Q.add(
    "retrain_forced",
    f"{_WEEKLY_SQL} SELECT {_SUMMARY_COLUMNS}, 'manual_override' AS reason, true AS triggered, 'retrain' AS command FROM summary",
)
def retrain_forced(spark, d):
    return _weekly_decision(spark, d, auto_retrain=False, force=True)


@Q.add(
    "constant_columns",
    f"""
WITH early AS (SELECT *, 1 AS constant FROM lineitem WHERE l_shipdate < TIMESTAMP '{SPLIT_DAY}')
SELECT "column" FROM ({" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS kinds FROM early"
        for c in (*LINE_COLUMNS, "constant"))}) WHERE coalesce(kinds, 0) <= 1
""",
)
def constant_columns(spark, d):
    early, _ = line_parts(spark, d)
    found = D.constant_columns(early, early.columns)
    return spark.createDataFrame([(c,) for c in found], "column string")


@Q.add(
    "drift_metrics_row",
    f"""{LINE_KS_SQL}
SELECT 'lines before' AS reference_path, 'lines after' AS current_path, count(*) AS n_tested,
       CAST(count_if(p < 0.05) AS BIGINT) AS n_drifted, round(count_if(p < 0.05) / count(*), 4) AS share_drifted_columns,
       count_if(p < 0.05) / count(*) >= 0.1 AS dataset_drift,
       coalesce(string_agg(CASE WHEN p < 0.05 THEN col END, ',' ORDER BY col), '') AS drifted_columns
FROM tested
""",
)
def drift_metrics_row(spark, d):
    row = D.drift_metrics_row(line_flags(spark, d).summary, "lines before", "lines after")
    return row.drop("generated_at").withColumn("drifted_columns", F.concat_ws(",", "drifted_columns"))
