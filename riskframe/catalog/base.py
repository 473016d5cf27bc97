"""Registration of queries and shared inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions import expr as X

Query = Callable[[SparkSession, str], DataFrame]

LOGIT = {"value": 0.02, "k": -0.01, "is_click": 0.5}
LOGIT_INTERCEPT = -1.0
CANDIDATE = {"value": 0.018, "k": -0.012, "is_click": 0.6}
CANDIDATE_INTERCEPT = -0.9


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = fn
            if sql:
                self.sql[name] = sql
            return fn

        return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_number(ts: str) -> Column:
    return F.unix_date(F.col(ts).cast("date"))


def r6(value: Column | str, digits: int = 6) -> Column:
    return F.round(X._as_col(value), digits)


# (size from which it holds, digits); the shift keeps means of simple fractions, which like to
# end exactly between two roundings, away from that point.
SETTLE_STEPS = ((1e7, 2), (1e3, 5), (0.0, 9))
SETTLE_SHIFT = 0.3137


def settle(value: Column | str) -> Column:
    """Rounded so that the order of summation does not show."""
    value = X._as_col(value).cast("double")
    out = F
    for size, digits in SETTLE_STEPS:
        out = out.when(F.abs(value) >= size, F.round(value + F.lit(SETTLE_SHIFT * 10.0**-digits), digits))
    return out


def settle_sql(expression: str) -> str:
    value = f"CAST({expression} AS DOUBLE)"
    steps = " ".join(
        f"WHEN abs({value}) >= {size!r} THEN round({value} + CAST('{SETTLE_SHIFT * 10.0**-digits!r}' AS DOUBLE), {digits})"
        for size, digits in SETTLE_STEPS
    )
    return f"CASE {steps} END"


def event_features(events: DataFrame) -> DataFrame:
    """Event rows with model inputs and a 0/1 outcome."""
    return events.select(
        "event_id",
        "ts",
        "user_id",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        X.condition_flag(F.col("event_type") == "click").alias("is_click"),
        X.condition_flag(F.col("event_type") == "purchase").alias("y"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
    )


def probability(weights: dict = LOGIT, intercept: float = LOGIT_INTERCEPT) -> Column:
    return F.round(X.logistic(weights, intercept), 6)


def scored_events(spark: SparkSession, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    features = event_features(load(spark, sf_dir, "events"))
    return features.withColumn("probability", probability()).withColumn(
        "prediction", X.decide("probability", threshold)
    )


# The same inputs for SQL.
SCORED_SQL = """
feat AS (
  SELECT event_id, ts, user_id, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_click,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y,
         strftime(ts, '%Y-%m-%d') AS run_id
  FROM events
),
scored AS (
  SELECT *, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM (SELECT *, round(1 / (1 + exp(-(-1e0 + 2e-2 * value - 1e-2 * k + 5e-1 * is_click))), 6) AS probability,
               round(1 / (1 + exp(-(-9e-1 + 1.8e-2 * value - 1.2e-2 * k + 6e-1 * is_click))), 6) AS candidate
        FROM feat)
)
"""
