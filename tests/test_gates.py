import pytest
from pyspark.sql import functions as F

from riskframe.operators import audit as A
from riskframe.operators import gates as G


@pytest.fixture
def runs(spark):
    rows = [("a", "roc_auc", 0.8, 1), ("a", "precision", 0.3, 1), ("b", "roc_auc", 0.6, 2), ("b", "precision", 0.3, 2), ("c", "precision", 0.1, 3)]
    return spark.createDataFrame(rows, "run_id string, metric string, value double, ts int")


def test_metric_gate(runs):
    got = {r["run_id"]: tuple(r)[1:] for r in G.metric_gate(runs, {"roc_auc": 0.7, "precision": 0.2}).collect()}
    assert got == {"a": ("", "", "passed"), "b": ("", "roc_auc", "failed"), "c": ("roc_auc", "precision", "failed")}
    assert {r["status"] for r in G.metric_gate(runs, {}).collect()} == {"passed"}


def test_reconcile(spark):
    schema = "run_id string, metric string, value double"
    a = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 1.0), ("a", "z", 1.0)], schema)
    b = spark.createDataFrame([("a", "x", 1.0004), ("a", "y", 1.1), ("a", "w", 1.0)], schema)
    assert {r["metric"]: r["status"] for r in G.metric_reconcile(a, b).collect()} == {
        "x": "match", "y": "mismatch", "z": "missing", "w": "missing",
    }


def test_tags(spark):
    tags = spark.createDataFrame([("a", "stage", "pd"), ("a", "team", "x"), ("b", "team", "y")], "run_id string, tag string, value string")
    got = {r[0]: r[1] for r in G.tag_reconcile(tags, {"stage": "pd", "team": "x"}).collect()}
    assert got == {"a": "", "b": "stage,team"}


@pytest.mark.parametrize(
    "statuses, want",
    [(["passed", "skipped"], "passed"), (["skipped", "skipped"], "skipped"), (["passed", "failed", "skipped"], "failed")],
)
def test_aggregate_status(spark, statuses, want):
    checks = spark.createDataFrame([("r", s) for s in statuses], "run_id string, status string")
    assert G.aggregate_status(checks).first()["status"] == want


def test_promotion(runs):
    stages = lambda **k: {r["run_id"]: r["stage"] for r in G.promotion_decision(runs, **k).collect()}
    assert stages() == {"a": "Staging", "b": None, "c": None}
    assert stages(minimum=None) == {"a": "Staging", "b": "Staging", "c": None}
    assert stages(metric=None) == {"a": "Staging", "b": "Staging", "c": "Staging"}
    assert G.latest_run(G.promotion_decision(runs)).first()["run_id"] == "c"


def test_canary(spark):
    df = spark.createDataFrame([(0.2, 0.2, 0.9), (0.6, 0.61, 0.9)], "prod double, near double, far double")
    same = G.canary_compare(df, "prod", "near", 0.5).first()
    assert same["status"] == "passed" and same["records_compared"] == 2
    assert same["production_std_probability"] == pytest.approx(0.2)  # population deviation
    assert G.canary_compare(df, "prod", "far", 0.5).first()["status"] == "failed"
    skipped = G.canary_compare(df, None, "far", 0.5).first()
    assert (skipped["status"], skipped["reason"]) == ("skipped", "production_missing")


def test_audit(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (1, 0.5, 1), (2, 0.1, 0)], "e int, probability double, prediction int")
    row = A.inference_audit(df, entity="e").first().asDict()
    assert row == {
        "entity_count": 3, "positive_decisions": 2, "alert_rate": pytest.approx(2 / 3), "unique_entities": 2,
        "band_high_risk": 1, "band_medium_risk": 1, "band_low_risk": 1, "probability_mean": pytest.approx(0.5),
    }
    hard = A.inference_audit(df, probability=None).first()
    assert (hard["band_high_risk"], hard["band_medium_risk"], hard["band_low_risk"], hard["unique_entities"]) == (2, 0, 1, 3)
    empty = A.inference_audit(df.filter(F.lit(False)), entity="e").first()
    assert (empty["entity_count"], empty["alert_rate"], empty["band_low_risk"]) == (0, 0.0, 0)
    assert [r["e"] for r in A.prediction_sample(df, "e", 1).collect()] == [1]


def test_a_run_is_promoted_only_when_all_checks_pass(spark):
    rows = [(r, m, v, i) for i, r in enumerate("abcd") for m, v in (("roc_auc", 0.8), ("recall", 0.2 if r == "b" else 0.5))]
    metrics = spark.createDataFrame(rows, "run_id string, metric string, value double, ts long")
    reported = metrics.withColumn("value", F.when((F.col("run_id") == "c") & (F.col("metric") == "recall"), 0.9).otherwise(F.col("value")))
    tags = spark.createDataFrame([(r, "owner", "x" if r != "d" else "y") for r in "abcd"], "run_id string, tag string, value string")
    checks = G.run_checks(metrics, reported, tags, {"owner": "x"}, {"recall": 0.4})
    got = {r["run_id"]: (r["status"], r["stage"]) for r in G.validated_promotion(metrics, checks).collect()}
    assert got == {"a": ("passed", "Staging"), "b": ("failed", None), "c": ("failed", None), "d": ("failed", None)}
    skipped = {(r["run_id"], r["check"]): r["status"] for r in G.run_checks(metrics, minimums={"recall": 0.1}).collect()}
    assert skipped[("a", "agreement")] == skipped[("a", "tags")] == "skipped" and skipped[("b", "thresholds")] == "passed"


def test_canary_of_two_models(spark):
    from riskframe.plans.flows import canary

    table = spark.createDataFrame([(i, i / 10) for i in range(10)], "id long, x double")
    row = canary(table, F.col("x"), F.col("x")).first()
    assert row["status"] == "passed" and row["records_compared"] == 10
    assert canary(table, F.col("x"), None).first()["status"] == "skipped"
    with pytest.raises(RuntimeError):
        canary(table, F.lit(0.9), F.col("x"), must_pass=True)
