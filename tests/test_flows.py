import pytest
from pyspark.sql import functions as F

from riskframe.catalog.loans import loan_tables
from riskframe.plans import flows
from riskframe.plans import loan_features as L
from tests.conftest import DATA


@pytest.fixture(scope="module")
def built(spark):
    return flows.build_feature_store(loan_tables(spark, DATA), required=["AGE_YEARS", "CC_UTIL_MEAN"])


def test_feature_store_and_lineage(spark, built):
    features, lineage = built
    rows = {r["table"]: r for r in lineage.collect()}
    assert rows["feature_store"]["n_rows"] == features.count() == 150
    assert set(rows) == {*L.RAW_CONTRACTS, "feature_store"}
    assert set(L.model_columns()) <= set(features.columns)


def test_raw_contract_stops_the_build(spark):
    tables = loan_tables(spark, DATA)
    broken = L.LoanTables(**(vars(tables) | {"bureau": tables.bureau.withColumn("AMT_CREDIT_SUM", F.lit(-1.0))}))
    with pytest.raises(ValueError, match="AMT_CREDIT_SUM non_negative"):
        flows.build_feature_store(broken)


def test_split_train_validate_monitor(built):
    features, _ = built
    train, test = flows.split_feature_store(features)
    assert (train.count(), test.count()) == (120, 30)
    columns = ["AMT_CREDIT", "AMT_INCOME_TOTAL", "AGE_YEARS", "BUREAU_UTIL_MEAN"]
    run = flows.train_and_evaluate(train, test, columns, kind="logistic", smote_ratio=0.2, run_id="r1")
    got = {r["metric"]: r["value"] for r in run.metrics.collect()}
    assert set(got) == set(flows.MEASURES) and run.evaluated.count() == 30
    assert flows.validate_runs(run.metrics, {"accuracy": 0.0}).first()["status"] == "passed"
    with pytest.raises(RuntimeError, match="r1"):
        flows.validate_runs(run.metrics, {"accuracy": 1.1})
    report, row = flows.monitor_production(train, test, features=columns, force=True, command="retrain")
    assert report.columns.count() == 4 and row.first()["reason"] == "manual_override"


def test_bad_matrix_is_refused(built):
    features, _ = built
    holes = features.withColumn("AGE_YEARS", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="missing_cells"):
        flows.train_and_evaluate(holes, holes, ["AGE_YEARS"], kind="logistic")


def test_stored_tables_go_with_their_owner(spark):
    from pathlib import Path

    from riskframe.operators.storage import stored
    from riskframe.session import scratch_tables, shared_folder

    kept = stored(spark.range(3), "kept")
    before = set(Path(shared_folder(spark).removeprefix("file:")).iterdir())
    with scratch_tables(spark):
        assert stored(spark.range(5), "gone").count() == 5
        assert set(Path(shared_folder(spark).removeprefix("file:")).iterdir()) > before
    assert set(Path(shared_folder(spark).removeprefix("file:")).iterdir()) == before
    assert kept.count() == 3
