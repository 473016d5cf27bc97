import datetime as dt

import pytest
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from riskframe.catalog import training as catalog
from riskframe.functions.expr import logistic
from riskframe.operators import contract as K
from riskframe.operators.metrics import evaluate
from riskframe.plans import training as T
from riskframe.plans.scoring import add_scores, evaluated_rows, score
from riskframe.session import scratch_path
from riskframe.streaming import flows as S
from tests.conftest import DATA

FEATURES = ["feature_1", "feature_2"]


@pytest.fixture(scope="module")
def table(spark):
    noise = F.abs(F.hash("id")) % 100 / 100
    base = spark.range(400).select(
        F.col("id").alias("SK_ID_CURR"), (F.col("id") / 100).alias("feature_1"), noise.alias("feature_2")
    )
    return base.withColumn("TARGET", (F.col("feature_1") + F.col("feature_2") > 2.5).cast("int"))


@pytest.mark.parametrize("kind, params", [("logistic", {}), ("gbt", {"maxIter": 3}), ("forest", {"numTrees": 5})])
def test_train_save_load_score(spark, table, kind, params):
    model = T.train(table, FEATURES, "TARGET", kind, params)
    path = scratch_path(spark, "model")
    T.save_model(model, path)
    first = score(table, model, 0.4, "SK_ID_CURR").orderBy("SK_ID_CURR").collect()
    assert first == score(table, T.load_model(path), 0.4, "SK_ID_CURR").orderBy("SK_ID_CURR").collect()
    assert all(r["prediction"] == int(r["probability"] >= 0.4) for r in first)
    row = evaluate(evaluated_rows(table, model, "TARGET", "SK_ID_CURR"), "y_true", "prediction", "probability").first()
    assert row["roc_auc"] > 0.95 and row["normalized_gini"] == pytest.approx(2 * row["roc_auc"] - 1)


def test_training_refusals(table):
    with pytest.raises(ValueError, match="unsupported model kind"):
        T.train(table, FEATURES, "TARGET", "svm")
    with pytest.raises(ValueError, match="lacks columns: feature_9"):
        T.train(table, ["feature_9"], "TARGET", "logistic")


def test_groups_of_equal_bins_are_scored_once(spark, monkeypatch):
    monkeypatch.setattr(T, "GROUP_FROM", 1000)
    cells = {"feature_1": (F.col("id") % 400) / 10, "feature_2": (F.col("id") % 7).cast("double")}
    rows = spark.range(6000).withColumns(cells).withColumn("TARGET", (F.col("feature_1") + F.col("feature_2") > 20).cast("int"))
    model = T.train(rows, FEATURES, "TARGET", "forest", {"numTrees": 5})
    assert any(isinstance(step, Bucketizer) for step in model.stages)
    scored = add_scores(rows, model, 0.4)
    assert "Aggregate" in scored._jdf.queryExecution().optimizedPlan().toString()
    assert scored.columns == [*rows.columns, "probability", "prediction"]
    plain = {r["id"]: r["probability"][1] for r in model.transform(rows).select("id", "probability").collect()}
    got = scored.collect()
    assert len(got) == 6000 and {r["id"]: r["probability"] for r in got} == plain and len(set(plain.values())) > 5
    assert all(r["prediction"] == int(r["probability"] >= 0.4) for r in got)
    twice = add_scores(scored.withColumnsRenamed({"probability": "live", "prediction": "decision"}), model, 0.4)
    assert twice.filter("live = probability and decision = prediction").count() == 6000


def test_parts_of_the_events_are_parsed_once(spark):
    for part in catalog._parts(spark, DATA):
        assert "get_json_object" not in part._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_entity_are_numbered(table):
    model = logistic({"feature_1": 1.0}, -2.0)
    got = score(table.drop("SK_ID_CURR"), model, 0.5, "SK_ID_CURR", order_key="feature_1")
    assert got.columns == ["row_id", "prediction", "probability"]
    assert [r["row_id"] for r in got.orderBy("probability").collect()] == list(range(400))
    with pytest.raises(ValueError, match="order_key"):
        score(table.drop("SK_ID_CURR"), model)


CONTRACT = K.Contract("payload", {"feature_1": K.Field(nullable=False, rules=(K.NON_NEGATIVE,)), "feature_2": K.Field(nullable=False)})
SCHEMA = "SK_ID_CURR long, feature_1 double, feature_2 double, ts timestamp"


@pytest.fixture
def arrivals(spark, tmp_path):
    """Four files, one per day, in time order; one bad record a day."""
    for day in range(1, 5):
        rows = [(day * 100 + i, float(i), 0.5, dt.datetime(2024, 1, day, i)) for i in range(10)]
        rows.append((day * 100 + 99, -1.0 if day % 2 else None, 0.5, dt.datetime(2024, 1, day, 12)))
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    return str(tmp_path / "in")


def test_stream_scores_or_rejects(spark, arrivals, tmp_path):
    stream = S.read_file_stream(spark, arrivals, spark.createDataFrame([], SCHEMA).schema, "json", 1)
    model = logistic({"feature_1": 1.0, "feature_2": 1.0}, -5.0)
    good, bad = S.score_stream(stream, model, CONTRACT)
    S.run_to_table(good, str(tmp_path / "good"), str(tmp_path / "c1"))
    S.run_to_table(bad, str(tmp_path / "bad"), str(tmp_path / "c2"))
    scored = spark.read.parquet(str(tmp_path / "good"))
    assert scored.count() == 40 and scored.filter("(probability >= 0.5) <> (prediction = 1)").count() == 0
    reasons = [r["reasons"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()]
    assert sorted(map(tuple, reasons)) == [("feature_1:non_negative",)] * 2 + [("feature_1:not_null",)] * 2
    with pytest.raises(ValueError, match="lacks declared columns"):
        S.score_stream(stream.drop("feature_2"), model, CONTRACT)


def test_one_pass_writes_both_tables_and_a_replay_changes_nothing(spark, arrivals, tmp_path):
    model = logistic({"feature_1": 1.0, "feature_2": 1.0}, -5.0)
    for checkpoint in ("c1", "c2"):  # a lost checkpoint replays every batch
        stream = S.read_file_stream(spark, arrivals, spark.createDataFrame([], SCHEMA).schema, "json", 1)
        S.score_to_tables(stream, model, CONTRACT, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / checkpoint))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 40
    assert spark.read.parquet(str(tmp_path / "bad")).filter("size(reasons) = 1").count() == 4


def test_append_audit_leaves_only_the_open_window(spark, arrivals, tmp_path):
    stream = S.read_file_stream(spark, arrivals, spark.createDataFrame([], SCHEMA).schema, "json", 1)
    scored, _ = S.score_stream(stream, logistic({"feature_1": 1.0}, -5.0), CONTRACT)
    audit = S.audit_stream(scored, "ts", "1 day", "1 hour", entity="SK_ID_CURR")
    S.run_to_table(audit, str(tmp_path / "out"), str(tmp_path / "c"))
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r["window_start"].day, r["entity_count"], r["positive_decisions"], r["unique_entities"]) for r in rows] == [
        (d, 10, 5, 10) for d in (1, 2, 3)
    ]


def test_drift_per_batch_and_replay(spark, arrivals, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    reference = spark.createDataFrame([(float(i) + 50, i / 10) for i in range(40)], "feature_1 double, feature_2 double")
    seen = []
    for _ in range(2):  # the second start finds nothing new
        stream = S.read_file_stream(spark, arrivals, schema, "json", 1).select("feature_1", "feature_2")
        S.drift_batches(
            stream, reference, str(tmp_path / "h"), str(tmp_path / "c"), auto_retrain=True, notify=lambda row, i: seen.append(i)
        ).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "h")).collect()
    assert len(rows) == 4 and seen == [0, 1, 2, 3]
    assert all(r["triggered"] and r["reason"] == "dataset_drift" for r in rows)


def test_exact_entities_per_window(spark, tmp_path):
    """Entities repeat across files of the same day, and one has no id."""
    schema = "SK_ID_CURR long, feature_1 double, ts timestamp"
    for part in range(6):
        day = 1 + part // 2
        rows = [(i % 4 if i < 8 else None, float(i), dt.datetime(2024, 1, day, 2 * part % 4 + i // 5)) for i in range(10)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = S.read_file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, "json", 1)
    scored, _ = S.score_stream(stream, logistic({"feature_1": 1.0}, -5.0), K.Contract("none"))
    audit = S.audit_stream(scored, "ts", "1 day", "1 hour", entity="SK_ID_CURR", exact=True)
    S.run_to_table(audit, str(tmp_path / "out"), str(tmp_path / "c"))
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r["window_start"].day, r["entity_count"], r["positive_decisions"], r["unique_entities"]) for r in rows] == [
        (1, 20, 10, 4), (2, 20, 10, 4),
    ]
    assert rows[0]["band_high_risk"] + rows[0]["band_medium_risk"] + rows[0]["band_low_risk"] == 20
    with pytest.raises(ValueError, match="watermark"):
        S.audit_stream(scored, "ts", "1 day", None, entity="SK_ID_CURR", exact=True)


def test_requests_repeated_late_and_without_id(spark, tmp_path):
    schema = "id long, n long, big long, ts timestamp"
    at = lambda day, hour: dt.datetime(2024, 1, day, hour)
    big = 2**60 + 1
    files = [
        [(1, 0, big, at(1, 5)), (1, 1, None, at(1, 3)), (2, 2, big, at(1, 4)), (None, 3, big, at(1, 4)), (1, 4, 1, at(1, 3))],
        [(1, 5, 1, at(1, 1)), (1, 6, 1, at(2, 0)), (3, 7, 1, at(3, 5))],  # seen before; another day; moves the watermark on
        [(2, 8, 1, at(1, 9)), (9, 9, 1, at(1, 9)), (None, 13, 1, at(1, 9)), (3, 10, 1, at(3, 2))],  # closes the first day
        [(3, 11, 1, at(4, 6)), (3, 12, 1, at(3, 23)), (2, 14, 1, at(1, 9)), (8, 15, 1, at(1, 9))],  # the last two are too late
    ]
    for i, rows in enumerate(files):
        folder = str(tmp_path / "in")
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(folder)
    stream = S.read_file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, "json", 1)
    judged = S.unique_requests(stream, "id", "ts", "n", "1 day", "1 hour")
    S.run_to_table(judged, str(tmp_path / "out"), str(tmp_path / "c"))
    rows = {r["n"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    again, absent = ["id:unique"], ["id:not_null"]
    want = {0: again, 1: [], 2: [], 3: absent, 4: again, 5: again, 6: [], 7: [], 8: again, 9: [], 10: again, 11: [], 12: again, 13: absent}
    assert {n: r["reasons"] for n, r in rows.items()} == want
    assert rows[0]["big"] == big and rows[1]["big"] is None and rows[0]["ts"] == at(1, 5)
    with pytest.raises(ValueError, match="cannot be carried"):
        S.unique_requests(stream.withColumn("list", F.array("id")), "id", "ts", "n")


def test_requests_of_many_entities_take_few_groups_and_their_state_goes(spark, tmp_path):
    at = lambda day, n: dt.datetime(2024, 1, day, n % 24, n % 60)
    files = [
        [(n % 300, n, at(1, 7 * n)) for n in range(900)],
        [(n % 400, n, at(1, 5 * n)) for n in range(900, 2100)],  # seen before, but for a hundred
        [(n % 300, n, at(2, 3 * n)) for n in range(2100, 2700)],
        [(5, 2700, at(5, 0))],
        [(5, 2701, at(9, 0))],
    ]
    schema = "id long, n long, ts timestamp"
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = S.read_file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, "json", 1)
    judged = S.unique_requests(stream, "id", "ts", "n", "1 day", "1 hour", shares=4)
    query = judged.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    query = query.format("parquet").start(str(tmp_path / "out"))
    query.awaitTermination()
    got = {r["n"]: r["reasons"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    first: dict = {}
    for rows in files:  # batch after batch, in each by time
        for entity, n, ts in sorted(rows, key=lambda r: (r[2], r[1])):
            first.setdefault((entity, ts.day), n)
    assert got == {n: [] if first[entity, ts.day] == n else ["id:unique"] for rows in files for entity, n, ts in rows}
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(states) <= 2 * 4 and states[-1] <= 1  # groups of two open days; at the end nothing but the last one
