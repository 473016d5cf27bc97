import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from riskframe.operators import encode, sparse
from riskframe.operators.metrics import evaluate
from riskframe.plans import sparse_logistic, training
from riskframe.plans.scoring import add_scores, evaluated_rows
from riskframe.session import scratch_path

ROWS = [(0, "b", "x", 1.0), (1, "a", None, 2.0), (2, None, None, 3.0), (3, "b", "é", 4.0), (4, "", "x", 5.0), (5, "b", "x", 6.0)]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id long, c string, `d.e` string, v double")


def test_levels_are_numbered_column_by_column_in_order(spark):
    levels = sparse.fit_levels(table(spark), ["c", "d.e"])
    rows = sorted((r["place"], r["column"], r["value"], r["n"]) for r in levels.table.collect())
    assert rows == [(0, "c", "", 1), (1, "c", "a", 1), (2, "c", "b", 3), (3, "d.e", "x", 3), (4, "d.e", "é", 1)]
    assert levels.sizes == {"c": 3, "d.e": 2} and levels.width == 5 and levels.n_rows == 6


@pytest.mark.parametrize("few", [0, 10_000])
@pytest.mark.parametrize("hot", [0.01, 0.4, 1.0])
def test_vectors_by_broadcast_and_by_shuffle(spark, monkeypatch, few, hot):
    monkeypatch.setattr(sparse, "HOT_SHARE", hot)
    levels = sparse.fit_levels(table(spark), ["c", "d.e"])
    unseen = table(spark, [*ROWS, (6, "new", "x", 0.0)])
    got = {r["id"]: r["features"] for r in sparse.sparse_vectors(unseen, levels, few_levels=few).collect()}
    want = {0: [2, 3], 1: [1], 2: [], 3: [2, 4], 4: [0, 3], 5: [2, 3], 6: [3]}
    assert got == {i: SparseVector(5, places, [1.0] * len(places)) for i, places in want.items()}


def test_equals_dense_one_hot(spark):
    df = spark.range(500).select("id", F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(37))).alias("k"), (F.col("id") % 3).cast("string").alias("m"))
    dense = encode.one_hot(df, encode.read_vocabulary(encode.fit_vocabulary(df, ["k", "m"])))
    names = [f"`{c}`" for c in dense.columns if c != "id"]
    want = {r["id"]: r["flags"] for r in dense.select("id", F.array(*names).alias("flags")).collect()}
    levels = sparse.fit_levels(df, ["k", "m"])
    got = {r["id"]: r["features"].toArray().astype(int).tolist() for r in sparse.sparse_vectors(df, levels, few_levels=5).collect()}
    assert got == want


def test_a_sparse_model_scores_as_the_dense_one(spark):
    df = spark.range(2000).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(12)).cast("string").alias("k"), (F.hash("id") % 100 / 10).alias("v")
    )
    chance = F.pmod(F.hash(F.lit("y"), "id"), F.lit(100)) < 30 + 5 * F.col("k").cast("int") + F.col("v")
    df = df.withColumn("y", chance.cast("int")).cache()
    dense = encode.one_hot(df, encode.read_vocabulary(encode.fit_vocabulary(df, ["k"])))
    exact = {"tol": 1e-10}
    columns = ["v", *[c for c in dense.columns if c.startswith("k_")]]
    a = add_scores(dense, training.train(dense, columns, "y", "logistic", exact), 0.5).select("id", "probability")
    model = training.train_sparse(df, ["v"], ["k"], "y", "logistic", exact)
    b = add_scores(df, model, 0.5)
    assert b.columns == [*df.columns, "prediction", "probability"] or set(b.columns) == {*df.columns, "prediction", "probability"}
    b = b.select("id", F.col("probability").alias("p"))
    assert a.join(b, "id").agg(F.max(F.abs(F.col("probability") - F.col("p")))).first()[0] < 1e-5


def test_a_hundred_thousand_levels_train_a_model(spark):
    df = spark.range(400_000).select("id", (F.col("id") % 100_000).cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    df = df.withColumn("y", (F.pmod(F.xxhash64("k"), F.lit(2)) == 0).cast("int"))
    train, test = df.filter("id < 300000"), df.filter("id >= 300000")
    model = training.train_sparse(train, ["v"], ["k"], "y", params={"maxIter": 10})
    assert model.levels.width == 100_000
    path = scratch_path(spark, "sparse")
    model.save(path)
    rows = evaluated_rows(test, training.SparseModel.load(spark, path), "y", "id")
    assert evaluate(rows, "y_true", "prediction", "probability").first()["roc_auc"] > 0.99


def test_no_columns_empty_tables_and_clashes(spark):
    empty = sparse.fit_levels(table(spark, []), ["c"])
    assert empty.sizes == {"c": 0} and empty.width == 0 and empty.table.count() == 0
    assert [r["features"].indices.tolist() for r in sparse.sparse_vectors(table(spark), empty).collect()] == [[]] * 6
    assert sparse.fit_levels(table(spark), []).width == 0
    with pytest.raises(ValueError):
        sparse.encode_levels(table(spark), empty, "v")
    with pytest.raises(ValueError):
        sparse.fit_levels(table(spark), ["c", "c"])


def test_deviation_is_that_of_the_flags(spark):
    levels = sparse.fit_levels(table(spark), ["c"])
    got = {r["value"]: r["s"] for r in levels.table.select("value", sparse.deviation(levels).alias("s")).collect()}
    flags = {v: np.std([r[1] == v for r in ROWS]) for v in ("", "a", "b")}
    assert all(abs(got[v] - flags[v]) < 1e-12 for v in flags)


def test_places_of_a_wide_vector_are_not_named_in_the_schema(spark):
    df = spark.range(3000).select("id", F.col("id").alias("k"), (F.col("id") % 7).alias("v"), (F.col("id") % 2).alias("y"))
    model = training.train_sparse(df, ["v"], ["k"], "y", params={"maxIter": 2})
    features = model.transform(df).schema["__features"]
    assert len(str(features.metadata)) < 1000  # a name per place made plans and tasks grow with the levels
    classifier = model.pipeline.stages[-1]
    assert classifier.numFeatures == 3001
    wide = training.train_sparse(df, ["v"], ["k"], "y", params={"maxIter": 1, "maxBlockSizeInMB": 2.0})
    assert wide.pipeline.stages[-1].getMaxBlockSizeInMB() == 2.0 and classifier.getMaxBlockSizeInMB() > 1.0


@pytest.mark.parametrize("kind, params", [("logistic", {"maxIter": 2}), ("forest", {"numTrees": 2})])
def test_numbers_come_first_and_missing_ones_are_errors(spark, kind, params):
    df = table(spark).withColumn("y", (F.col("id") % 2).cast("int"))
    model = training.train_sparse(df, ["v"], ["c", "d.e"], "y", kind, params)
    rows = model.transform(df).select("id", "__features").collect()
    mean, deviation = 3.5, np.std([r[3] for r in ROWS])
    want = {0: [0, 3, 4], 1: [0, 2], 2: [0], 3: [0, 3, 5], 4: [0, 1, 4], 5: [0, 3, 4]}
    assert {r["id"]: r["__features"].indices.tolist() for r in rows} == want
    assert all(abs(r["__features"].values[0] - (r["id"] + 1 - mean) / deviation) < 1e-12 for r in rows)
    with pytest.raises(Exception, match="holds NULL or NaN"):
        model.transform(df.withColumn("v", F.when(F.col("id") > 0, F.col("v")))).collect()


def labelled(spark):
    df = spark.range(20_000, numPartitions=1).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(300)).alias("n"), F.when(F.col("id") % 3 > 0, "often").alias("m"), (F.hash("id") % 100 / 10).alias("v")
    )
    df = df.withColumn("k", F.when(F.col("id") % 50 > 0, F.col("n").cast("string")))
    chance = F.pmod(F.hash(F.lit("y"), "id"), F.lit(100)) < 20 + 40 * (F.col("n") % 2) + F.col("v")
    return df.withColumn("y", chance.cast("int")).drop("n").cache()


@pytest.mark.parametrize("balanced", [True, False])
def test_a_wide_model_equals_that_of_spark(spark, monkeypatch, balanced):
    df, params = labelled(spark), {"tol": 1e-10}
    theirs = training.train_sparse(df, ["v"], ["k", "m"], "y", params=params, balanced=balanced)
    monkeypatch.setattr(training, "WIDE", 0)
    own = training.train_sparse(df, ["v"], ["k", "m"], "y", params=params, balanced=balanced)
    a, b = theirs.pipeline.stages[-1], own.pipeline.stages[-1]
    assert abs(a.coefficients.toArray() - b.coefficients.toArray()).max() < 1e-5 and abs(a.intercept - b.intercept) < 1e-5
    assert b.getRegParam() == a.getRegParam() and b.getTol() == 1e-10 and b.numFeatures == 302
    path = scratch_path(spark, "wide")
    own.save(path)
    loaded = add_scores(df, training.SparseModel.load(spark, path)).select("id", F.col("probability").alias("p"))
    scores = add_scores(df, own).select("id", "probability").join(loaded, "id").filter(F.col("probability") == F.col("p"))
    assert scores.count() == 20_000


def test_blocks_of_a_wide_model_do_not_grow_with_its_levels(spark):
    df = spark.range(320_000).select("id", (F.col("id") % 160_000).cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    df = df.withColumn("y", (F.pmod(F.xxhash64("k"), F.lit(2)) == 0).cast("int"))
    model = training.train_sparse(df, ["v"], ["k"], "y", params={"maxIter": 5})
    classifier = model.pipeline.stages[-1]
    assert classifier.numFeatures == 160_001 and classifier.getMaxBlockSizeInMB() == 0.0  # was 4 times the coefficients
    rows = evaluated_rows(df, model, "y", "id")
    assert evaluate(rows, "y_true", "prediction", "probability").first()["roc_auc"] > 0.99


def test_blocks_hold_all_rows_and_few_at_once(spark):
    df = labelled(spark).withColumn("v", F.lit(1.0))
    levels = sparse.fit_levels(df, ["k", "m"])
    packed = sparse_logistic.blocks(sparse.sparse_structs(df, levels, "f", False, ["v"]), "f", "y", F.lit(2.0))
    sizes = [len(r["y"]) // 8 for r in packed.collect()]
    assert sum(sizes) == 20_000 and 2 < len(sizes) and max(sizes) <= sparse_logistic.BLOCK_ROWS
    found = {r["place"]: r["g"] for r in packed.mapInArrow(sparse_logistic._sums(None, 0.0), "place long, g double").groupBy("place").agg(F.sum("g").alias("g")).collect()}
    counts = {r["place"] + 1: 2.0 * r["n"] for r in levels.table.collect()}
    assert found == {**counts, 0: 40_000.0, -1: 0.0, -2: 40_000.0, -3: 2.0 * df.filter("y = 1").count()}


def test_other_targets_and_settings_stay_with_spark(spark, monkeypatch):
    monkeypatch.setattr(training, "WIDE", 0)
    df = labelled(spark)
    three = training.train_sparse(df.withColumn("y", F.col("id") % 3), ["v"], ["m"], "y", params={"maxIter": 2})
    assert three.pipeline.stages[-1].numClasses == 3
    lasso = training.train_sparse(df, ["v"], ["m"], "y", params={"maxIter": 2, "elasticNetParam": 1.0})
    assert lasso.pipeline.stages[-1].getMaxBlockSizeInMB() > 1.0
