import pytest
from pyspark.sql import functions as F

from riskframe.operators import contract as K

C = K.Contract(
    "t",
    {
        "id": K.Field(nullable=False, rules=(K.NON_NEGATIVE,), unique=True),
        "y": K.Field(nullable=False, rules=(K.one_of(0, 1),)),
        "d": K.Field(rules=(K.sentinel_or_non_positive(365243),)),
        "b": K.Field(nullable=False, rules=(K.NON_POSITIVE,)),
        "s": K.Field(kind="string", nullable=False),
        "n": K.Field(),
    },
)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, y int, d double, b double, s string, n string")


GOOD = (1, 0, 365243.0, -5.0, "x", "1.5")


def failures(df, contract=C):
    return {(r["column"], r["check"]): r["failures"] for r in K.run_contract(df, contract).filter("not passed").collect()}


def test_valid_table_passes(spark):
    df = frame(spark, GOOD, (2, 1, None, 0.0, "y", None))
    assert failures(df) == {}
    K.enforce(K.run_contract(df, C), "t")


@pytest.mark.parametrize(
    "row, failing",
    [
        ((-1, 0, 0.0, 0.0, "x", "1"), {("id", "non_negative"): 1}),
        ((None, 0, 0.0, 0.0, "x", "1"), {("id", "not_null"): 1}),
        ((1, 0, 0.0, 0.0, "x", "1"), {("id", "unique"): 1}),
        ((3, 2, 0.0, 0.0, "x", "1"), {("y", "one_of"): 1}),
        ((3, 0, 100.0, 0.0, "x", "1"), {("d", "sentinel_or_non_positive"): 1}),
        ((3, 0, 0.0, 4.0, "x", "1"), {("b", "non_positive"): 1}),
        ((3, 0, 0.0, float("nan"), "x", "1"), {("b", "not_null"): 1}),
        ((3, 0, 0.0, 0.0, None, "1"), {("s", "not_null"): 1}),
        ((3, 0, 0.0, 0.0, "x", "abc"), {("n", "type"): 1}),
        ((-3, 7, 9.0, 9.0, None, "abc"), {
            ("id", "non_negative"): 1, ("y", "one_of"): 1, ("d", "sentinel_or_non_positive"): 1,
            ("b", "non_positive"): 1, ("s", "not_null"): 1, ("n", "type"): 1,
        }),
    ],
)
def test_every_check_can_fail(spark, row, failing):
    df = frame(spark, GOOD, row)
    assert failures(df) == failing
    with pytest.raises(ValueError, match="data contract failed for 't'"):
        K.enforce(K.run_contract(df, C), "t")


def test_missing_column_is_reported_with_the_rest(spark):
    df = frame(spark, GOOD, (-2, 0, 0.0, 0.0, "x", "1")).drop("y")
    assert failures(df) == {("y", "present"): 1, ("id", "non_negative"): 1}


def test_extra_columns_only_matter_when_strict(spark):
    df = frame(spark, GOOD).withColumn("more", F.lit(1))
    assert failures(df) == {}
    assert failures(df, K.Contract("t", C.fields, strict=True)) == {("more", "undeclared"): 1}


def test_unknown_table(spark):
    with pytest.raises(ValueError, match="no contract registered"):
        K.run_contracts({"other": frame(spark, GOOD)}, {"t": C})


def test_failure_sample(spark):
    df = frame(spark, GOOD, (-1, 5, 0.0, 0.0, "x", "1"), (7, 6, 0.0, 0.0, "x", "1"))
    got = [tuple(r) for r in K.failure_sample(df, C, "id").collect()]
    assert got == [(-1, "id", "non_negative", "-1"), (-1, "y", "one_of", "5"), (7, "y", "one_of", "6")]
    assert K.failure_sample(df, C, "id", 1).count() == 1


def test_quarantine(spark):
    df = frame(spark, GOOD, (-1, 5, 0.0, 0.0, "x", "1"))
    valid, rejected = K.quarantine(df, C)
    assert [r["id"] for r in valid.collect()] == [1]
    assert rejected.first()["reasons"] == ["id:non_negative", "y:one_of"]
    with pytest.raises(ValueError, match="lacks declared columns: y"):
        K.quarantine(df.drop("y"), C)


def test_layer_contracts(spark):
    df = spark.createDataFrame([(1.0, 0.0, 2.0)], "SK_ID_CURR double, TARGET double, missing_count double")
    store = K.feature_store_contract("TARGET", "SK_ID_CURR")
    assert failures(df, store) == {}
    assert failures(df.drop("missing_count"), store) == {("missing_count", "present"): 1}
    assert failures(df.unionByName(df), K.split_contract("TARGET", "SK_ID_CURR")) == {("SK_ID_CURR", "unique"): 1}
    with pytest.raises(ValueError, match="AGE_YEARS"):
        K.check_features_present(df, ["TARGET", "AGE_YEARS"])


def test_matrix_and_request(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None), (1, float("inf"), float("nan")), (2, float("-inf"), 3.0)], "id int, a double, b double"
    )
    got = {(r["column"], r["check"]): r["failures"] for r in K.request_check(df, ["a", "b", "c"], "id").collect()}
    assert got == {("c", "columns_present"): 1, (None, "missing_cells"): 2, (None, "infinite_cells"): 2, ("id", "unique"): 1}
    clean = spark.createDataFrame([(1, 1.0)], "id int, a double")
    K.enforce(K.request_check(clean, ["a"], "id"), "request")
    K.enforce(K.request_check(clean, ["a"], None), "request")
