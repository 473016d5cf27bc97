import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F

from riskframe.functions import expr as X
from riskframe.functions.hashing import hash_number, unit_draw
from riskframe.operators import frame as FR


def one(spark, column, schema="a double, b double", row=(1.0, 0.0)):
    return spark.createDataFrame([row], schema).select(column.alias("x")).first()["x"]


def test_ratios(spark):
    assert one(spark, X.eps_ratio("a", "b")) == 1 / 1e-6
    assert one(spark, X.eps_ratio("a", "b", eps=0.0)) is None
    assert one(spark, X.plain_ratio("a", "b")) is None
    assert one(spark, X.plain_ratio("a", "b", on_zero=7)) == 7.0
    assert one(spark, X.plain_ratio("a", "b"), row=(1.0, 4.0)) == 0.25
    assert one(spark, X.eps_ratio("a", "b"), row=(None, 4.0)) is None


def test_sentinels_and_days(spark):
    days = "d long, birth long"
    assert one(spark, X.sentinel_flag("d", 365243), days, (365243, -1)) == 1
    assert one(spark, X.sentinel_flag("d", 365243), days, (None, -1)) == 0
    assert one(spark, X.sentinel_to_null("d", 365243), days, (365243, -1)) is None
    assert one(spark, X.days_to_years("d"), days, (-730, -1)) == pytest.approx(730 / 365.000001)
    assert one(spark, X.tenure_share("d", "birth"), days, (-500, -1000)) == pytest.approx(0.5)
    assert one(spark, X.day_gap("d", "birth"), days, (5, 2)) == 3
    assert one(spark, X.day_gap("d", "birth"), days, (None, 2)) is None


def test_flags(spark):
    assert one(spark, X.condition_flag(F.col("a") > 0)) == 1
    assert one(spark, X.condition_flag(F.col("a") > 0), row=(None, 0.0)) == 0
    assert one(spark, X.flag_sum(["a", "b"]), row=(None, 2.0)) == 2.0
    assert one(spark, X.missing_indicator("a"), row=(None, 2.0)) == 1
    assert one(spark, X.missing_indicator("a", floating=True), row=(float("nan"), 2.0)) == 1


@pytest.mark.parametrize("code, number", [("C", 0), ("X", 0), ("0", 0), ("5", 5), (None, None)])
def test_code_to_number(spark, code, number):
    assert one(spark, X.code_to_number("s"), "s string", (code,)) == number


def test_bad_code_raises_or_is_null(spark):
    with pytest.raises((NumberFormatException, ArithmeticException)):
        one(spark, X.code_to_number("s"), "s string", ("Z",))
    assert one(spark, X.code_to_number("s", lenient=True), "s string", ("Z",)) is None


@pytest.mark.parametrize("p, band", [(0.7, "high_risk"), (0.69, "medium_risk"), (0.4, "medium_risk"), (0.39, "low_risk")])
def test_bands_have_inclusive_lower_bounds(spark, p, band):
    assert one(spark, X.risk_band("a"), row=(p, 0.0)) == band


def test_decide_is_inclusive(spark):
    assert one(spark, X.decide("a", 0.5), row=(0.5, 0.0)) == 1
    assert one(spark, X.decide("a", 0.5), row=(0.499, 0.0)) == 0


def test_aggregates(spark):
    df = spark.createDataFrame([(1, -3, "a"), (1, -1, "b"), (1, None, "a"), (2, -9, "b")], "k int, m int, s string")
    is_a = F.col("s") == "a"
    got = df.groupBy("k").agg(
        X.count_where(is_a).alias("n"), X.share_where(is_a).alias("s"), X.share_where(is_a, 30).alias("s30"),
        X.last_offset_where(is_a, "m").alias("last"),
    )
    rows = {r["k"]: r for r in got.collect()}
    assert (rows[1]["n"], rows[1]["s"], rows[1]["s30"], rows[1]["last"]) == (2, pytest.approx(2 / 3), pytest.approx(20), 3)
    assert (rows[2]["n"], rows[2]["s"], rows[2]["last"]) == (0, 0.0, None)


def test_draws(spark):
    import hashlib

    df = spark.createDataFrame([("42:1",)], "t string")
    row = df.select(hash_number(F.col("t")).alias("h"), unit_draw(F.col("t")).alias("u")).first()
    want = int(hashlib.md5(b"42:1").hexdigest()[:8], 16)
    assert row["h"] == want and row["u"] == want / 2**32


def test_require_and_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, t int, `a b` int")
    assert FR.require_columns(df, ["a b", "id"]).columns == ["a b", "id"]
    with pytest.raises(ValueError, match="x, y"):
        FR.require_columns(df, ["x", "id", "y"])
    assert FR.drop_columns(df, ["id", "t", "zz"], protect=["id"]).columns == ["id", "a b"]


def test_sparse_columns_follow_the_threshold(spark):
    rows = [(i, i if i < 6 else None, i if i < 5 else None) for i in range(10)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    assert FR.sparse_columns(df, 0.4) == ["c"]  # needs int(10 * 0.6) = 6 values
    assert FR.sparse_columns(df, 0.0) == []
    assert FR.drop_sparse_columns(df, 0.4).columns == ["a", "b"]


def test_missing_count_and_fill(spark):
    df = spark.createDataFrame([(None, float("nan"), None, "x"), (1, 2.0, True, None)], "a int, b double, c boolean, s string")
    assert [r[0] for r in df.select(FR.row_missing_count(df)).collect()] == [3, 1]
    assert FR.fill_zero(df).first()[:] == (0, 0.0, False, "x")


def test_numeric_values(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), (None,), ("NaN",)], "s string")
    assert [r[0] for r in df.select(FR.numeric_values(F.col("s"))).collect()] == [1.5, None, None, None]


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_ids(spark, partitions):
    df = spark.range(0, 3000, 3).withColumn("v", -F.col("id").cast("double")).repartition(partitions)
    got = FR.with_row_id(df, "v").collect()
    assert all(r["row_id"] == 999 - r["id"] // 3 for r in got) and len(got) == 1000


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("a", 2, 20), ("b", 1, 5)], "k string, ts int, v int")
    assert sorted(FR.latest_per_key(df, ["k"], "ts", ["ts", "v"]).collect()) == [("a", 3, 30), ("b", 1, 5)]
