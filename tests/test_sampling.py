import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.operators import encode as E
from riskframe.operators import sampling as S


def by_hash(ids, seed):
    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())


@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_sample(spark, partitions):
    df = spark.range(1000).repartition(partitions)
    got = {r[0] for r in S.sample_exact(df, 137, 42, "id").collect()}
    assert got == set(by_hash(range(1000), 42)[:137])


def test_sample_sizes(spark):
    df = spark.range(10)
    assert S.sample_exact(df, None, 1, "id").count() == 10
    assert S.sample_exact(df, 10, 1, "id").count() == 10
    assert S.sample_exact(df, 50, 1, "id", clamp=True).count() == 10
    with pytest.raises(ValueError):
        S.sample_exact(df, 50, 1, "id")


def test_ambiguous_key_is_refused(spark):
    df = spark.range(100).withColumn("k", F.lit(1))
    with pytest.raises(ValueError, match="does not identify"):
        S.sample_exact(df, 10, 1, "k")
    assert S.sample_exact(df, 10, 1, ["k", "id"]).count() == 10


def test_split_is_a_partition(spark):
    df = spark.range(1001)
    train, test = S.split(df, 0.2, 42, "id")
    a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert len(b) == 201 and not a & b and a | b == set(range(1001))


def test_stratified_split_keeps_shares_and_null_class(spark):
    df = spark.range(1000).withColumn("t", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, 1).otherwise(0))
    train, test = S.split(df, 0.25, 7, "id", stratify="t")
    sizes = {r[0]: r[1] for r in S.class_counts(df, "t").collect()}
    got = {r[0]: r[1] for r in S.class_counts(test, "t").collect()}
    assert sum(got.values()) == 250 and got == S.allot(sizes, 250)
    assert train.count() == 750


@given(st.dictionaries(st.integers(0, 9), st.integers(1, 500), min_size=1), st.floats(0.01, 0.99))
@settings(max_examples=200, deadline=None)
def test_allotment(sizes, share):
    total = int(sum(sizes.values()) * share)
    got = S.allot(sizes, total)
    assert sum(got.values()) == total
    for s, n in sizes.items():
        assert abs(got[s] - total * n / sum(sizes.values())) < 1 and got[s] <= n


def test_downsample_and_weights(spark):
    df = spark.range(100).withColumn("t", (F.col("id") < 20).cast("int"))
    low = S.downsample_majority(df, "t", 42, "id")
    assert {r[0]: r[1] for r in S.class_counts(low, "t").collect()} == {0: 20, 1: 20}
    kept = {r["id"] for r in low.filter("t = 0").collect()}
    assert kept == set(by_hash(range(20, 100), 42)[:20])
    weights = {(r["t"], r["weight"]) for r in S.class_weights(df, "t").collect()}
    assert weights == {(1, 100 / (2 * 20)), (0, 100 / (2 * 80))}


def test_class_column_with_too_many_values(spark):
    from riskframe.operators.local_state import read_classes

    with pytest.raises(ValueError, match="not a class column"):
        read_classes(spark.range(30), "id", limit=20)


def test_vocabulary_and_one_hot(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "y/z"), (3, "c", "x")], "id int, s string, t string")
    vocabulary = E.read_vocabulary(E.fit_vocabulary(df))
    assert vocabulary == {"s": ["a b", "c"], "t": ["x", "y/z"]}
    hot = E.one_hot(df, vocabulary)
    assert hot.columns == ["id", "s_a b", "s_c", "t_x", "t_y/z"]
    assert [tuple(r) for r in hot.orderBy("id").collect()] == [(1, 1, 0, 1, 0), (2, 0, 0, 0, 1), (3, 0, 1, 1, 0)]
    with pytest.raises(ValueError, match="levels"):
        E.read_vocabulary(E.fit_vocabulary(df), max_levels=1)
    with pytest.raises(ValueError, match="already exist"):
        E.one_hot(df.withColumn("s_c", F.lit(1)), vocabulary)


@pytest.mark.parametrize("partitions", [1, 7])
def test_medians_match_numpy(spark, partitions):
    rng = random.Random(3)
    rows = [
        (
            rng.choice([None, rng.gauss(0, 1), rng.gauss(100, 5)]),
            rng.choice([float("nan"), 7.0, 7.0, 7.0]),
            float(i % 2),
            None,
            i,
        )
        for i in range(501)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e int").repartition(partitions)
    got = E.fit_medians(df)
    assert got["a"] == pytest.approx(np.median([r[0] for r in rows if r[0] is not None]), abs=0)
    assert (got["b"], got["c"], got["d"], got["e"]) == (7.0, 0.0, None, 250.0)


def test_median_outside_its_bracket_is_found_again(spark, monkeypatch):
    from pyspark.sql import DataFrame

    df = spark.createDataFrame([(float(i),) for i in range(11)], "a double")
    for bracket in ([8.0, 9.0], [0.0, 1.0], [5.0, 5.0]):
        monkeypatch.setattr(DataFrame, "approxQuantile", lambda *_, found=bracket: [found])
        assert E.fit_medians(df, ["a"]) == {"a": 5.0}


def test_impute(spark):
    df = spark.createDataFrame([(None, None, 1), (2.0, None, None)], "a double, b double, c int")
    out = E.impute_median(df, {"a": 9.0, "b": None, "c": 4.0}).collect()
    assert [tuple(r) for r in out] == [(9.0, None, 1.0), (2.0, None, 4.0)]


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    rows = E.standardize(df, ["a", "b"]).collect()
    x = np.array([1.0, 2.0, 4.0])
    assert [r["a"] for r in rows] == pytest.approx(list((x - x.mean()) / x.std()))
    assert [r["b"] for r in rows] == [0.0, 0.0, 0.0]


def test_medians_of_odd_tables(spark):
    import random

    inf = float("inf")
    r = random.Random(4)
    rows = [(r.gauss(0, 1), r.choice([1.0, 1.0, 2.0]), -inf if i % 3 else r.choice([-1e300, -1e301, inf]), None) for i in range(500)]
    rows += [(float("nan"), None, None, None)] * 7
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    want = []
    for k in range(3):
        v = sorted(x[k] for x in rows if x[k] is not None and x[k] == x[k])
        want.append(v[(len(v) - 1) // 2] if v[(len(v) - 1) // 2] == v[len(v) // 2] else (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2)
    got = E.fit_medians(df)
    assert [got[c] for c in "ab"] == pytest.approx(want[:2]) and got["d"] is None
    for bucket_low in (-inf,):
        places = [E._Place(2, bucket_low, inf, p) for p in (1, 330, 334, 420, 500)]
        numbers = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(f"v{i}") for i, c in enumerate(df.columns)])
        c = sorted(x[2] for x in rows if x[2] is not None)
        expected = [c[p.place - 1] for p in places]
        while todo := [p for p in places if p.value is None]:
            E._narrow(numbers, todo)
        assert [p.value for p in places] == expected


def test_equal_rows_at_the_cut_are_interchangeable(spark):
    df = spark.createDataFrame([("x", 1)] * 10 + [("y", 2)], "a string, b int")
    for n in (1, 5, 10, 11):
        assert S.sample_exact(df, n, 42, df.columns).count() == n
    with pytest.raises(ValueError):
        S.sample_exact(df.withColumn("c", F.lit(1)), 5, 42, ["a"]).count()


@pytest.mark.parametrize("bracket", [None, [1.0, 2.0]])
def test_medians_take_at_most_eight_rounds_whatever_the_values(spark, monkeypatch, bracket):
    import random

    from pyspark.sql import DataFrame

    r = random.Random(9)
    big = [r.choice([-1, 1]) * r.choice([1.7e308, 1.6e308, 5e-324, 1e-300, 1.0, 0.0, -0.0, 3e-310]) * r.random() for _ in range(999)]
    ends = [-1.7976931348623157e308] * 500 + [1.7976931348623157e308] * 500
    near = [1.0 + i * 2.0**-52 for i in range(1000)]
    zeros = [-0.0] * 400 + [0.0] * 300 + [5e-324] * 300
    df = spark.createDataFrame(list(zip([*big, None], ends, near, zeros)), "a double, b double, c double, d double").repartition(3)
    rounds, narrow = [], E._narrow
    monkeypatch.setattr(E, "_narrow", lambda *args: (rounds.append(1), narrow(*args)))
    if bracket:  # the quantiles missed all middles
        monkeypatch.setattr(DataFrame, "approxQuantile", lambda self, names, *_: [bracket] * len(names))
    got = E.fit_medians(df)
    assert len(rounds) <= 8
    assert got["a"] == sorted(big)[499] and got["b"] == 0.0 and got["d"] == 0.0
    assert got["c"] == near[499] + (near[500] - near[499]) / 2


def test_medians_of_few_values_need_no_counting_and_middles_share_a_bracket(spark, monkeypatch):
    cells = [(F.col("id") % 3).cast("double").alias("a"), (F.col("id") * 1.0).alias("b"), F.when(F.col("id") % 4 > 0, 7.0).alias("c")]
    df = spark.range(1000).select(*cells).repartition(3)
    counted, narrow, cut = [], E._narrow, []
    monkeypatch.setattr(E, "_narrow", lambda numbers, places: (counted.append({p.column for p in places}), narrow(numbers, places)))
    bucketizer = E.Bucketizer
    monkeypatch.setattr(E, "Bucketizer", lambda **kw: (cut.append(len(kw["splitsArray"])), bucketizer(**kw))[1])
    monkeypatch.setattr(type(df), "approxQuantile", lambda self, names, *_: [[1.0, 1.0], [400.0, 600.0], [7.0, 7.0]])
    assert E.fit_medians(df) == {"a": 1.0, "b": 499.5, "c": 7.0}
    assert counted and all(columns == {1} for columns in counted) and cut[0] == 1


def test_doubles_have_their_place_in_an_order():
    values = [float("-inf"), -1.7e308, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.7e308, float("inf")]
    numbers = [E.order_number(v) for v in values]
    assert numbers == sorted(numbers) and [E.ordered_double(n) for n in numbers] == values
    assert E.order_number(-0.0) == 0
