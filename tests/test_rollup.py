import pytest
from pyspark.sql import functions as F

from riskframe.operators.assemble import (
    DuplicateKeyError,
    Side,
    assemble,
    check_no_overlap,
    check_unique,
    duplicate_keys,
    key_overlap,
)
from riskframe.operators.rollup import attach_to_entity, frequent_keys, two_level_rollup


@pytest.fixture
def tables(spark):
    child = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 10.0), (3, 7.0), (9, 5.0), (None, 2.0)], "k int, v double")
    link = spark.createDataFrame([(1, 100), (2, 100), (3, 200), (3, 300), (4, 400)], "k int, e int")
    return child, link


LEVEL1 = {"m": F.avg, "s": F.stddev_samp, "x": F.max}


def roll(child, link, how="inner", hot=()):
    return two_level_rollup(
        child, "k", {n: f("v") for n, f in LEVEL1.items()}, link, "e",
        {"m": F.avg("m"), "s": F.avg("s"), "x": F.max("x")}, how, hot,
    )


def test_two_levels_by_hand(tables):
    rows = {r["e"]: r for r in roll(*tables).collect()}
    assert set(rows) == {100, 200, 300}  # child 9 has no link; link 3 occurs twice and fans out
    assert rows[100]["m"] == (2.0 + 10.0) / 2 and rows[100]["x"] == 10.0
    assert rows[100]["s"] == pytest.approx(2**0.5)  # a single-row contract has no deviation and is skipped
    assert rows[200]["s"] is None and rows[300]["m"] == 7.0


def test_left_keeps_unlinked_children_under_null(tables):
    rows = {r["e"]: r for r in roll(*tables, how="left").collect()}
    assert rows[None]["m"] == (5.0 + 2.0) / 2 and set(rows) == {None, 100, 200, 300}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_links_change_nothing(tables, how):
    child, link = tables
    plain = sorted(map(str, roll(child, link, how).collect()))
    assert sorted(map(str, roll(child, link, how, [3]).collect())) == plain
    assert sorted(map(str, roll(child, link, how, [1, 2, 3, 4]).collect())) == plain


def test_partitioning_does_not_matter(tables):
    child, link = tables
    assert sorted(roll(child.repartition(1), link).collect(), key=str) == sorted(roll(child.repartition(7), link).collect(), key=str)


def test_frequent_keys(spark):
    link = spark.createDataFrame([(i if i > 60 else 5, i) for i in range(100)], "k int, e int")
    assert frequent_keys(link, "k", share=0.1, at_least=30) == [5]
    assert frequent_keys(link, "k", share=0.1, at_least=90) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_is_spread_and_changes_nothing(spark, how):
    child = spark.createDataFrame([(1 if i % 2 else i, i) for i in range(4000)] + [(None, -1)], "k int, v int").repartition(8)
    link = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (None, 30), (9999, 40)], "k int, e int")
    plain = attach_to_entity(child, link, "k", "e", how)
    hot = frequent_keys(child, "k", at_least=1000)
    assert hot == [1]
    spread = attach_to_entity(child, link, "k", "e", how, hot)
    assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))
    shares = [r[0] for r in spread.filter("k = 1").groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(shares) >= 8 and max(shares) < 1000


def test_attach_refuses_other_joins(tables):
    with pytest.raises(ValueError):
        attach_to_entity(*tables, "k", "e", "full")


def test_assemble_is_one_to_one(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, s string")
    once = spark.createDataFrame([(1, 10), (3, 30)], "id int, v int")
    twice = spark.createDataFrame([(1, 10), (1, 11)], "id int, v int")
    assert sorted(assemble(base, [Side(once, unique=True)], "id").collect()) == [(1, "a", 10), (2, "b", None), (3, "c", 30)]
    with pytest.raises(DuplicateKeyError, match="side table 1"):
        assemble(base, [twice], "id")
    with pytest.raises(DuplicateKeyError, match="entity table"):
        assemble(twice, [once.withColumnRenamed("v", "w")], "id")


def test_key_checks(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    b = spark.createDataFrame([(2,), (3,)], "id int")
    assert duplicate_keys(a, "id").collect() == [(2, 2)]
    assert key_overlap(a, b, "id").collect() == [(2,)]
    with pytest.raises(DuplicateKeyError):
        check_unique(a, "id", "a")
    with pytest.raises(ValueError, match="overlap"):
        check_no_overlap(a, b, "id")
    check_no_overlap(a, b.filter("id = 3"), "id")
