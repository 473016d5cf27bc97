import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskframe.operators.metrics import evaluate
from riskframe.plans import boosting as B
from riskframe.plans import training
from riskframe.plans.scoring import add_scores, evaluated_rows
from riskframe.session import scratch_path

COLUMNS = ["a", "b", "c"]


def data(n=1500, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(0, 1, n), rng.integers(0, 7, n).astype(float), rng.normal(0, 3, n)], axis=1)
    x[rng.random(n) < 0.05, 2] = np.nan
    chance = 1 / (1 + np.exp(-(2 * x[:, 0] + (x[:, 1] > 3) * 2 - 1 + np.nan_to_num(x[:, 2]) * (x[:, 1] < 2))))
    return x, (rng.random(n) < chance).astype(float)


def table(spark, x, y, partitions=3):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(partitions)


def plain_boosting(x, y, how, edges):
    """The same trees with loops over rows and bins, all rows and columns."""
    low = np.where(np.isnan(x), -np.inf, x)
    mean = y.mean()
    margin = np.full(len(y), np.log(mean / (1 - mean)))
    quality = lambda g, h: max(abs(g) - how.l1, 0) ** 2 / (h + how.l2)

    def grow(rows, g, h, depth):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (how.least_gain, None)
        for c in range(x.shape[1] if depth else 0):
            for e in edges[c]:
                left = rows[low[rows, c] <= e]
                gl, hl = g[left].sum(), h[left].sum()
                if min(hl, total_h - hl) >= how.least_hessian:
                    gain = 0.5 * (quality(gl, hl) + quality(total_g - gl, total_h - hl) - quality(total_g, total_h))
                    if gain > best[0] + 1e-12:
                        best = (gain, (c, e))
        if best[1] is None:
            out = np.zeros(len(y))
            out[rows] = how.rate * -np.sign(total_g) * max(abs(total_g) - how.l1, 0) / (total_h + how.l2)
            return out
        c, e = best[1]
        right = low[rows, c] > e
        return grow(rows[~right], g, h, depth - 1) + grow(rows[right], g, h, depth - 1)

    for _ in range(how.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * B.FIXED) / B.FIXED, np.rint(p * (1 - p) * B.FIXED) / B.FIXED
        margin = margin + grow(np.arange(len(y)), g, h, how.depth)
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("l1", [0.0, 3.0])
def test_trees_equal_a_plain_loop(spark, l1):
    x, y = data(400)
    how = B.Boosting(rounds=4, rate=0.3, depth=3, row_share=1.0, column_share=1.0, l1=l1, l2=2.0, bins=8, keep_every=2)
    df = table(spark, x, y)
    model = B.train_boosted(df, COLUMNS, "y", how)
    want = plain_boosting(x, y, how, B.bin_edges(df, COLUMNS, how.bins))
    got = {r["id"]: r["probability"] for r in add_scores(df, model.probability()).collect()}
    assert max(abs(got[i] - want[i]) for i in range(len(y))) < 1e-9


def test_order_and_partitions_do_not_matter(spark):
    x, y = data(600)
    how = B.Boosting(rounds=5, rate=0.3, depth=3, keep_every=2)
    a = B.train_boosted(table(spark, x, y, 1), COLUMNS, "y", how, key="id")
    b = B.train_boosted(table(spark, x, y, 7).orderBy("c"), COLUMNS, "y", how, key="id")
    for s, t in zip(a.trees, b.trees, strict=True):
        assert all((v == vars(t)[k]).all() for k, v in vars(s).items())
    assert {int(c) for t in a.trees for c in t.column} > {-1, 0}


def test_penalties_shrink_leaves_and_columns_are_drawn_per_tree(spark):
    x, y = data(500)
    df = table(spark, x, y)
    size = lambda **kw: max(abs(t.value).max() for t in B.train_boosted(df, COLUMNS, "y", B.Boosting(rounds=2, depth=2, **kw)).trees)
    assert size(l2=50.0) < size(l2=1.0) and size(l1=20.0) < size(l1=0.0)
    model = B.train_boosted(df, COLUMNS, "y", B.Boosting(rounds=6, depth=3, column_share=0.34))
    used = [{int(c) for c in t.column if c >= 0} for t in model.trees]
    assert all(len(u) == 1 for u in used) and len(set().union(*used)) > 1


def test_ranks_as_well_as_the_boosting_of_spark(spark):
    x, y = data(4000, seed=3)
    df = table(spark, np.nan_to_num(x), y)
    train, test = df.filter("id < 3000").cache(), df.filter("id >= 3000").cache()
    auc = lambda rows: evaluate(rows, "y_true", "prediction", "probability").first()["roc_auc"]
    own = B.train_boosted(train, COLUMNS, "y", B.Boosting(rounds=25, rate=0.2, depth=3), key="id")
    theirs = training.train(train, COLUMNS, "y", "gbt", {"maxIter": 25, "stepSize": 0.2, "maxDepth": 3})
    scores = auc(evaluated_rows(test, own.probability(), "y", "id")), auc(evaluated_rows(test, theirs, "y", "id"))
    print("AUC", scores)
    assert scores[0] > scores[1] - 0.01


def test_save_load_weights_and_bad_input(spark):
    x, y = data(300)
    df = table(spark, x, y).withColumn("w", F.col("y") * 3 + 1)
    model = B.train_boosted(df, COLUMNS, "y", B.Boosting(rounds=2, depth=2), weight="w")
    path = scratch_path(spark, "boosted")
    model.save(spark, path)
    again = B.BoostedTrees.load(spark, path)
    rows = df.select(model.probability().alias("p"), again.probability().alias("q")).collect()
    assert all(r["p"] == r["q"] for r in rows)
    assert model.base > B.train_boosted(df, COLUMNS, "y", B.Boosting(rounds=1, depth=1)).base
    with pytest.raises(ValueError):
        B.train_boosted(df.filter("y = 1"), COLUMNS, "y", B.Boosting(rounds=1))
    with pytest.raises(ValueError):
        B.train_boosted(df, [*COLUMNS, "missing"], "y")


def test_few_values_have_their_own_bins_and_constants_none(spark):
    df = spark.createDataFrame([(float(i % 4), 5.0, None) for i in range(40)], "a double, b double, c double")
    assert [e.tolist() for e in B.bin_edges(df, ["a", "b", "c"], 8)] == [[0.0, 1.0, 2.0], [], []]


def test_few_values_keep_a_bin_each_whatever_the_sample_holds(spark):
    df = spark.range(6000).select(
        "id", (F.col("id") % 200).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"), (F.col("id") / 7).alias("c")
    ).repartition(5)
    a, b, c = B.bin_edges(df, COLUMNS, 256, sample_rows=50)
    assert a.tolist() == list(range(199)) and b.tolist() == [0, 1] and 0 < len(c) < 256
    assert [len(e) for e in B.bin_edges(df.filter("id < 0"), COLUMNS, 16)] == [0, 0, 0]
    assert B.few_values(df.select(F.col("a").alias("x0")), 199) == {}


def test_the_sample_of_the_bins_is_hashed_once_per_row(spark):
    cells = spark.range(3000).select((F.col("id") / 8).alias("x0"), F.when(F.col("id") % 3 > 0, F.col("id") * 1.0).alias("x1"))
    taken = B._first_in_hash_order(cells, 50)
    plan = taken._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan and not [line for line in plan.splitlines() if "Sort" in line and "md5" in line]
    text = lambda v: "" if v is None else str(v)
    order = sorted(map(tuple, cells.collect()), key=lambda r: hashlib.md5(":".join(map(text, r)).encode()).hexdigest())
    assert [(r["x0"], r["x1"]) for r in taken.collect()] == order[:50]


def test_boosting_on_few_groups_starts_few_tasks(spark):
    rows = spark.range(60_000).select("id", (F.col("id") % 7).cast("double").alias("v"))
    small, large = rows.repartition(8, "id"), rows.repartition(1)
    assert training._spread(small, ["id"], 60_000, "gbt").rdd.getNumPartitions() == 2
    assert training._spread(large, ["id"], 60_000, "gbt").rdd.getNumPartitions() == 2
    assert training._spread(large, ["id"], 60_000, "forest").rdd.getNumPartitions() == 8
    assert training._spread(small, ["id"], 10_000_000, "gbt").rdd.getNumPartitions() == 8


def test_every_value_is_a_split_however_many_there_are(spark, tmp_path):
    events = spark.range(4000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 977).alias("ts"), F.lit(1).cast("long").alias("user_id"),
        F.when(F.xxhash64("id") % 3 == 0, "purchase").otherwise("click").alias("event_type"), F.lit(1.0).alias("value"),
        F.format_string('{"k": %d}', (F.col("id") * 7919) % 1500).alias("props"),
    )
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    got = entry.queries()["split_gains"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.sql(entry.oracle_sql()["split_gains"]).fetchall()
    assert len(got) == 1499 + 23 and sorted(map(tuple, got)) == sorted(want)


def test_bins_per_value_equal_bins_found_first(spark):
    x, y = data(1200)
    x[:, 0] = np.round(x[:, 0])
    x[:50, 1], x[:, 2] = np.nan, np.nan
    x[50:60, 0], x[60:70, 1] = -np.inf, -0.0
    df = table(spark, x, y)
    found = []
    for bins in (256, None):
        sums, edges = B.first_histograms(df, COLUMNS, "y", bins)
        assert sums.filter("feature = 2").count() == 1
        gains = B.split_gains(sums, 2.0, 0.5).join(edges, ["feature", "bin"])
        found.append(sorted(map(tuple, gains.select("feature", "bin", "upto", "g_left", "h_left", "g_all", "h_all", "gain").collect())))
    assert found[0] == found[1] and len(found[0]) > 10


def test_slices_do_not_change_gains(spark):
    df = spark.range(5000).select((F.col("id") * 3 % 4001).alias("a"), F.lit(1).alias("b"), (F.xxhash64("id") % 2 == 0).cast("int").alias("y"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # else few rows stay in one partition
    try:
        sums, edges = B.first_histograms(df, ["a", "b", "a"], "y")
    finally:
        spark.conf.set(setting, before)
    assert sums.filter("feature = 0").select("slice").distinct().count() > 1
    columns = ["feature", "bin", "g_left", "h_left", "g_all", "h_all", "gain"]
    one, many = (sorted(map(tuple, B.split_gains(s).select(*columns).collect())) for s in (sums.drop("slice"), sums))
    assert one == many and [r[1] for r in one if r[0] == 2] == list(range(4001)) and edges.count() == 8000
    with pytest.raises(Exception, match="holds NULL"):
        B.first_histograms(df.withColumn("y", F.when(F.col("a") > 5, F.col("y"))), ["a"], "y")
