import numpy as np
import pytest

import riskframe.operators.smote as smote_module
from riskframe.catalog import sampling
from riskframe.operators import forest, neighbours
from riskframe.operators.neighbours import nearest_neighbours
from riskframe.operators.smote import rows_to_add, smote, synthetic_rows
from riskframe.plans.training import rebalance
from tests.conftest import DATA


def points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vec array<double>")


def brute(x, k):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    return {i: list(np.lexsort((np.arange(len(x)), d[i]))[:k]) for i in range(len(x))}


@pytest.mark.parametrize("dims, block_rows", [(2, 4096), (2, 25), (8, 40)])
def test_neighbours_are_exact_with_any_block_size(spark, dims, block_rows):
    rng = np.random.default_rng(dims)
    x = np.concatenate([rng.normal(0, 1, (120, dims)), rng.normal(6, 0.01, (60, dims))])  # a third in one spot
    got: dict = {}
    for r in sorted(nearest_neighbours(points(spark, x), 4, block_rows).collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == brute(x, 4)


def test_copies_count_as_neighbours(spark):
    x = [[0.0, 0.0]] * 30 + [[1.0, 0.0], [1.0, 1.0], [5.0, 5.0]]
    made = synthetic_rows(points(spark, np.array(x)), 66, 3, 42).collect()
    assert len(made) == 66
    for r in made:
        if r["seed_id"] == 0:  # the hot vector has copies enough: nothing but itself
            assert r["neighbour"] == 0 and r["vec"] == [0.0, 0.0]
        else:
            assert 0.0 <= r["gap"] < 1.0


def test_synthetic_rows_lie_on_segments_and_repeat(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (40, 3))
    near = brute(x, 5)
    runs = [sorted(map(tuple, (r[:4] + (tuple(r["vec"]),) for r in synthetic_rows(points(spark, x).repartition(n), 90, 5, 7).collect()))) for n in (1, 5)]
    assert runs[0] == runs[1] and len(runs[0]) == 90
    per_seed: dict = {}
    for seed, _, neighbour, gap, vec in runs[0]:
        assert neighbour in near[seed]
        assert np.allclose(vec, x[seed] + gap * (x[neighbour] - x[seed]))
        per_seed[seed] = per_seed.get(seed, 0) + 1
    assert sorted(set(per_seed.values())) == [2, 3] and len(per_seed) == 40  # 90 = 40 * 2 + 10


def test_smote_then_downsample_ends_one_to_one(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b), int(i < 20)) for i, (a, b) in enumerate(rng.normal(0, 1, (220, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    up = smote(df, ["a", "b"], "y", "id", 0.2)
    assert {r[0]: r[1] for r in up.groupBy("y").count().collect()} == {0: 200, 1: 40}
    assert up.select("row_key").distinct().count() == 240
    assert {r[0]: r[1] for r in rebalance(df, ["a", "b"], "y", "id", 0.2).groupBy("y").count().collect()} == {0: 40, 1: 40}


def test_smote_refusals(spark):
    with pytest.raises(ValueError, match="exceeds"):
        rows_to_add(50, 100, 0.2)
    with pytest.raises(ValueError, match="too few"):
        synthetic_rows(points(spark, np.zeros((3, 2))), 5, 5, 1)
    df = spark.createDataFrame([(1, 0.0, 1)], "id long, a double, y int")
    with pytest.raises(ValueError, match="two classes"):
        smote(df, ["a"], "y", "id", 0.5)


def test_ties_and_near_ties_are_ranked_by_id():
    from riskframe.operators.neighbours import _nearest

    rng = np.random.default_rng(3)
    x = np.concatenate([np.zeros((200, 3)), rng.integers(0, 2, (300, 3)).astype(float), 1e8 + rng.normal(0, 1e-3, (100, 3))])
    ids = rng.permutation(len(x))
    best, who = _nearest(x[:50], ids[:50], x, ids, 4)
    for i in range(50):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        assert who[i].tolist() == ids[np.lexsort((ids, d))][:4].tolist()
    best, who = _nearest(x[-5:], ids[-5:], x, ids, 4)
    for i, j in enumerate(range(len(x) - 5, len(x))):
        d = np.sqrt(((x - x[j]) ** 2).sum(axis=1))
        d[j] = np.inf
        assert who[i].tolist() == ids[np.lexsort((ids, d))][:4].tolist()


def test_the_approximate_form_looks_at_fewer_blocks_and_finds_most(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (300, 2))
    rows = nearest_neighbours(points(spark, x), 3, 20, cells=4).collect()
    exact = brute(x, 3)
    assert sum(r["neighbour"] in exact[r["id"]] for r in rows) >= 0.9 * 900


def test_registered_queries_keep_the_default_blocks_and_small_ones_change_nothing(spark, monkeypatch):
    whole = sorted(map(tuple, sampling.smote_rows(spark, DATA).collect()))
    blocks = []

    def search(points, k, block_rows=neighbours.BLOCK_ROWS, **more):
        blocks.append(block_rows)
        return nearest_neighbours(points, k, 16, **more)

    monkeypatch.setattr(smote_module, "nearest_neighbours", search)
    assert sorted(map(tuple, sampling.smote_rows(spark, DATA).collect())) == whole
    assert sampling.smote_counts(spark, DATA).count() == 2
    assert set(blocks) == {neighbours.BLOCK_ROWS}


def test_forest_finds_nearly_all_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (1500, 64)) + rng.normal(0, 2, (10, 64))[rng.integers(0, 10, 1500)]
    table = points(spark, x)
    found = forest.forest_neighbours(table, 5, trees=32, leaf_rows=150).cache()
    near = brute(x, 5)
    for r in found.collect():
        d = np.sqrt(((x[r["id"]] - x[r["neighbour"]]) ** 2).sum())
        assert r["id"] != r["neighbour"] and r["distance"] == pytest.approx(d, rel=1e-12)
    got: dict = {}
    for r in found.collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbour"]))
    assert all([rank for rank, _ in sorted(v)] == [1, 2, 3, 4, 5] for v in got.values()) and len(got) == 1500
    share = np.mean([len(set(near[i]) & {n for _, n in v}) / 5 for i, v in got.items()])
    assert share >= 0.9
    row = forest.recall(found, nearest_neighbours(table, 5)).first()
    asked = [len(set(near[i]) & {n for _, n in got[i]}) for i in range(0, 1500, 20)]
    assert tuple(row)[:3] == (75, 375, sum(asked)) and row["recall"] == sum(asked) / 375


def test_forest_of_one_leaf_is_exact_and_cells_are_bounded(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (60, 3))
    table = points(spark, x)
    near = brute(x, 3)
    got = {(r["id"], r["rank"]): r["neighbour"] for r in forest.forest_neighbours(table, 3, leaf_rows=60).collect()}
    assert got == {(i, p + 1): n for i, v in near.items() for p, n in enumerate(v)}
    # no directions tell the vectors of a line at one place apart; their cell is cut by hash
    heap = points(spark, np.concatenate([[[1.0 + i * 1e-13, 0.0] for i in range(400)], [[9.0, 9.0]]]))
    rows = forest.forest_neighbours(heap, 2, trees=2, leaf_rows=10, sample_rows=20).collect()
    assert len({r["id"] for r in rows}) >= 400
    with pytest.raises(ValueError):
        forest.forest_neighbours(table, 60, leaf_rows=60)


def test_forest_cells_are_balanced_and_repeat():
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (4096, 8))
    a, b = (forest.Forest.fit(x[:2048], 3, 6, 7).cells(x) for _ in range(2))
    assert (a == b).all()
    for t in range(3):
        sizes = np.bincount(a[:, t], minlength=64)
        assert sizes.min() > 20 and sizes.max() < 130  # 64 on average
    assert forest.Forest.fit(x[:64], 2, 9, 7).cells(x).max() < 512  # deeper than the sample reaches


def test_leaves_grow_until_the_recall_is_reached(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (1200, 32))
    table = points(spark, x)
    exact = nearest_neighbours(table, 5, 100, every=20).cache()
    near = brute(x, 5)
    got = {(r["id"], r["rank"]): r["neighbour"] for r in exact.collect()}
    assert got == {(i, p + 1): j for i in range(0, 1200, 20) for p, j in enumerate(near[i])}
    plain, grown = (forest.recall(forest.forest_neighbours(table, 5, 4, 20, target=t), exact).first() for t in (None, 0.95))
    assert plain["recall"] < 0.8 and grown["recall"] >= 0.9 and grown["n_neighbours"] == 300
    monkeypatch.setattr(forest, "BLOCK_ROWS", 50)  # large cells are compared part with part
    whole = {(r["id"], r["rank"]): r["neighbour"] for r in forest.forest_neighbours(table, 5, 1, 20, target=1.0).collect()}
    assert whole == {(i, p + 1): j for i, own in near.items() for p, j in enumerate(own)}
