import numpy as np
import pytest

from riskframe.operators import metrics as M


def scored(spark, y, s, p=None):
    p = p if p is not None else [int(v >= 0.5) for v in s]
    return spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(y, s, p)], "y int, s double, p int")


def brute_auc(y, s):
    y, s = np.array(y), np.array(s)
    gap = s[y == 1][:, None] - s[y == 0][None, :]
    return float(((gap > 0) + 0.5 * (gap == 0)).mean())


Y = [0, 1, 1, 0, 1]
S = [0.2, 0.8, 0.6, 0.4, 0.3]


@pytest.mark.parametrize("n, levels", [(5, 0), (400, 7), (1000, 100000)])
def test_auc_with_and_without_ties(spark, n, levels):
    rng = np.random.default_rng(n)
    y = Y if n == 5 else rng.integers(0, 2, n)
    s = S if n == 5 else np.round(rng.random(n) * levels) / levels
    df = scored(spark, y, s)
    row = M.evaluate(df, "y", "p", "s").first()
    assert row["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert row["normalized_gini"] == pytest.approx(2 * row["roc_auc"] - 1)
    again = M.roc_auc(df.repartition(5), "y", "s").first()
    assert again["roc_auc"] == row["roc_auc"]


def test_one_class_has_no_auc(spark):
    row = M.evaluate(scored(spark, [1, 1], [0.2, 0.9]), "y", "p", "s").first()
    assert row["roc_auc"] is None and row["normalized_gini"] is None and row["recall"] == 0.5


def test_zero_division_gives_zero(spark):
    row = M.binary_metrics(scored(spark, [0, 1], [0.1, 0.2]), "y", "p").first()
    assert tuple(row) == (0.5, 0.0, 0.0, 0.0)


def test_confusion_has_four_cells(spark):
    rows = {(r["y_true"], r["y_pred"]): r["n_rows"] for r in M.confusion_counts(scored(spark, Y, S), "y", "p").collect()}
    assert rows == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 2}


def test_curves_by_hand(spark):
    df = scored(spark, [0, 1, 1, 0], [0.1, 0.4, 0.4, 0.8])
    roc = {(r["threshold"], r["fpr"], r["tpr"]) for r in M.roc_points(df, "y", "s").collect()}
    assert roc == {(None, 0.0, 0.0), (0.8, 0.5, 0.0), (0.4, 0.5, 1.0), (0.1, 1.0, 1.0)}
    pr = {(r["threshold"], r["precision"], r["recall"]) for r in M.pr_points(df, "y", "s").collect()}
    assert pr == {(None, 1.0, 0.0), (0.8, 0.0, 0.0), (0.4, 2 / 3, 1.0), (0.1, 0.5, 1.0)}


def test_calibration_edges(spark):
    df = scored(spark, [0, 1, 1, 0, 1], [0.0, 0.1, 0.10001, 0.3, 1.0])
    rows = {r["bin"]: (r["n_rows"], r["observed_rate"]) for r in M.calibration_bins(df, "y", "s").collect()}
    assert rows == {0: (2, 0.5), 1: (1, 1.0), 2: (1, 0.0), 9: (1, 1.0)}


def test_groups_are_independent(spark):
    rng = np.random.default_rng(1)
    y, s, g = rng.integers(0, 2, 300), np.round(rng.random(300), 2), rng.integers(0, 3, 300)
    df = spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(y, s, g)], "y int, s double, g int")
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(df, "y", "s", ["g"]).collect()}
    for k in range(3):
        assert got[k] == pytest.approx(brute_auc(y[g == k], s[g == k]), abs=1e-12)


def test_compact_roc_keeps_the_ends_of_straight_stretches(spark, monkeypatch):
    import random

    from riskframe.operators import metrics as M
    from riskframe.operators import ordering

    r = random.Random(2)
    rows = [(g, float(s), r.choice([0, 1])) for g in ("a", None) for s in range(60) for _ in range(r.choice([1, 1, 2]))]
    rows += [("b", 1.0, 1), ("b", 2.0, 0)] + [("c", float(i), 1) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, s double, y int")
    for slices in (2, 5, 40):
        monkeypatch.setattr(ordering, "shuffle_parallelism", lambda *_, n=slices: n)
        got = {}
        for p in M.roc_points(df, "y", "s", ["g"], compact=True).collect():
            got.setdefault(p["g"], set()).add(p["threshold"])
        for g in ("a", None, "b", "c"):
            steps = {}
            for _, s, y in [x for x in rows if x[0] == g]:
                pos, neg = steps.get(s, (0, 0))
                steps[s] = (pos + y, neg + 1 - y)
            falling = sorted(steps, reverse=True)
            want = {None, falling[0], falling[-1]}
            want |= {s for s, after in zip(falling, falling[1:]) if steps[s] != steps[after]}
            assert got[g] == want
