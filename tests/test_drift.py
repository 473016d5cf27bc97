from itertools import combinations
from math import exp

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.catalog import monitoring
from riskframe.functions.kolmogorov import asymptotic_p, exact_equal_sizes_p, exact_two_sample_p
from riskframe.operators import drift as D
from tests.conftest import DATA


def ks(a, b):
    points = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return float(np.abs(fa - fb).max())


@pytest.mark.parametrize("n, m", [(3, 3), (4, 3), (5, 5), (6, 4)])
def test_exact_p_by_enumeration(n, m):
    total = n + m
    distances = []
    for chosen in combinations(range(total), n):
        other = [i for i in range(total) if i not in chosen]
        distances.append(ks(np.array(chosen), np.array(other)))
    for d in sorted(set(np.round(distances, 12))):
        want = np.mean(np.array(distances) >= d - 1e-9)
        assert exact_two_sample_p(d, n, m) == pytest.approx(want, abs=1e-12)
    assert exact_two_sample_p(0.0, n, m) == 1.0


def test_exact_p_of_equal_samples_in_closed_form():
    n, h = 50, 14
    log = np.cumsum(np.concatenate([[0], np.log(np.arange(1, 2 * n + 1))]))
    term = lambda k: exp(2 * log[n] - log[n + k * h] - log[n - k * h]) if k * h <= n else 0.0
    want = 2 * sum((-1) ** (k + 1) * term(k) for k in range(1, n // h + 1))
    assert exact_two_sample_p(h / n, n, n) == pytest.approx(want, rel=1e-10)


def one_sample_p(d, n):
    """Exact one-sample distribution by the matrix power of Marsaglia, Tsang and Wang (2003)."""
    k = int(n * d) + 1
    h, m = k - n * d, 2 * k - 1
    grid = np.array([[1.0 if i - j + 1 >= 0 else 0.0 for j in range(m)] for i in range(m)])
    for i in range(m):
        grid[i, 0] -= h ** (i + 1)
        grid[m - 1, i] -= h ** (m - i)
    grid[m - 1, 0] += (2 * h - 1) ** m if 2 * h - 1 > 0 else 0
    for i in range(m):
        for j in range(m):
            for g in range(1, i - j + 2):
                grid[i, j] /= g
    power, result, base, scale = n, np.eye(m), grid, 0.0
    while power:
        if power % 2:
            result = result @ base
        base = base @ base
        power //= 2
    value = result[k - 1, k - 1] * np.exp(scale)
    for i in range(1, n + 1):
        value *= i / n
    return 1 - value


@pytest.mark.parametrize("n, d", [(60, 0.1), (60, 0.15), (60, 0.2), (100, 0.08), (100, 0.13)])
def test_asymptotic_p_follows_the_finite_sample_distribution(spark, n, d):
    row = spark.createDataFrame([(d, 2 * n, 2 * n)], "d double, n long, m long")
    got = row.select(asymptotic_p(F.col("d"), F.col("n"), F.col("m")).alias("p")).first()["p"]
    assert got == pytest.approx(one_sample_p(d, n), abs=2e-3)


@pytest.mark.parametrize("partitions", [1, 7])
def test_distance_and_skips(spark, partitions):
    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(0, 1, 300), 1), np.round(rng.normal(0.3, 2, 200), 1)
    ref = spark.createDataFrame([(float(x), str(x), None) for x in a], "v double, t string, gone double")
    cur = spark.createDataFrame([(float(x), "junk" if i % 10 == 0 else str(x), 1.0) for i, x in enumerate(b)], "v double, t string, gone double")
    got = {r["column"]: r for r in D.ks_statistic(ref.repartition(partitions), cur, ["v", "t", "gone"]).collect()}
    assert set(got) == {"v", "t"}  # a side without numbers is skipped
    assert got["v"]["ks_statistic"] == pytest.approx(ks(a, b), abs=1e-12)
    kept = np.array([x for i, x in enumerate(b) if i % 10])
    assert got["t"]["ks_statistic"] == pytest.approx(ks(a, kept), abs=1e-12)
    assert (got["t"]["n_ref"], got["t"]["n_cur"]) == (300, 180)


def frames(spark, n=50):
    ref = spark.createDataFrame([(i, i % 2, i, float(i)) for i in range(n)], "SK_ID_CURR long, TARGET int, FEATURE_A long, FEATURE_B double")
    cur = spark.createDataFrame([(i, i % 2, 10, float(i) + 5) for i in range(n)], ref.schema)
    return ref, cur


def test_report_on_shifted_columns(spark):
    report = D.drift_report(*frames(spark), target="TARGET", entity="SK_ID_CURR")
    rows = {r["column"]: r for r in report.columns.collect()}
    assert set(rows) == {"FEATURE_A", "FEATURE_B"} and rows["FEATURE_A"]["drift_detected"]
    summary = report.summary.first()
    assert summary["share_drifted_columns"] > 0 and summary["dataset_drift"] and summary["n_tested"] == 2


def test_constant_columns_are_dropped_and_reported(spark):
    ref, cur = frames(spark, 20)
    ref = ref.withColumns({"CONST": F.lit(1), "NOTHING": F.lit(None).cast("double"), "HALF": F.when(F.col("SK_ID_CURR") > 5, 1)})
    cur = cur.withColumns({"CONST": F.lit(2), "NOTHING": F.lit(1.0), "HALF": F.lit(1)})
    report = D.drift_report(ref, cur, target="TARGET", entity="SK_ID_CURR")
    assert report.dropped_constant == ["CONST", "NOTHING"]
    assert {r["column"] for r in report.columns.collect()} == {"FEATURE_A", "FEATURE_B", "HALF"}


def test_nothing_to_test(spark):
    ref, cur = frames(spark)
    for report in (
        D.drift_report(ref, cur, enabled=False),
        D.drift_report(ref.withColumn("FEATURE_A", F.lit(1)), cur, features=["FEATURE_A"]),
    ):
        row = report.summary.first()
        assert (row["n_tested"], row["share_drifted_columns"], row["dataset_drift"]) == (0, 0.0, False)
        assert report.columns.count() == 0


def test_column_choice(spark):
    ref, _ = frames(spark)
    assert D.monitored_columns(ref, ["FEATURE_B", "zz"], "TARGET", "SK_ID_CURR") == ["FEATURE_B"]
    assert D.monitored_columns(ref, ["zz"], "TARGET", "SK_ID_CURR") == ["FEATURE_A", "FEATURE_B"]
    assert D.monitored_columns(ref, (), "TARGET", "SK_ID_CURR", 1) == ["FEATURE_A"]
    report = D.drift_report(*frames(spark), target="TARGET", entity="SK_ID_CURR", max_features=1)
    assert report.not_monitored == ["FEATURE_B"]


def test_sampling_compares_fewer_rows(spark):
    report = D.drift_report(*frames(spark), target="TARGET", entity="SK_ID_CURR", reference_rows=20, current_rows=500)
    assert {(r["n_ref"], r["n_cur"]) for r in report.columns.collect()} == {(20, 50)}


@pytest.mark.parametrize(
    "drift, share, auto, force, reason",
    [
        (True, 0.5, True, False, "dataset_drift"),
        (True, 0.2, True, False, "threshold_not_met"),
        (False, 0.9, True, False, "threshold_not_met"),
        (True, 0.5, False, False, "threshold_not_met"),
        (False, 0.0, False, True, "manual_override"),
        (True, 0.5, True, True, "dataset_drift"),
    ],
)
def test_retrain_decision(spark, drift, share, auto, force, reason):
    summary = spark.createDataFrame([(share, drift)], "share_drifted_columns double, dataset_drift boolean")
    row = D.retrain_decision(summary, auto, force=force, command="go").first()
    assert row["reason"] == reason and row["triggered"] == (reason != "threshold_not_met")
    assert row["command"] == ("go" if row["triggered"] else None)


def test_exact_p_of_large_equal_samples_equals_the_walk():
    for n, h in ((1, 1), (50, 14), (400, 31), (3000, 90), (700, 700), (20, 1)):
        assert exact_equal_sizes_p(h, n) == pytest.approx(exact_two_sample_p(h / n, n, n), abs=1e-9)
    assert exact_equal_sizes_p(0, 5) == 1.0
    assert exact_equal_sizes_p(2000, 10**6) == pytest.approx(2 * exp(-4.0), rel=1e-2)


def test_registered_reports_read_both_halves_whole(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    old = events.filter("ts < '2024-01-16'").count()
    new = events.count() - old
    rows = {r["column"]: r for r in monitoring.drift_report_events(spark, DATA).collect()}
    assert set(rows) == {"value", "k", "is_click"}
    assert all((r["n_ref"], r["n_cur"]) == (old, new) for r in rows.values())
    assert {(r["n_ref"], r["n_cur"]) for r in monitoring.drift_report_halves(spark, DATA).collect()} == {(min(old, new),) * 2}


def test_many_groups_against_one_reference(spark):
    import random

    r = random.Random(8)
    draw = lambda: r.choice([None, float("nan"), round(r.gauss(0, 1), 1), 5.0])
    rows = [(r.choice(["ref", "a", "a", "b", None]), draw(), r.randrange(4)) for _ in range(900)]
    rows += [("one", 0.25, 1), ("none", None, 2), ("below", -99.0, 0), ("above", 99.0, 9)]
    df = spark.createDataFrame(rows, "g string, x double, `y.z` int").repartition(5)
    got = {(p["g"], p["column"]): tuple(p)[2:] for p in D.ks_statistic_by(df, ["x", "y.z"], "g", F.col("g") == "ref").collect()}
    reference = df.filter("g = 'ref'")
    want = {}
    for g in ("a", "b", None, "one", "none", "below", "above"):
        own = df.filter(F.col("g").eqNullSafe(F.lit(g)))
        for p in D.ks_statistic(reference, own, ["x", "y.z"]).collect():
            want[g, p["column"]] = tuple(p)[1:]
    assert set(got) == set(want)
    for key, (distance, *sizes) in want.items():
        assert got[key][0] == pytest.approx(distance, abs=1e-12) and list(got[key][1:]) == sizes


def test_groups_are_compared_in_one_reading(spark):
    df = spark.createDataFrame([(i % 3, float(i)) for i in range(30)], "g int, x double")
    assert D.ks_statistic_by(df.filter("g > 0"), ["x"], "g", F.col("g") == 0).count() == 0  # no reference
    assert D.ks_statistic_by(df.filter("g = 0"), ["x"], "g", F.col("g") == 0).count() == 0  # nothing else
