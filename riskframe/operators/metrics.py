"""Evaluation of binary scores. Every measure takes ``by`` columns, so many runs are one query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.expr import col
from riskframe.operators.ordering import add_slices, running_totals, slice_points


def _ratio0(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _outcomes(label: str, prediction: str) -> dict[str, Column]:
    actual, said = col(label) == 1, col(prediction) == 1
    return {
        "tp": F.count_if(actual & said),
        "fp": F.count_if(~actual & said),
        "fn": F.count_if(actual & ~said),
        "tn": F.count_if(~actual & ~said),
    }


def binary_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 from one aggregate; an empty denominator gives 0."""
    counts = df.groupBy(*by).agg(*[c.alias(n) for n, c in _outcomes(label, prediction).items()])
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by,
        _ratio0(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio0(tp, tp + fp).alias("precision"),
        _ratio0(tp, tp + fn).alias("recall"),
        _ratio0(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """All four cells, empty ones included."""
    counts = df.groupBy(*by).agg(*[c.alias(n) for n, c in _outcomes(label, prediction).items()])
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    lines = F.array(
        *[
            F.struct(F.lit(t).alias("y_true"), F.lit(p).alias("y_pred"), F.col(n).alias("n_rows"))
            for t, p, n in cells
        ]
    )
    return counts.select(*by, F.explode(lines).alias("c")).select(*by, "c.*")


GROUP = "__group"


def score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, with the score's slice.

    Rows collapse to distinct scores before anything is sorted, so a score
    shared by a third of all rows is one row here. Rows without a score do not
    count. The ``by`` columns travel as one struct, so a NULL group is a group.
    """
    group = F.struct(*[col(c) for c in by] or [F.lit(0)]).alias(GROUP)
    known = df.select(group, col(label).alias("__y"), col(score).cast("double").alias("score")).filter(
        "score is not null and not isnan(score)"
    )
    sliced = add_slices(known, slice_points(known, ["score"]))
    return sliced.groupBy(GROUP, "__slice_0", "score").agg(
        F.count_if(F.col("__y") == 1).alias("pos"), F.count_if(F.col("__y") != 1).alias("neg")
    )


def _ungroup(by: Sequence[str]) -> list[Column]:
    return [F.col(GROUP).getField(c).alias(c) for c in by]


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL when a class is absent.

    The area is the share of (positive, negative) pairs in the right order.
    Pairs within a slice are summed inside it; pairs across slices follow from
    the slice totals, so only those are accumulated over the whole range.
    """
    lower = Window.partitionBy(GROUP, "__slice_0").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    below = F.coalesce(F.sum("neg").over(lower), F.lit(0)).cast("double")
    slices = (
        score_counts(df, label, score, by)
        .withColumn("won", pos * (below + neg / 2))
        .groupBy(GROUP, "__slice_0")
        .agg(F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    earlier = Window.partitionBy(GROUP).orderBy("__slice_0").rowsBetween(Window.unboundedPreceding, -1)
    across = pos * F.coalesce(F.sum("neg").over(earlier), F.lit(0)).cast("double")
    totals = slices.withColumn("won", F.col("won") + across).groupBy(GROUP).agg(
        F.sum("won").alias("won"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    found = totals.select(*_ungroup(by), "n_pos", "n_neg", F.try_divide("won", pairs).alias("roc_auc"))
    if by:
        return found
    # an empty input still has an answer: no rows of either class
    return found.agg(
        F.coalesce(F.sum("n_pos"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("n_neg"), F.lit(0)).alias("n_neg"),
        F.max("roc_auc").alias("roc_auc"),
    )


def normalized_gini(auc: Column | str) -> Column:
    auc = col(auc) if isinstance(auc, str) else auc
    return F.when(auc.isNotNull(), F.greatest(F.least(2 * auc - 1, F.lit(1.0)), F.lit(-1.0)))


def evaluate(df: DataFrame, label: str, prediction: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """All scalar measures, one row per ``by`` group."""
    area = roc_auc(df, label, score, by).select(
        *by, "roc_auc", normalized_gini("roc_auc").alias("normalized_gini")
    )
    basic = binary_metrics(df, label, prediction, by)
    if by:
        return _null_safe_left(basic, area, by)
    keyed = [d.withColumn("__one", F.lit(1)) for d in (basic, area)]
    return keyed[0].join(keyed[1], "__one", "left").drop("__one")


def _null_safe_left(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    names = {c: f"__right_{i}" for i, c in enumerate(by)}
    renamed = right.withColumnsRenamed(names)
    same = [col(c).eqNullSafe(col(n)) for c, n in names.items()]
    return left.join(renamed, same, "left").drop(*names.values())


def metrics_table(metrics: DataFrame, run: str, names: Sequence[str]) -> DataFrame:
    """Wide measures as (run, metric, value) rows; absent values are left out."""
    return metrics.unpivot([run], list(names), "metric", "value").filter("value is not null")


def _with_corners(counts: DataFrame) -> DataFrame:
    """Adds ``corner``: whether the curve's step differs from the next one, that of the next lower score, or is the last.

    Inside a slice that is the row before; a slice's first row looks at the last one of the slice before,
    which comes from a table of slices.
    """
    step = F.struct("pos", "neg")
    before = F.lag(step).over(Window.partitionBy(GROUP, "__slice_0").orderBy("score"))
    edges = counts.groupBy(GROUP, "__slice_0").agg(F.max_by(step, "score").alias("edge"))
    carried = F.lag("edge").over(Window.partitionBy(GROUP).orderBy("__slice_0"))  # one row per slice
    lower = F.coalesce(before, F.col("edge"))
    joined = counts.join(edges.select(GROUP, "__slice_0", carried.alias("edge")), [GROUP, "__slice_0"])
    return joined.withColumn("corner", lower.isNull() | (lower != step)).drop("edge")


def _curve(
    df: DataFrame, label: str, score: str, by: Sequence[str], point: dict, end: dict, compact: bool = False
) -> DataFrame:
    """One row per distinct score from the counts at or above it, and one end row per group.

    ``point`` maps names to expressions over tp, fp, n_pos and n_neg; ``end`` to constants. ``compact`` leaves out
    scores whose step is repeated by the next one.
    """
    counts = score_counts(df, label, score, by)
    counts = _with_corners(counts) if compact else counts.withColumn("corner", F.lit(True))
    counted = running_totals(counts, "score", "__slice_0", ["pos", "neg"], [GROUP]).select(
        GROUP,
        "score",
        (F.col("pos__all") - F.col("pos__upto") + F.col("pos")).alias("tp"),
        (F.col("neg__all") - F.col("neg__upto") + F.col("neg")).alias("fp"),
        F.col("pos__all").alias("n_pos"),
        F.col("neg__all").alias("n_neg"),
        ((F.col("pos__upto") == F.col("pos__all")) & (F.col("neg__upto") == F.col("neg__all"))).alias("top"),
        "corner",
    )
    counted = counted.filter(F.col("corner") | F.col("top"))
    here = F.struct(F.col("score").alias("threshold"), *[e.alias(n) for n, e in point.items()])
    last = F.struct(F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(n) for n, v in end.items()])
    rows = F.when(F.col("top"), F.array(here, last)).otherwise(F.array(here))
    return counted.select(GROUP, F.explode(rows).alias("p")).select(*_ungroup(by), "p.*")


def _share(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def roc_points(df: DataFrame, label: str, score: str, by: Sequence[str] = (), compact: bool = False) -> DataFrame:
    """False and true positive rate at every distinct threshold, plus the origin (no threshold).

    ``compact`` keeps of a straight stretch of equal steps its ends only, as plots and reports want it.
    """
    point = {"fpr": _share(F.col("fp"), F.col("n_neg")), "tpr": _share(F.col("tp"), F.col("n_pos"))}
    return _curve(df, label, score, by, point, {"fpr": 0.0, "tpr": 0.0}, compact)


def pr_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct threshold, plus the end point (precision 1, recall 0)."""
    point = {
        "precision": _share(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": _share(F.col("tp"), F.col("n_pos")),
    }
    return _curve(df, label, score, by, point, {"precision": 1.0, "recall": 0.0})


def calibration_bins(df: DataFrame, label: str, probability: str, n_bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean score and observed rate per equal-width bin; empty bins do not appear.

    A value on an inner edge belongs to the lower bin.
    """
    p = col(probability).cast("double")
    edges = [i * (1.0 / n_bins) for i in range(1, n_bins)]
    above = [(p > F.lit(e)).cast("int") for e in edges]
    bin_no = sum(above[1:], above[0]) if above else F.lit(0)
    return (
        df.filter(p.isNotNull())
        .groupBy(*by, bin_no.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(p).alias("mean_score"),
            F.avg((col(label) == 1).cast("double")).alias("observed_rate"),
        )
    )
