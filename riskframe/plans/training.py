"""Training: scale, classify, save. Everything fitted lives in one ``PipelineModel``.

Trees see a column only through its bins. Beyond ``GROUP_FROM`` rows the bins are therefore found first, and rows with the same
bins and target become one row with the sum of their weights, if that makes at most half as many. What a job of a tree costs then
follows the number of different rows. Sums at nodes are those over all rows; the draws of ``subsamplingRate`` and of a
forest's bootstrap are made per such group. Where bins leave few groups, each is dealt into parts by a hash of the
unbinned row, so that there are about ``DRAWN`` of them to draw from.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.expr import col, quoted
from riskframe.operators.encode import fit_scale
from riskframe.operators.frame import require_columns
from riskframe.operators.sampling import class_counts, class_weights, downsample_majority
from riskframe.operators.smote import smote
from riskframe.operators.sparse import Levels, fit_levels, sparse_structs, sparse_vectors, stored_vectors
from riskframe.operators.storage import stored
from riskframe.plans import sparse_logistic
from riskframe.plans.boosting import bin_edges
from riskframe.session import scratch_path, shared_folder

# Training defaults.
SEED = 42
TEST_SIZE = 0.2
SMOTE_RATIO = 0.2
BOOSTING = {"maxIter": 500, "stepSize": 0.05, "maxDepth": 5, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
LOGISTIC = {"maxIter": 500, "C": 1.0}
FOREST = {"numTrees": 300}

#: From so many rows on, trees are grown on groups of rows with equal bins.
GROUP_FROM = 200_000
#: So many groups, or parts of groups, are enough to draw from.
DRAWN = 200_000
#: Rows that a task gets at least before a small table is spread over more tasks. Boosting runs a job per level of each tree,
#: one after the other; there starting tasks takes longer than the work on few rows.
TASK_ROWS = {"forest": 5_000, "gbt": 25_000}

#: A block of sparse rows takes so many times the memory of the coefficients.
BLOCK_SHARE = 4
#: From so many places on, a logistic model on sparse vectors is fitted by ``sparse_logistic``, if it is asked for nothing but this.
WIDE = 150_000
WIDE_PARAMS = {"maxIter", "tol", "C", "maxBlockSizeInMB", "aggregationDepth", "threshold"}

WEIGHT = "__weight"


def _scaling(scale: Mapping[str, tuple[float, float]], columns: Sequence[str]) -> SQLTransformer:
    """Mean and population deviation written into one projection, so scoring stays a plain select."""
    terms = [
        f"(CAST({quoted(c)} AS DOUBLE) - ({scale[c][0]!r}D)) / {scale[c][1]!r}D AS __z{i}" for i, c in enumerate(columns)
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def build_classifier(kind: str, target: str, n_rows: int, balanced: bool, params: Mapping | None = None) -> Estimator:
    """An estimator of the named kind: ``gbt``, ``logistic`` or ``forest``."""
    common = {"labelCol": target, "featuresCol": "__features"}
    given = dict(params or {})
    if kind == "gbt":
        return GBTClassifier(**common, seed=SEED, **{**BOOSTING, **given})
    if balanced:
        common["weightCol"] = WEIGHT
    if kind == "logistic":
        merged = {**LOGISTIC, **given}
        penalty = 1.0 / (merged.pop("C") * n_rows)
        return LogisticRegression(**common, standardization=False, regParam=penalty, **merged)
    if kind == "forest":
        return RandomForestClassifier(**common, seed=SEED, **{**FOREST, **given})
    raise ValueError(f"unsupported model kind '{kind}'")


def _checkpoints(spark: SparkSession) -> None:
    """Long chains of training steps are cut in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def _as_saved(spark: SparkSession, model: PipelineModel, kind: str) -> PipelineModel:
    """A model fresh from fit carries a training summary that holds the session and the
    training plan and cannot always be shipped to executors; the saved form does not."""
    path = scratch_path(spark, f"fitted-{kind}")
    save_model(model, path)
    return load_model(path)


def _bins(scaled: DataFrame, columns: Sequence[str], bins: int) -> Bucketizer:
    """Bin numbers of the scaled columns; a value on an edge belongs to the lower bin, as it does in a tree."""
    edges = [np.nextafter(e, np.inf).tolist() or [0.0] for e in bin_edges(scaled, columns, bins)]
    splits = [[-float("inf"), *e, float("inf")] for e in edges]
    return Bucketizer(splitsArray=splits, inputCols=list(columns), outputCols=[f"__zb{i}" for i in range(len(columns))], handleInvalid="error")


def _groups(binned: DataFrame, bins: Sequence[str], whole: Sequence[str], target: str, n_rows: int, weighted: bool) -> DataFrame | None:
    """Rows of equal bins and target as one with their weights' sum; None where that would spare less than half of the rows."""
    cells = [*bins, target]
    different = binned.agg(F.approx_count_distinct(F.struct(*cells), 0.02)).first()[0]
    if 2 * different > n_rows:
        return None
    part = F.pmod(F.xxhash64(*whole), F.lit(max(1, DRAWN // max(different, 1)))).alias("__part")
    weight = F.sum(F.col(WEIGHT) if weighted else F.lit(1.0)).alias(WEIGHT)
    return stored(binned.groupBy(*cells, part).agg(weight), "row-groups")


def _spread(df: DataFrame, columns: Sequence[str], n_rows: int, kind: str) -> DataFrame:
    """The rows over as many tasks as are worth starting, each with the same rows in the same order every time."""
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    tasks = max(1, min(cores, n_rows // TASK_ROWS[kind]))
    if parts == tasks or (parts > tasks and (kind != "gbt" or tasks == cores)):
        return df
    return df.repartition(tasks, *columns).sortWithinPartitions(*columns)


def train(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    kind: str = "gbt",
    params: Mapping | None = None,
    balanced: bool = True,
) -> PipelineModel:
    """Column subset -> scaling -> classifier."""
    n_rows = df.count()
    classifier = build_classifier(kind, target, n_rows, balanced, params)
    spark = df.sparkSession
    _checkpoints(spark)
    require_columns(df, [*columns, target], "training table")
    data = df.select(*[col(c) for c in columns], col(target).cast("double").alias(target))
    if balanced and kind != "gbt":
        data = class_weights(data, target, WEIGHT)
    weighted = balanced and kind != "gbt"
    steps = [_scaling(fit_scale(data, columns), columns)]
    inputs = [f"__z{i}" for i in range(len(columns))]
    ready = steps[0].transform(data)
    if kind != "logistic":
        if n_rows >= GROUP_FROM:
            bins = _bins(ready, inputs, classifier.getMaxBins())
            groups = _groups(bins.transform(ready), bins.getOutputCols(), inputs, target, n_rows, weighted)
            if groups is not None:
                steps.append(bins)
                inputs, ready, n_rows, weighted = bins.getOutputCols(), groups, groups.count(), True
                classifier = classifier.setWeightCol(WEIGHT)
        ready = _spread(ready, [c for c in ready.columns if c in (*inputs, target, "__part")], n_rows, kind)
    steps.append(VectorAssembler(inputCols=inputs, outputCol="__features", handleInvalid="error"))
    return _as_saved(spark, PipelineModel([*steps, classifier.fit(steps[-1].transform(ready))]), kind)


@dataclass
class SparseModel:
    """Numbered levels of the category columns and a pipeline that scales numbers and classifies the sparse vectors of both; scores like a ``PipelineModel``."""

    levels: Levels
    pipeline: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        *scaling, classifier = self.pipeline.stages
        for step in scaling:
            df = step.transform(df)
        leading = [f"__z{i}" for i in range(classifier.numFeatures - self.levels.width)]
        return classifier.transform(sparse_vectors(df, self.levels, "__features", scaled=True, leading=leading))

    def save(self, path: str) -> None:
        self.levels.save(f"{path}/vocabulary")
        save_model(self.pipeline, f"{path}/pipeline")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SparseModel:
        return cls(Levels.load(spark, f"{path}/vocabulary"), load_model(f"{path}/pipeline"))


def _two_classes(df: DataFrame, target: str) -> bool:
    return {r[0] for r in class_counts(df, target).limit(3).collect()} == {0.0, 1.0}


def train_sparse(
    df: DataFrame,
    numeric: Sequence[str],
    categories: Sequence[str],
    target: str,
    kind: str = "logistic",
    params: Mapping | None = None,
    balanced: bool = True,
) -> SparseModel:
    """Like ``train`` on the one-hot form of the categories, however many levels they have.

    Vectors stay sparse: levels are scaled and not centred, which an intercept makes up for. Levels that training has not
    seen, and NULL, add nothing to a score. The model itself has a coefficient per level, in the driver, as any Spark ML model.
    """
    require_columns(df, [*numeric, *categories, target], "training table")
    spark = df.sparkSession
    data = df.select(*[col(c) for c in [*numeric, *categories]], col(target).cast("double").alias(target))
    classifier = build_classifier(kind, target, data.count(), balanced, params)
    _checkpoints(spark)
    if balanced and kind != "gbt":
        data = class_weights(data, target, WEIGHT)
    levels = fit_levels(data, categories)
    steps = [_scaling(fit_scale(data, numeric), numeric)] if numeric else []
    for step in steps:
        data = step.transform(data)
    leading = [f"__z{i}" for i in range(len(numeric))]
    width = len(numeric) + levels.width
    if kind == "logistic" and width >= WIDE and set(params or ()) <= WIDE_PARAMS and _two_classes(data, target):
        shaped, weight = sparse_structs(data, levels, "__features", True, leading), F.col(WEIGHT) if balanced else F.lit(1.0)
        return SparseModel(levels, PipelineModel([*steps, sparse_logistic.fit(shaped, width, "__features", target, weight, classifier)]))
    if kind == "logistic" and not classifier.isSet("maxBlockSizeInMB"):
        # a block costs a pass over all coefficients: large blocks keep that below the work on its rows
        classifier.setMaxBlockSizeInMB(BLOCK_SHARE * 8 * width / 2**20 + 1)
    ready = stored_vectors(data, levels, "__features", True, leading)
    return SparseModel(levels, _as_saved(spark, PipelineModel([*steps, classifier.fit(ready)]), kind))


def rebalance(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    smote_ratio: float | None = SMOTE_RATIO,
    downsample: bool = True,
    seed: int = SEED,
) -> DataFrame:
    """Synthetic minority rows up to the ratio, then every class cut to the smallest one."""
    if smote_ratio:
        df, key = smote(df, features, target, key, smote_ratio, seed=seed), "row_key"
    return downsample_majority(df, target, seed, key) if downsample else df


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
