"""Scoring of batches and streams with a fitted model or a known formula."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame

from riskframe.functions.expr import col, decide
from riskframe.operators.frame import with_entity_or_row_id

DECISION_THRESHOLD = 0.5


def _at_bins(model) -> tuple[PipelineModel | None, PipelineModel | None]:
    """The steps up to the bins of a model that reads nothing but bins, and those behind; two None for other models."""
    stages = model.stages if isinstance(model, PipelineModel) else []
    at = next((i + 1 for i, step in enumerate(stages) if isinstance(step, Bucketizer)), 0)
    return (PipelineModel(stages[:at]), PipelineModel(stages[at:])) if at else (None, None)


def add_scores(df: DataFrame, model: PipelineModel | Column, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Adds ``probability`` and ``prediction``; the same call serves batches and streams.

    A model without probabilities contributes its own hard prediction only. A model grown on groups of rows with equal bins
    scores each group of a batch once, and the rows take their group's score; the batch is read twice for that.
    """
    if isinstance(model, Column):
        scored = df.withColumn("probability", model)
        return scored.withColumn("prediction", decide("probability", threshold))
    binning, classifier = _at_bins(model)
    if binning and not df.isStreaming and not {"probability", "prediction"} & set(df.columns):
        binned, bins = binning.transform(df), binning.stages[-1].getOutputCols()
        cores = df.sparkSession.sparkContext.defaultParallelism  # hundreds of trees per group: work for all cores
        groups = add_scores(binned.select(*bins).distinct().repartition(cores, *bins), classifier, threshold)
        helpers = [c for c in binned.columns if c not in df.columns]
        return binned.join(groups, bins, "left").drop(*helpers)
    raw = model.transform(df)
    helpers = [c for c in raw.columns if c.startswith("__z") or c in ("__features", "rawPrediction")]
    raw = raw.drop(*[c for c in helpers if c not in df.columns])
    if "probability" not in raw.columns:
        return raw.withColumn("prediction", col("prediction").cast("int"))
    scored = raw.withColumn("probability", vector_to_array("probability")[1])
    return scored.withColumn("prediction", decide("probability", threshold))


def score(
    df: DataFrame,
    model: PipelineModel | Column,
    threshold: float = DECISION_THRESHOLD,
    entity: str | None = None,
    order_key: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Entity (or row number in the order of ``order_key``), prediction and probability."""
    if not (entity and entity in df.columns) and order_key is None:
        raise ValueError("without an entity column an order_key is needed for row numbers")
    named, name = with_entity_or_row_id(df, entity, order_key or "")
    scored = add_scores(named, model, threshold)
    wanted = [name, "prediction", "probability", *keep]
    return scored.select(*[col(c) for c in wanted if c in scored.columns])


def evaluated_rows(df: DataFrame, model: PipelineModel | Column, target: str, entity: str, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Entity, truth, decision and probability of a labelled table."""
    return score(df, model, threshold, entity, keep=[target]).withColumnRenamed(target, "y_true")
