"""A logistic model on sparse vectors with very many places.

The estimator of Spark ML keeps several vectors of all places per task, has tasks exchange them whole, and needs blocks of rows that
grow with the places. Here rows are packed into blocks of bounded size once. A pass reads the coefficients of a block's places,
and hands on sums for those places only; Spark adds them up. An executor holds one copy of the coefficients per Python worker.

The objective is that of Spark ML with ``standardization=False`` and a quadratic penalty: the weighted mean of the losses plus
``penalty / 2`` times the squares, the intercept left out. It is minimised by L-BFGS as there (ten steps back, the same
tests of an end), on numbers whose means are taken off without making the vectors dense. The vectors of the search lie in
files that the driver maps into memory.
"""

from __future__ import annotations

import math
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.storage import store
from riskframe.session import scratch_path, scratch_tables

#: Rows of a block, and blocks that are handed to a task at once.
BLOCK_ROWS = 8192
BLOCKS_AT_ONCE = 32
#: Settings that bound how many blocks are in memory at once, and bytes of a row group, which a reader loads whole.
AT_ONCE_SETTINGS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
GROUP_BYTES = 16 << 20
#: L-BFGS: steps back, share of the slope that a step must gain and may leave, passes of a line search.
MEMORY = 10
LEAST_GAIN, MOST_SLOPE, SEARCHES = 1e-4, 0.9, 20
#: Function values that the last one is held against.
LOOK_BACK = 10
#: Vectors are worked on in parts of so many numbers.
PART = 1 << 20

_BLOCK = "places binary, at binary, x binary, lengths binary, y binary, weight binary"
#: Rows of a pass that stand for no place: the loss, and the sums of the factors and of weight times y.
_LOSS, _FACTORS, _POSITIVE = -1, -2, -3


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK_ROWS):
            rows = batch.slice(first, BLOCK_ROWS)
            lists = rows.column("indices")
            lengths = np.diff(lists.offsets.to_numpy()).astype(np.int32)
            places, at = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            x = rows.column("values").flatten().to_numpy(zero_copy_only=False)
            y, weight = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("y", "weight"))
            parts = [places.astype(np.int32), at.astype(np.int32), x.astype(float), lengths, y.astype(float), weight.astype(float)]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], ["places", "at", "x", "lengths", "y", "weight"])


def blocks(vectors: DataFrame, features: str, target: str, weight: Column) -> DataFrame:
    """The rows packed into blocks: the block's places, per entry which of them and its number, and per row entries, target and weight."""
    rows = vectors.select(
        F.col(f"{features}.indices").alias("indices"), F.col(f"{features}.values").alias("values"),
        F.col(target).cast("double").alias("y"), weight.cast("double").alias("weight"),
    )
    spark = vectors.sparkSession
    path = scratch_path(spark, "blocks")
    rows.mapInArrow(_packed, _BLOCK).write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return spark.read.schema(_BLOCK).parquet(path)


def _sums(given: Broadcast | None, offset: float):
    """Per place of a block the sum of its numbers times the rows' factors: slopes of the loss, or weights if no coefficients are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = factors = positive = 0.0
        for batch in batches:
            found, sums = [], []
            for i in range(batch.num_rows):
                part = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)  # noqa: B023, E731
                places, at, x, lengths = part("places", np.int32), part("at", np.int32), part("x", float), part("lengths", np.int32)
                y, weight = part("y", float), part("weight", float)
                row = np.repeat(np.arange(len(y)), lengths)
                if given is None:
                    factor = weight
                    positive += float(weight @ y)
                else:
                    margin = np.bincount(row, x * given.value[places][at], len(y)) + offset
                    small = np.exp(-np.abs(margin))
                    loss += float(weight @ (np.log1p(small) + np.maximum(margin, 0.0) - y * margin))
                    factor = weight * (np.where(margin >= 0, 1.0, small) / (1.0 + small) - y)
                factors += float(factor.sum())
                found.append(places)
                sums.append(np.bincount(at, x * factor[row], len(places)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64)), pa.array(np.concatenate(sums))], ["place", "g"])
        yield pa.RecordBatch.from_arrays([pa.array([_LOSS, _FACTORS, _POSITIVE]), pa.array([loss, factors, positive])], ["place", "g"])

    return run


@contextmanager
def _few_blocks_at_once(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in AT_ONCE_SETTINGS}
    try:
        for k in before:
            spark.conf.set(k, str(BLOCKS_AT_ONCE))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _parts(n: int) -> list[slice]:
    return [slice(i, min(i + PART, n)) for i in range(0, n, PART)]


def _dot(a: np.ndarray, b: np.ndarray) -> float:
    return sum(float(a[s] @ b[s]) for s in _parts(len(a)))


def _combine(out: np.ndarray, a: np.ndarray, k: float, b: np.ndarray) -> None:
    """out = a + k b"""
    for s in _parts(len(out)):
        out[s] = a[s] + k * b[s]


class _Loss:
    """Value and slopes of the objective; the last place of a vector is the intercept of the numbers less their means."""

    def __init__(self, packed: DataFrame, penalty: float, vector) -> None:
        self.packed, self.penalty, self.means = packed, penalty, vector()
        special = self._pass(None, 0.0, self.means)
        self.weight, self.positive = special[_FACTORS], special[_POSITIVE]
        for s in _parts(len(self.means)):
            self.means[s] /= self.weight

    def _pass(self, given: Broadcast | None, offset: float, out: np.ndarray) -> dict[int, float]:
        found = self.packed.mapInArrow(_sums(given, offset), "place long, g double").groupBy("place").agg(F.sum("g").alias("g"))
        out[:] = 0.0
        special, spark = {}, self.packed.sparkSession
        with scratch_tables(spark):
            with _few_blocks_at_once(spark):
                path = store(found, "sums")
            rows = spark.read.schema("place long, g double").parquet(path).toArrow()  # a row per place
        for batch in rows.to_batches():
            place, g = (batch.column(c).to_numpy() for c in ("place", "g"))
            own = place >= 0
            out[place[own]] = g[own]
            special |= dict(zip(place[~own].tolist(), g[~own].tolist()))
        return special

    def intercept(self, at: np.ndarray) -> float:
        return float(at[-1]) - _dot(self.means[:-1], at[:-1])

    def __call__(self, at: np.ndarray, slopes: np.ndarray) -> float:
        given = self.packed.sparkSession.sparkContext.broadcast(np.asarray(at[:-1]))
        try:
            special = self._pass(given, self.intercept(at), slopes)
        finally:
            given.destroy()
        total, squares = special[_FACTORS], 0.0
        for s in _parts(len(at)):
            own = at[s]
            squares += float(own @ own)
            slopes[s] = (slopes[s] - self.means[s] * total) / self.weight + self.penalty * own
        slopes[-1] = total / self.weight
        return special[_LOSS] / self.weight + self.penalty / 2 * (squares - float(at[-1]) ** 2)


def _direction(out: np.ndarray, slopes: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """The two loops of L-BFGS over the steps and the changes of slopes, oldest first."""
    _combine(out, slopes, 0.0, slopes)
    shares = []
    for s, y in reversed(steps):
        shares.append(_dot(s, out) / _dot(s, y))
        _combine(out, out, -shares[-1], y)
    scale = _dot(*steps[-1]) / _dot(steps[-1][1], steps[-1][1]) if steps else 1.0
    _combine(out, out, scale - 1.0, out)
    for (s, y), share in zip(steps, reversed(shares)):
        _combine(out, out, share - _dot(y, out) / _dot(s, y), s)
    _combine(out, out, -2.0, out)


def _minimise(loss: _Loss, at: np.ndarray, vector, most: int, tol: float) -> np.ndarray:
    slopes, trial, trial_slopes, way = (vector() for _ in range(4))
    value = start = loss(at, slopes)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    last = [value]
    for turn in range(most):
        if math.sqrt(_dot(slopes, slopes)) <= max(tol * abs(value), 1e-8):
            break
        _direction(way, slopes, steps)
        slope = _dot(slopes, way)
        length, low, high = (1.0 if steps else 1.0 / math.sqrt(-slope)), 0.0, math.inf
        for _ in range(SEARCHES):
            _combine(trial, at, length, way)
            reached = loss(trial, trial_slopes)
            if not reached <= value + LEAST_GAIN * length * slope:
                high = length
            elif _dot(trial_slopes, way) < MOST_SLOPE * slope:
                low = length
            else:
                break
            length = (low + high) / 2 if high < math.inf else 2 * length
        if not reached < value:
            break
        s, y = steps.pop(0) if len(steps) == MEMORY else (vector(), vector())
        _combine(s, trial, -1.0, at)
        _combine(y, trial_slopes, -1.0, slopes)
        if _dot(s, y) > 0:
            steps.append((s, y))
        at, trial, slopes, trial_slopes, value = trial, at, trial_slopes, slopes, reached
        if abs(value - max(last)) <= tol * abs(start):
            break
        last = [*last, value][-LOOK_BACK:]
    return at


def _model(spark: SparkSession, classifier: LogisticRegression, coefficients: np.ndarray, intercept: float) -> LogisticRegressionModel:
    """The model as Spark ML has it; numbers go to the JVM in parts."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    values = gateway.new_array(jvm.double, len(coefficients))
    for s in _parts(len(coefficients)):
        part = np.ascontiguousarray(coefficients[s], ">f8")
        jvm.java.nio.ByteBuffer.wrap(part.tobytes()).asDoubleBuffer().get(values, s.start, len(part))
    vector = jvm.org.apache.spark.ml.linalg.DenseVector(values)
    model = jvm.org.apache.spark.ml.classification.LogisticRegressionModel(classifier.uid, vector, float(intercept))
    return classifier._copyValues(classifier._create_model(model))


def fit(vectors: DataFrame, width: int, features: str, target: str, weight: Column, classifier: LogisticRegression) -> LogisticRegressionModel:
    """Fits 0/1 targets on sparse vectors of ``width`` places, with the penalty, ``maxIter`` and ``tol`` of the classifier."""
    packed = blocks(vectors, features, target, weight)
    folder = tempfile.mkdtemp(prefix="riskframe-search-")
    try:
        made = 0

        def vector() -> np.ndarray:
            nonlocal made
            made += 1
            return np.memmap(f"{folder}/{made}", float, "w+", shape=width + 1)

        loss = _Loss(packed, classifier.getRegParam(), vector)
        at = vector()
        share = loss.positive / loss.weight
        at[-1] = math.log(share / (1.0 - share))
        at = _minimise(loss, at, vector, classifier.getMaxIter(), classifier.getTol())
        return _model(vectors.sparkSession, classifier, at[:-1], loss.intercept(at))
    finally:
        shutil.rmtree(folder, ignore_errors=True)
