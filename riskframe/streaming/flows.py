"""Scoring, audit and drift over arriving records."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from riskframe.functions.expr import col
from riskframe.operators.audit import audit_measures, audit_sums, measures_of_sums
from riskframe.operators.contract import Contract, mark_broken, quarantine, split_marked
from riskframe.operators.drift import (
    P_VALUE_THRESHOLD,
    drift_against,
    drift_metrics_row,
    prepare_reference,
    retrain_decision,
)
from riskframe.plans.scoring import DECISION_THRESHOLD, add_scores


#: Verdicts on the rows of a request.
FIRST, REPEATED, ABSENT = range(3)


def read_file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Files appearing in a folder, with an explicit schema and an optional rate limit."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def zoned(df: DataFrame, ts: str) -> DataFrame:
    """Event time as a zoned timestamp, which watermarks need."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def score_stream(
    stream: DataFrame, model: PipelineModel | Column, contract: Contract, threshold: float = DECISION_THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """Scored valid records and rejected records with reasons; both append-only."""
    valid, rejected = quarantine(stream, contract)
    return add_scores(valid, model, threshold), rejected


def score_to_tables(
    stream: DataFrame,
    model: PipelineModel | Column,
    contract: Contract,
    scored_path: str,
    rejected_path: str,
    checkpoint: str,
    threshold: float = DECISION_THRESHOLD,
) -> None:
    """Scored and rejected records from one reading of the source: each batch is checked once, held, and
    written to both tables. A batch that is replayed after a failure overwrites its own folders."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid, rejected = split_marked(batch)
            for rows, path in ((add_scores(valid, model, threshold), scored_path), (rejected, rejected_path)):
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    query = (
        mark_broken(stream, contract)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def audit_stream(
    scored: DataFrame,
    ts: str,
    window: str = "1 day",
    watermark: str | None = "1 day",
    probability: str | None = "probability",
    entity: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """Audit measures per tumbling window. Rows later than the watermark are not counted.

    Entities are counted approximately, or with ``exact`` by one more keyed state: rows are summed up per window and entity
    first, and those sums per window. That takes a watermark and append mode.
    """
    timed = scored.withWatermark(ts, watermark) if watermark else scored
    if exact and entity:
        if not watermark:
            raise ValueError("exact entity counts need a watermark, so that their state can go")
        return _exact_audit(timed, ts, window, probability, entity)
    measures = audit_measures(probability, entity=entity, exact=False)
    return (
        timed.groupBy(F.window(F.col(ts), window).alias("w"))
        .agg(*measures)
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*")
        .drop("w")
    )


def _exact_audit(timed: DataFrame, ts: str, window: str, probability: str | None, entity: str) -> DataFrame:
    """The audit measures, summed up per window and entity first."""
    per_entity = timed.groupBy(F.window(F.col(ts), window).alias("w"), col(entity).alias("entity")).agg(
        *audit_sums(probability)
    )
    whole = per_entity.groupBy(F.window(F.window_time("w"), window).alias("w")).agg(*measures_of_sums(probability, "entity"))
    return whole.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w")


def unique_requests(
    stream: DataFrame,
    entity: str,
    ts: str,
    order: str,
    window: str = "1 day",
    watermark: str = "1 hour",
    shares: int = 256,
) -> DataFrame:
    """Rows with ``reasons``: empty for the first row of its entity in its tumbling window, ``<entity>:unique`` for
    the others, ``<entity>:not_null`` without an entity. ``split_marked`` parts them.

    First means the earliest batch, in it the earliest time, and of equal times the least ``order`` (a whole number). Entities are
    judged together by hash, ``shares`` groups a window, because each group costs a call; a resumed stream must keep the number. The
    state has one entry per group and open window, which lists the entities seen, and goes when the watermark closes the window;
    rows that come for a closed window are dropped and counted by Spark (``numRowsDroppedByWatermark``), as in every windowed state, unless they have no entity.
    A group is read in pieces and keeps one row per entity, so a very frequent entity needs no memory, but its rows share a task.
    """
    odd = [f.name for f in stream.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    if odd:
        raise ValueError(f"columns of these types cannot be carried: {', '.join(odd)}")
    names = [f"c{i}" for i in range(len(stream.columns))]
    # passengers travel as text, which keeps whole numbers beside NULLs exact
    carried = stream.withWatermark(ts, watermark).select(
        F.window(F.col(ts), window).alias("w"),
        col(entity).cast("string").alias("entity"),
        F.unix_micros(F.col(ts)).alias("at"),
        col(order).cast("long").alias("turn"),
        *[col(c).cast("string").alias(n) for c, n in zip(stream.columns, names)],
    )
    share = F.pmod(F.xxhash64("entity"), F.lit(shares))
    # the window stays: by it the state knows what is late
    keyed = carried.withColumns({"closes": F.unix_millis("w.end"), "share": share})
    parts = T.StructType([T.StructField(n, T.StringType()) for n in names]).add("verdict", "integer")

    def judge(key: tuple, chunks, state):
        if state.hasTimedOut:
            state.remove()
            return
        seen = pd.Index(json.loads(state.get[0]) if state.exists else [], dtype=object)
        best = None
        for chunk in chunks:
            known = chunk["entity"].isin(seen)
            rows = chunk[~known] if best is None else pd.concat([best, chunk[~known]])
            rows = rows.sort_values(["at", "turn"], kind="stable")
            again = rows["entity"].duplicated()
            best = rows[~again]
            yield pd.concat([chunk.loc[known, names], rows.loc[again, names]]).assign(verdict=REPEATED)
        if best is not None and len(best):
            yield best[names].assign(verdict=FIRST)
            seen = seen.append(pd.Index(best["entity"], dtype=object))
        if key[1] > state.getCurrentWatermarkMs():  # otherwise nothing more can come for the window
            state.update((json.dumps(seen.to_list()),))
            state.setTimeoutTimestamp(int(key[1]))
        elif state.exists:
            state.remove()

    judged = keyed.filter("entity is not null").groupBy("share", "closes").applyInPandasWithState(
        judge, parts, "seen string", "append", GroupStateTimeout.EventTimeTimeout
    )
    alone = keyed.filter("entity is null").select(*names, F.lit(ABSENT).alias("verdict"))
    names_of = {REPEATED: f"{entity}:unique", ABSENT: f"{entity}:not_null"}
    reasons = F.array_compact(F.array(*[F.when(F.col("verdict") == v, F.lit(name)) for v, name in names_of.items()]))
    back = [F.col(n).cast(f.dataType).alias(f.name) for n, f in zip(names, stream.schema)]
    return judged.unionByName(alone).select(*back, reasons.alias("reasons"))


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there now into a Parquet table.

    Complete mode replaces the table with the latest state on every trigger.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").outputMode("append").start(path)
    else:
        query = (
            writer.outputMode(mode)
            .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
            .start()
        )
    query.awaitTermination()


def drift_batches(
    stream: DataFrame,
    reference: DataFrame,
    history_path: str,
    checkpoint: str,
    auto_retrain: bool = False,
    notify: Callable[[DataFrame, int], None] | None = None,
    threshold: float = P_VALUE_THRESHOLD,
    method: str = "asymptotic",
    **columns,
) -> StreamingQuery:
    """Compares every arriving batch with the reference and adds one history row per batch.

    The reference is read once, when the stream starts; ``columns`` are options of ``prepare_reference``.
    A batch that is replayed after a failure overwrites its own row.
    """
    prepared = prepare_reference(reference, **columns)

    def compare(batch: DataFrame, batch_id: int) -> None:
        report = drift_against(prepared, batch, threshold, method)
        decided = retrain_decision(report.summary, auto_retrain)
        row = drift_metrics_row(decided, "reference", f"batch {batch_id}")
        row.write.mode("overwrite").parquet(f"{history_path}/batch_id={batch_id}")
        if notify:
            notify(decided, batch_id)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(compare)
        .start()
    )
