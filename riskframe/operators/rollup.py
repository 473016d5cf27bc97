"""History roll-ups: many child rows -> one row per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.expr import col

Aggregates = Mapping[str, Column]


def _named(aggregates: Aggregates) -> list[Column]:
    return [value.alias(name) for name, value in aggregates.items()]


def single_level_rollup(child: DataFrame, key: str, aggregates: Aggregates) -> DataFrame:
    return child.groupBy(col(key)).agg(*_named(aggregates))


def ratio_of(parts: DataFrame, name: str, num: str, den: str) -> DataFrame:
    """A ratio of two finished aggregates, e.g. a status count over a distinct count."""
    return parts.withColumn(name, F.try_divide(col(num).cast("double"), col(den).cast("double")))


def attach_to_entity(
    child: DataFrame, link: DataFrame, key: str, entity: str, how: str = "inner", hot: Sequence = ()
) -> DataFrame:
    """Brings the entity id to child rows through a link table.

    Inner drops children without a link; left keeps them under a NULL entity.
    A link key that occurs twice repeats its children. Only the two link
    columns are read, so several roll-ups over the same link share one exchange.
    ``hot`` are keys of very many children (``frequent_keys`` of the child table): those children
    stay where they are, and the link rows of the few keys are broadcast to them.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"attach supports inner and left, not {how!r}")
    pairs = link.select(col(key), col(entity))
    if not hot:
        return child.join(pairs, key, how)
    is_hot = F.coalesce(col(key).isin(list(hot)), F.lit(False))
    cold = child.filter(~is_hot).join(pairs.filter(~is_hot), key, how)
    return cold.unionByName(child.filter(is_hot).join(F.broadcast(pairs.filter(is_hot)), key, how))


#: Default of the ``at_least`` and ``hot_from`` arguments: rows of one link key that one join task should not get alone.
HOT_FROM = 1_000_000


def frequent_keys(link: DataFrame, key: str, share: float = 0.001, at_least: int = HOT_FROM) -> list:
    """Link keys that repeat so often that one join task would feel it (at most 1/share of them).

    One scan without a shuffle finds candidates and misses none; a second counts them.
    """
    candidates = link.select(col(key)).stat.freqItems([key], share).first()[0]
    if not candidates:
        return []
    counted = link.filter(col(key).isin(candidates)).groupBy(col(key)).count().filter(F.col("count") >= at_least)
    return [r[0] for r in counted.collect() if r[0] is not None]


def _attach_first_level(
    first: DataFrame, link: DataFrame, key: str, entity: str, how: str, hot: Sequence
) -> DataFrame:
    """Joins one row per key to a link table in which some keys may repeat very often.

    The few first-level rows of those keys (one per key) are broadcast to their
    link rows, which stay where they are; everything else joins by shuffle.
    """
    if not hot:
        return attach_to_entity(first, link, key, entity, how)
    is_hot = F.coalesce(col(key).isin(list(hot)), F.lit(False))
    cold = attach_to_entity(first.filter(~is_hot), link.filter(~is_hot), key, entity, how)
    few = link.filter(is_hot).select(col(key), col(entity)).join(F.broadcast(first.filter(is_hot)), key)
    return cold.unionByName(few)


def two_level_rollup(
    child: DataFrame,
    child_key: str,
    level1: Aggregates,
    link: DataFrame,
    entity: str,
    level2: Aggregates,
    how: str = "inner",
    hot_links: Sequence = (),
) -> DataFrame:
    """Aggregate per child key, attach the entity, aggregate again.

    Both aggregates are combined on the map side first, so a child key or an
    entity with a large share of all rows sends only partial results. The first
    aggregate and the join use the same key and therefore the same exchange.
    ``hot_links`` are link keys known to repeat very often (``frequent_keys``).
    """
    first = child.groupBy(col(child_key)).agg(*_named(level1))
    attached = _attach_first_level(first, link, child_key, entity, how, hot_links)
    return attached.groupBy(col(entity)).agg(*_named(level2))
