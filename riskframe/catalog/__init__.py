"""Queries over the benchmark tables, each with an independent SQL statement of the same result."""

from riskframe.catalog import (
    columns,
    encoding,
    evaluation,
    gates,
    loans,
    monitoring,
    quality,
    rollups,
    sampling,
    sources,
    streams,
    training,
)

MODULES = (rollups, columns, sources, encoding, sampling, quality, evaluation, monitoring, gates, loans, training, streams)


def all_queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.Q.queries.items()}


def all_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.Q.sql.items()}
