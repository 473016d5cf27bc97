"""What ``__spark_entry__`` adds when this subpackage is there: the operators' queries and the pipeline."""

from __future__ import annotations

import corpus_pipeline

from riskframe.llm.queries import Q


def text_queries() -> dict:
    return Q.queries | {"pipeline": corpus_pipeline.run}


def text_sql() -> dict[str, str]:
    return Q.sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
