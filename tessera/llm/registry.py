"""Queries and SQL of this subpackage, and the pipeline's."""

from __future__ import annotations

import corpus_pipeline
from tessera.llm import op_queries


def queries():
    return op_queries.queries() | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return op_queries.oracle_sql() | own
