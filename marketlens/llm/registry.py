"""Queries and DuckDB SQL of this subpackage, the corpus pipeline included."""

from __future__ import annotations

from marketlens.llm.queries import ORACLE_SQL, QUERIES


def queries() -> dict:
    import corpus_pipeline
    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline
    return ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
