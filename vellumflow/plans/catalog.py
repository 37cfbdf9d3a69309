"""All queries of the reference's own operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellumflow.plans import collection_queries, detail_queries, search_queries, state_queries, structure_queries, text_queries

Query = Callable[[SparkSession, str], DataFrame]
_ALL = text_queries.QUERIES | structure_queries.QUERIES | search_queries.QUERIES | state_queries.QUERIES | detail_queries.QUERIES | collection_queries.QUERIES


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
