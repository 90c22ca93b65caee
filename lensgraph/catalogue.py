"""Every query of the engine and its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lensgraph.plans import layer_queries, relation_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**layer_queries.QUERIES, **relation_queries.QUERIES}
ORACLE_SQL: dict[str, str] = {**layer_queries.ORACLE_SQL, **relation_queries.ORACLE_SQL}
