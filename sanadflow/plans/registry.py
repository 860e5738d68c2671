"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sanadflow.plans import corpus_queries, skew_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**skew_queries.QUERIES, **corpus_queries.QUERIES}
SQL: dict[str, str] = {**skew_queries.SQL, **corpus_queries.SQL}
