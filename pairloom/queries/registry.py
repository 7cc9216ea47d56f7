"""All core queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairloom.queries import records, scoring, shape

MODULES = [shape, records, scoring]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return queries()["p2_found"](spark, d)
