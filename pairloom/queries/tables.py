"""Readers of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def all_rows(spark: SparkSession, d: str, names: list[str], cols: list[str]) -> DataFrame:
    """UNION ALL of the columns of several tables."""
    out = None
    for n in names:
        t = table(spark, d, n).select(*cols, F.lit(n).alias("table_name"))
        out = t if out is None else out.unionByName(t)
    return out


TRAIN = ["train_source1", "train_source2", "train_source3"]
TEST = ["test_source1", "test_source2", "test_source3"]
