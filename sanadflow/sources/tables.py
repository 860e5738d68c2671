"""Reading the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``folder`` (one file or a directory of parts)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
