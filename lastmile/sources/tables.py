"""Reading the test tables and the layer tables by path."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; filters and projections above it reach the scan."""
    return spark.read.parquet(table_path(sf_dir, name))

