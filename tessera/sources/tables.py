"""Readers for the parquet tables a run is given (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))
