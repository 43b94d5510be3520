"""Parquet / CSV scans with declared columns (pruned at the scan)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one parquet table; selecting columns here keeps the ReadSchema narrow. How many splits it has is
    the deployer's choice (table layout, ``spark.sql.files.maxPartitionBytes``)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header and a declared schema (no inference pass over the data)."""
    return spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE").csv(path)
