"""Loading the driver tables (``{sf_dir}/{name}.parquet``) with column pruning left to Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (lazy; files are listed anew, so files added since are seen)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
