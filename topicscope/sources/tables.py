"""Parquet tables of a test-data folder (``<dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; selecting columns afterwards prunes the read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
