"""Readers for the parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it.

    How finely a scan is split is the session's choice
    (``spark.sql.files.maxPartitionBytes`` and ``minPartitionNum``).
    """
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
