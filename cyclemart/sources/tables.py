"""Readers for the Parquet tables a job starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``{root}/{name}.parquet`` (a file or a folder of part files), listed anew each time."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, root: str, names: list[str] | None = None) -> None:
    """Register each table as a temp view of the same name (for ``spark.sql``)."""
    for name in names or DRIVER_TABLES:
        read_table(spark, root, name).createOrReplaceTempView(name)
