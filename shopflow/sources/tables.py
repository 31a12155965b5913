"""Batch scans of the driver's parquet tables.

Scans are plain ``spark.read.parquet``: Catalyst prunes columns to what the
query uses and pushes filters into the parquet reader, so callers select and
filter on the returned DataFrame instead of pre-loading anything.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from shopflow.session import configure

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` is a pruned parquet scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(table_path(self.sf_dir, name))
