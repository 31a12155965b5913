"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.session import checkpoint_root

#: ASCII white space: space, tab, line feed, vertical tab, form feed, return
WHITE = r"[\x20\x09-\x0D]+"
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table, read by Spark (any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


#: rows that are sent to a Python worker at once: whole texts are long, and a
#: batch exists several times (in the executor, in the worker, as Python values)
ROWS_PER_BATCH = 1000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def python_ready(spark: SparkSession) -> None:
    """Let Python workers import this package where it is on the same path as
    on the driver (on other clusters ship it with ``--py-files``), and keep the
    batches that they get small."""
    if int(spark.conf.get(_ARROW_ROWS)) > ROWS_PER_BATCH:
        spark.conf.set(_ARROW_ROWS, str(ROWS_PER_BATCH))
    env = spark.sparkContext.environment
    if PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (PACKAGE_ROOT, env.get("PYTHONPATH")) if x)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's shared checkpoint folder and go on from
    there: the rows survive a lost executor and are not computed again."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_training(doc_id: Column) -> Column:
    """Rows a model may learn from: crc32 of the id as text, mod 4, is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4, F.lit(0)) != 2


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: Python values and results exist for
    one of them at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def pieces(n: float, each: float, least: int = 1) -> int:
    return max(least, math.ceil(n / each))
