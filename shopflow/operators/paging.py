"""Pages of a stored order without reading what lies before them.

``build`` stores rows range-partitioned by their order, one folder a range, each
row with its number within the range, and beside them one row of running counts
per part: so many rows of a range as a request is meant to read. Page k then is
in the one or two parts that its row numbers fall into. A part is no file of its
own but a stretch of row numbers in its range's sorted file, whose Parquet pages
are as long as a part, so that a request skips the others by their statistics. A
page far behind reads as much as the second one, no task holds more than a
range, and there are as few tasks, files and sampled rows as there are ranges,
however short the parts are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE, PART, ROW = "page_range", "page_part", "page_row"
#: rows of a range, about
RANGE_ROWS = 1_000_000
#: rows of a part
PART_ROWS = 1_000_000


def build(df: DataFrame, order: Sequence[str], path: str, part_rows: int = PART_ROWS) -> None:
    """Stores ``df`` in ``order`` (make it unique) below a new folder. Its rows
    are computed once, kept on the executors' disks to be counted, sampled and
    stored."""
    df = df.persist(StorageLevel.DISK_ONLY)
    try:
        rows = df.count()
        # the number counts a range's rows from 0: the lower 33 bits are those of the row
        placed = (df.repartitionByRange(max(1, math.ceil(rows / RANGE_ROWS)), *order)
                  .withColumn(RANGE, F.spark_partition_id()).sortWithinPartitions(RANGE, *order)
                  .withColumn(ROW, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
        (placed.write.partitionBy(RANGE).option("parquet.page.row.count.limit", min(part_rows, 20_000))
         .parquet(f"{path}/rows"))
        if not rows:
            (df.withColumn(ROW, F.lit(0).cast("long")).withColumn(RANGE, F.lit(0)).limit(0)
             .write.mode("overwrite").parquet(f"{path}/rows"))
    finally:
        df.unpersist()
    spark = df.sparkSession
    counts = (spark.read.parquet(f"{path}/rows")
              .groupBy(F.col(RANGE).cast("int").alias(RANGE), F.floor(F.col(ROW) / part_rows).cast("long").alias(PART))
              .agg(F.count(F.lit(1)).alias("n"), F.min(ROW).alias("first")))
    before = Window.orderBy(RANGE, PART).rowsBetween(Window.unboundedPreceding, -1)   # one row per part
    (counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
     .coalesce(1).write.parquet(f"{path}/counts"))


def parts_of(spark: SparkSession, path: str, page_no: int, size: int) -> list[tuple[int, int, int, int]]:
    """Parts that hold rows of a page: range, first row number in it, rows, and
    the rows before the part."""
    if page_no < 1 or size < 1:
        raise ValueError("page_no and size must be >= 1")
    first = (page_no - 1) * size
    held = (spark.read.parquet(f"{path}/counts")
            .filter((F.col("before") < first + size) & (F.col("before") + F.col("n") > first)))
    return [(r[RANGE], r["first"], r["n"], r["before"])
            for r in held.orderBy("before").collect()]   # as many as a page spans


def page(spark: SparkSession, path: str, order: Sequence[str], page_no: int, size: int) -> DataFrame:
    """1-based page of ``size`` rows; empty beyond the last one."""
    parts = parts_of(spark, path, page_no, size)
    if not parts:
        return spark.read.parquet(f"{path}/rows").drop(RANGE, ROW).limit(0)
    # per range the parts adjoin: one stretch of row numbers
    stretches: dict[int, tuple[int, int]] = {}
    for held, first, n, _ in parts:
        stretches[held] = (stretches.get(held, (first, 0))[0], first + n - 1)
    rows = None
    for held, (first, last) in stretches.items():
        own = spark.read.parquet(f"{path}/rows/{RANGE}={held}").filter(F.col(ROW).between(first, last)).drop(ROW)
        rows = own if rows is None else rows.unionByName(own)
    return rows.orderBy(*order).offset((page_no - 1) * size - parts[0][3]).limit(size)
