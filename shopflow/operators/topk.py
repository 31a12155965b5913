"""Top-N term buckets and result paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bucket_counts(df: DataFrame, term: str, group: Sequence[str] = ()) -> DataFrame:
    """``doc_count`` per group and term, NULL term included (partial agg)."""
    return df.groupBy(*group, term).agg(F.count(F.lit(1)).alias("doc_count"))


def top_buckets(counts: DataFrame, term: str, n: int, group: Sequence[str] = ()) -> DataFrame:
    """The ``n`` biggest non-NULL buckets per group of pre-aggregated counts
    (ties by term); the window only sees one row per group and term."""
    w = Window.partitionBy(*group).orderBy(F.desc("doc_count"), F.asc(term))
    return (counts.filter(F.col(term).isNotNull())
            .withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= n))


def top_terms(df: DataFrame, term: str, n: int, group: Sequence[str] = ()) -> DataFrame:
    """Terms aggregation: count per term (NULL terms skipped), the ``n``
    biggest buckets per group, ties broken by term.

    Counting is a partial aggregation; the ranking window then runs over the
    aggregated buckets only (one row per group and term), never over raw rows.
    Output: ``*group, term, doc_count, rank``."""
    counts = bucket_counts(df.filter(F.col(term).isNotNull()), term, group)
    return top_buckets(counts, term, n, group)


def page(df: DataFrame, order: Sequence, page_no: int, size: int) -> DataFrame:
    """1-based page of ``size`` rows in ``order`` (make the order unique).

    ``orderBy().offset().limit()`` plans as a take-ordered of
    ``page_no * size`` rows: each task keeps a bounded heap, no global sort."""
    if page_no < 1 or size < 1:
        raise ValueError("page_no and size must be >= 1")
    return df.orderBy(*order).offset((page_no - 1) * size).limit(size)
