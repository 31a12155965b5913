"""Inverted index of a text column, kept up batch by batch.

A posting is (token, day, document id). The stored table lies in one folder per
token bucket, so a search lists and reads only the buckets of its own tokens,
whatever the index holds; within them the files are sorted by token, so row
groups of other tokens are skipped by their statistics. A hot token's postings
are spread over its bucket's files and are combined by document id, never by
token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.functions.text import tokens
from shopflow.streaming import sinks

BUCKETS = 64
BUCKET_COL = "token_bucket"


def bucket_of(token: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def posting_rows(docs: DataFrame, doc_id: str, text: str, day: str, buckets: int = BUCKETS) -> DataFrame:
    """One row per document and distinct token: ``token, dt, doc_id`` and the
    token's bucket."""
    return (docs.select(F.col(day).alias("dt"), F.col(doc_id).cast("string").alias("doc_id"),
                        F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
            .withColumn(BUCKET_COL, bucket_of(F.col("token"), buckets)))


def write_postings(rows: DataFrame, batch_id: int, path: str) -> None:
    """Adds a batch's postings; a retried batch replaces its own."""
    # a hot token's bucket goes to as many tasks as its size needs
    sorted_ = rows.hint("rebalance", BUCKET_COL).sortWithinPartitions(BUCKET_COL, "token", "dt", "doc_id")
    sinks.write_batch(sorted_, batch_id, path, [BUCKET_COL])


def keyword_tokens(spark: SparkSession, keyword: str) -> list[str]:
    """The keyword's distinct tokens, by the same rule as the documents'."""
    return spark.range(1).select(F.array_distinct(tokens(F.lit(keyword))).alias("t")).first()["t"]


def lookup(spark: SparkSession, path: str, keyword: str, date: str | None = None,
           buckets: int = BUCKETS) -> DataFrame:
    """``dt, doc_id`` of the documents that hold every token of the keyword (an
    empty keyword matches nothing). Only the tokens' bucket folders are listed;
    lists are intersected by one aggregate per document, combined map-side."""
    wanted = keyword_tokens(spark, keyword)
    none = spark.createDataFrame([], "dt string, doc_id string")
    if not wanted:
        return none
    numbers = spark.createDataFrame([(t,) for t in wanted], "token string").select(bucket_of(F.col("token"), buckets))
    folders = sorted({str(r[0]) for r in numbers.distinct().collect()})   # at most one per keyword token
    lists = sinks.read_days(spark, path, BUCKET_COL, folders, empty_schema="token string, dt string, doc_id string")
    hits = lists.filter(F.col("token").isin(wanted))
    if date is not None:
        hits = hits.filter(F.col("dt") == date)
    held = hits.groupBy("dt", "doc_id").agg(*[F.max(F.col("token") == t).alias(f"t{i}") for i, t in enumerate(wanted)])
    return held.filter(F.forall(F.array(*[f"t{i}" for i in range(len(wanted))]), lambda t: t)).select("dt", "doc_id")


def compact(spark: SparkSession, path: str, out_path: str) -> None:
    """The whole index as one batch in a new folder: distinct postings, one
    sorted run of files per bucket."""
    rows = sinks.read_table(spark, path).select("token", "dt", "doc_id", BUCKET_COL).distinct()
    write_postings(rows, 0, out_path)
