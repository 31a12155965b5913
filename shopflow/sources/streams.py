"""Streaming sources (SRC1): a topic on Kafka, or a folder of files.

Offsets live in the query's checkpoint (exactly-once with the idempotent sinks
of ``streaming.sinks``) instead of consumer-group auto-commit; every query
gets its own consumer group. ``per_trigger`` bounds a micro-batch like the
change-feed client's fetch size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.session import configure


def kafka_topic(spark: SparkSession, servers: str, topic: str,
                starting: str = "latest", per_trigger: int | None = None) -> DataFrame:
    """``value`` (string), ``topic``, ``arrival`` (broker timestamp). Needs the
    spark-sql-kafka package on the cluster's classpath."""
    configure(spark)
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting))
    if per_trigger:
        r = r.option("maxOffsetsPerTrigger", per_trigger)
    return r.load().select(F.col("value").cast("string").alias("value"), "topic",
                           F.col("timestamp").alias("arrival"))


def text_files(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """One JSON document per line, as a ``value`` string column (the same
    shape as a Kafka value): file-drop ingestion, and the file form of a topic
    that another app writes (``<routed>/topic=<name>``, all batches below)."""
    configure(spark)
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if per_trigger:
        r = r.option("maxFilesPerTrigger", per_trigger)
    return r.load(path)


def parquet_files(spark: SparkSession, path: str, schema: T.StructType,
                  per_trigger: int | None = None) -> DataFrame:
    configure(spark)
    r = spark.readStream.format("parquet").schema(schema)
    if per_trigger:
        r = r.option("maxFilesPerTrigger", per_trigger)
    return r.load(path)


def publish(batch: DataFrame, servers: str) -> None:
    """SNK6: publish a micro-batch's ``topic, value`` rows; the ``topic``
    column routes each row. Needs the spark-sql-kafka package on the cluster's
    classpath."""
    (batch.select("topic", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).save())
