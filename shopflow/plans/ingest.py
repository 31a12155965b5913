"""Ingest edge: stamp and route raw app logs; flatten and route the
database change feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.json import change_topic, columns_to_json, log_topic, stamp_ts


def stamp_logs(raw: DataFrame, stamp_ms: Column, col: str = "value") -> DataFrame:
    """PRJ10: overwrite each log's ``ts`` with the server stamp (live jobs
    pass the message's arrival time). NULL where the line is no JSON object."""
    return raw.withColumn(col, stamp_ts(F.col(col), stamp_ms))


def route_logs(raw: DataFrame, col: str = "value") -> DataFrame:
    """FLT7: add the destination ``topic`` of each raw log line."""
    return raw.withColumn("topic", log_topic(F.col(col)))


def flatten_changes(entries: DataFrame, database: str | None = None) -> DataFrame:
    """SRC3/FLT6/PRJ9: keep row-data entries (of one database, if given), one
    output row per changed row, the after-image as a JSON object of string
    values. Output: ``table, op, value`` and the entry's ``key`` if it has one."""
    kept = entries.filter(F.col("entry_type") == "ROWDATA")
    if database is not None:
        kept = kept.filter(F.col("database") == database)
    names = ["table", "op", *[c for c in ("key",) if c in entries.columns]]
    rows = kept.select(*names, F.explode("rows").alias("r"))
    return rows.select(*names, columns_to_json(F.col("r.after")).alias("value"))


def route_changes(flat: DataFrame) -> DataFrame:
    """FLT5: order inserts, order-line inserts and user inserts/updates go to
    their topics; every other change is dropped. Output adds ``topic``."""
    return (flat.withColumn("topic", change_topic(F.col("table"), F.col("op")))
            .filter(F.col("topic").isNotNull()))
