"""JSON column functions: decode, encode, stamp, route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.constants import (TOPIC_EVENT, TOPIC_ORDER_DETAIL, TOPIC_ORDER_INFO,
                                TOPIC_STARTUP, TOPIC_USER_INFO)

CORRUPT = "_corrupt_record"
OBJECT = "map<string,variant>"


def decode(df: DataFrame, schema: T.StructType, col: str = "value",
           keep: tuple[str, ...] = (), required: tuple[str, ...] = ()) -> DataFrame:
    """Parse a JSON text column into ``schema`` columns.

    Malformed lines do not fail the job: their fields are NULL and the raw
    text is kept in ``_corrupt_record`` so a caller can send it to a
    dead-letter output (``dead_letters``). Lines that parse but miss a
    ``required`` field are quarantined the same way (no silent defaults)."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(col), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    corrupt = parsed[CORRUPT]
    if required:
        missing = None
        for r in required:
            m = parsed[r].isNull()
            missing = m if missing is None else (missing | m)
        corrupt = F.coalesce(corrupt, F.when(missing, F.col(col)))
    return df.select(
        *keep,
        *[parsed[f.name].alias(f.name) for f in schema.fields],
        corrupt.alias(CORRUPT),
    )


def good_rows(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def columns_to_json(after: Column) -> Column:
    """Array of (name, value) column images -> JSON object text."""
    return F.to_json(F.map_from_entries(after))


def stamp_ts(raw_json: Column, stamp_ms: Column) -> Column:
    """Overwrite (or add) the ``ts`` field of a JSON object with a server
    stamp; other values, nested ones too, keep their JSON types. NULL for text
    that is no JSON object: the caller keeps the original (dead letters). Of a
    repeated key the last value counts (``spark.sql.mapKeyDedupPolicy``)."""
    m = F.from_json(raw_json, OBJECT)
    kept = F.map_filter(m, lambda k, v: k != "ts")
    stamp = F.parse_json(stamp_ms.cast("string"))
    return F.to_json(F.map_concat(kept, F.create_map(F.lit("ts"), stamp)))


def log_topic(raw_json: Column) -> Column:
    """``type == 'startup'`` goes to the start-up topic, anything else
    (including a missing type) to the event topic."""
    t = F.get_json_object(raw_json, "$.type")
    return F.when(t == "startup", F.lit(TOPIC_STARTUP)).otherwise(F.lit(TOPIC_EVENT))


def change_topic(table: Column, op: Column) -> Column:
    """Change-feed routing rule; NULL means the change is not forwarded."""
    return (F.when((table == "order_info") & (op == "INSERT"), F.lit(TOPIC_ORDER_INFO))
            .when((table == "order_detail") & (op == "INSERT"), F.lit(TOPIC_ORDER_DETAIL))
            .when((table == "user_info") & op.isin("INSERT", "UPDATE"), F.lit(TOPIC_USER_INFO)))
