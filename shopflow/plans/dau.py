"""Daily active devices: dedup, totals, hourly series, new devices.

Input is a start-up log DataFrame (``mid, uid, ts`` epoch ms, ``event_id``
as unique tiebreak); batch and stream callers share these functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.constants import DAU_INDEX_PREFIX
from shopflow.functions.time import log_date, log_hour, with_log_date_hour
from shopflow.operators.dedup import first_per_key, latest_per_key
from shopflow.operators.joins import anti_join, today_vs_yesterday

DEVICE_DAY = ["mid", "log_date"]
TS_ORDER = ["ts", "event_id"]


def with_dates(startup: DataFrame) -> DataFrame:
    """PRJ1: ``log_date`` (yyyy-MM-dd) and ``log_hour`` (HH) from epoch ms."""
    return with_log_date_hour(startup, "ts")


def dau_dedup(startup: DataFrame) -> DataFrame:
    """AGG1/WIN1: earliest start-up row per device and day."""
    return first_per_key(with_dates(startup), DEVICE_DAY, TS_ORDER)


def device_days(startup: DataFrame) -> DataFrame:
    """Per device and day the time of the first start-up, its hour and day: a
    hash aggregate over two columns. What only needs when a device was first
    active uses this instead of the whole first row (``dau_dedup``)."""
    first = (startup.select("mid", "ts", log_date(F.col("ts")).alias("log_date"))
             .groupBy("mid", "log_date").agg(F.min("ts").alias("ts")))
    return first.withColumn("log_hour", log_hour(F.col("ts")))


def dau_any_per_mid(startup: DataFrame) -> DataFrame:
    """AGG2: one row per device (deterministic: its earliest row)."""
    return first_per_key(startup, ["mid"], TS_ORDER)


def dau_total(dedup: DataFrame, date: str | None = None) -> DataFrame:
    """AGG3: active devices per day (or of one day, partition-pruned)."""
    if date is not None:
        dedup = dedup.filter(F.col("log_date") == date)
    return dedup.groupBy("log_date").agg(F.count(F.lit(1)).alias("dau"))


def dau_by_hour(dedup: DataFrame, date: str | None = None) -> DataFrame:
    """AGG4: active devices per day and hour of first start-up."""
    if date is not None:
        dedup = dedup.filter(F.col("log_date") == date)
    return dedup.groupBy("log_date", "log_hour").agg(F.count(F.lit(1)).alias("dau"))


def hour_map(series: DataFrame, day_col: str, hour_col: str, value_col: str) -> DataFrame:
    """PRJ20: per day, a JSON object ``{"HH": value, ...}`` in hour order.
    At most 24 entries are collected per day."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(hour_col), F.col(value_col))))
    return (series.groupBy(day_col)
            .agg(F.to_json(F.map_from_entries(entries)).alias("hour_map")))


def dau_hour_map(dedup: DataFrame) -> DataFrame:
    return hour_map(dau_by_hour(dedup), "log_date", "log_hour", "dau")


def dau_cross_batch(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """FLT1/JN1-3/SET2: devices of the current batch not yet counted on their
    own record date, de-duplicated within the batch.

    ``seen`` holds ``(mid, log_date)`` of earlier batches. The anti join is
    keyed by the record's date on both sides (a late record is checked
    against its own day)."""
    fresh = anti_join(with_dates(batch), seen, DEVICE_DAY)
    return first_per_key(fresh, DEVICE_DAY, TS_ORDER)




def dau_docs_latest(startup: DataFrame) -> DataFrame:
    """SNK2/PRJ8/WIN2: start-up logs upserted as documents into the day's
    index ``<prefix>-<log_date>`` with document id = device; a re-delivered
    document overwrites, so the latest (``ts``, then id) version is kept."""
    docs = with_dates(startup).select(
        F.concat_ws("-", F.lit(DAU_INDEX_PREFIX), F.col("log_date")).alias("index_name"),
        F.col("mid").alias("doc_id"), "event_id", "uid", "ts", "log_hour")
    return latest_per_key(docs, ["index_name", "doc_id"], TS_ORDER)


def dau_today_vs_yesterday(dedup: DataFrame) -> DataFrame:
    """JN8/PRJ16: hourly DAU of each day next to the day before, 24 rows/day."""
    return today_vs_yesterday(dau_by_hour(dedup), "log_date", "log_hour", "dau",
                              zero=F.lit(0).cast("long"))


def dedup_counts(startup: DataFrame) -> DataFrame:
    """AGG13: rows before and after dedup per day, from one aggregation pass
    (``(day, device)`` counts, then per-day sum and count)."""
    per_device = (with_dates(startup).groupBy("log_date", "mid")
                  .agg(F.count(F.lit(1)).alias("n")))
    return per_device.groupBy("log_date").agg(
        F.sum("n").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))


def first_seen(startup: DataFrame) -> DataFrame:
    """Earliest start-up ever per device (``mid, ts``), with its date and hour."""
    return with_dates(startup.groupBy("mid").agg(F.min("ts").alias("ts")))


def new_devices(startup: DataFrame, date: str | None = None) -> DataFrame:
    """AGG14: devices whose first start-up ever falls on the day."""
    f = first_seen(startup)
    if date is not None:
        f = f.filter(F.col("log_date") == date)
    return f.groupBy("log_date").agg(F.count(F.lit(1)).alias("new_mid"))


def new_devices_by_hour(startup: DataFrame) -> DataFrame:
    return (first_seen(startup).groupBy("log_date", "log_hour")
            .agg(F.count(F.lit(1)).alias("new_mid")))


__all__ = ["with_dates", "dau_dedup", "dau_any_per_mid", "dau_total", "dau_by_hour",
           "device_days", "hour_map", "dau_hour_map", "dau_cross_batch", "dau_today_vs_yesterday",
           "dedup_counts", "first_seen", "new_devices", "new_devices_by_hour",
           "log_date", "log_hour"]
