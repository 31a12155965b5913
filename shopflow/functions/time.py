"""Date/time column functions (all JVM-side built-ins, UTC session zone)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_FMT = "yyyy-MM-dd"
HOUR_FMT = "HH"


def epoch_ms(ts: Column) -> Column:
    """Timestamp (NTZ or LTZ) -> epoch milliseconds, read in the session zone."""
    return F.unix_millis(ts.cast("timestamp"))


def to_event_time(ts_ms: Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP usable by watermarks and windows."""
    return F.timestamp_millis(ts_ms)


def log_date(ts_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ts_ms), DATE_FMT)


def log_hour(ts_ms: Column) -> Column:
    """Two-digit 24-hour clock hour (``HH``, never the 12-hour ``hh``)."""
    return F.date_format(F.timestamp_millis(ts_ms), HOUR_FMT)


def with_log_date_hour(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    return df.withColumns({"log_date": log_date(F.col(ts_col)),
                           "log_hour": log_hour(F.col(ts_col))})


def create_date(create_time: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> date part; NULL (not an error) if malformed."""
    return F.get(F.split(create_time, " "), 0)


def create_hour(create_time: Column) -> Column:
    return F.get(F.split(F.get(F.split(create_time, " "), 1), ":"), 0)


def with_create_date_hour(df: DataFrame, col: str = "create_time") -> DataFrame:
    return df.withColumns({"create_date": create_date(F.col(col)),
                           "create_hour": create_hour(F.col(col))})


def parse_date(s: Column) -> Column:
    """``yyyy-MM-dd`` string -> DATE, NULL when unparsable (ANSI-safe)."""
    return F.try_to_timestamp(s, F.lit(DATE_FMT)).cast("date")


def previous_day(d: Column) -> Column:
    """Date string -> the day before, as a date string."""
    return F.date_format(F.date_sub(parse_date(d), 1), DATE_FMT)


def hour_label(h: Column) -> Column:
    return F.lpad(h.cast("string"), 2, "0")
