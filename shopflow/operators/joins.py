"""Join building blocks.

Broadcast policy: no join here forces a broadcast of a side whose size grows
with the data. Spark's ``autoBroadcastJoinThreshold`` together with AQE
decides from *measured* shuffle sizes at run time, and AQE's skew-join
handling splits oversized partitions of the streamed side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.time import hour_label

HOURS_PER_DAY = 24


def anti_join(batch: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``seen`` (set difference).

    ``seen`` is reduced to distinct keys first (partial aggregation), so a key
    repeated many times in ``seen`` costs one row in the shuffle."""
    return batch.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def full_outer_unique(one: DataFrame, many: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join where ``one`` has at most one row per key.

    Written as ``many LEFT JOIN one`` plus the ``one`` rows without a match
    (``one LEFT ANTI distinct(many.keys)``). Unlike a single full outer
    sort-merge join -- which AQE cannot split when one key is hot -- the left
    join streams ``many`` and AQE may split its skewed partitions, and the
    anti join only sees the de-duplicated key set."""
    keys = list(keys)
    matched = many.join(one, keys, "left")
    lonely = one.join(many.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def hour_spine(days: DataFrame, day_col: str = "dt") -> DataFrame:
    """24 rows (hours ``00``..``23``) per distinct day; a generator, no cross
    join. ``days`` is the (small) distinct-day set of an aggregate."""
    return (days.select(day_col).distinct()
            .select(day_col, F.explode(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1))).alias("_h"))
            .select(day_col, hour_label(F.col("_h")).alias("hour")))


def today_vs_yesterday(series: DataFrame, day_col: str, hour_col: str,
                       value_col: str, zero: Column | None = None,
                       days: DataFrame | None = None, fill: bool = True) -> DataFrame:
    """For every day of ``days`` (default: the days of ``series``), the
    24-hour series of that day next to the day before; missing hours are 0
    (NULL without ``fill``).

    Output: ``dt, hour, today, yesterday``. ``series`` is an aggregate (at most
    24 rows per day). It is read once: every row stands for its own day, for
    "yesterday" of the next one, and for the 24 hours to report, and one
    aggregate per ``(dt, hour)`` brings these together."""
    zero = F.lit(0) if zero is None else zero
    value, none = F.col(value_col), F.lit(None).cast(series.schema[value_col].dataType)
    day, hour = F.col(day_col).alias("dt"), F.col(hour_col).alias("hour")
    next_day = F.date_format(F.date_add(F.col(day_col).cast("date"), 1), "yyyy-MM-dd").alias("dt")
    rows = [F.array(F.struct(day, hour, value.alias("today"), none.alias("yesterday"), F.lit(False).alias("asked")),
                    F.struct(next_day, hour, none.alias("today"), value.alias("yesterday"),
                             F.lit(False).alias("asked")))]
    if days is None:
        rows.append(F.transform(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1)), lambda h: F.struct(
            day, hour_label(h).alias("hour"), none.alias("today"), none.alias("yesterday"),
            F.lit(True).alias("asked"))))
    long = series.select(F.explode(F.concat(*rows)).alias("r")).select("r.*")
    if days is not None:
        asked = hour_spine(days.select(F.col(days.columns[0]).alias("dt")))
        long = long.unionByName(asked.withColumn("asked", F.lit(True)), allowMissingColumns=True)
    got = (long.groupBy("dt", "hour")
           .agg(F.max("today").alias("today"), F.max("yesterday").alias("yesterday"),
                F.max("asked").alias("asked")).filter("asked"))
    if not fill:
        return got.select("dt", "hour", "today", "yesterday")
    return got.select("dt", "hour", F.coalesce("today", zero).alias("today"),
                      F.coalesce("yesterday", zero).alias("yesterday"))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  left_time: str, right_time: str, bound_seconds: int,
                  how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` plus ``|right_time - left_time| <= bound``
    (inclusive). Batch form of the stream-stream join with bounded lateness;
    the equality keys drive the shuffle, the time bound is a join filter."""
    cond = [left[k] == right[k] for k in keys]
    lt, rt = left[left_time], right[right_time]
    cond.append(rt >= lt - F.expr(f"INTERVAL {bound_seconds} SECONDS"))
    cond.append(rt <= lt + F.expr(f"INTERVAL {bound_seconds} SECONDS"))
    joined = left.join(right, cond, how)
    return joined.select(*[left[k] for k in keys],
                         *[left[c] for c in left.columns if c not in keys],
                         *[right[c] for c in right.columns if c not in keys])


__all__ = ["anti_join", "full_outer_unique", "hour_spine",
           "today_vs_yesterday", "interval_join"]
