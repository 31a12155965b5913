"""Hourly revenue, and first-seen devices, kept up by differences.

An order that comes again, unchanged or with another amount or hour, must count
once and with its latest version. Each micro-batch looks up the stored versions
of its own orders (and of no others), subtracts what they added, adds what the
new versions bring, and stores the sums of these differences per day and hour. A
day's revenue then is the sum of a few difference rows an hour; the day's orders
are never read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.operators.dedup import latest_per_key
from shopflow.plans import dau as dau_plan
from shopflow.streaming import sinks

#: exact sums: what is subtracted is what was added
MONEY = "decimal(28,6)"
ORDER = "id string, create_date string, create_hour string, amount decimal(28,6), version long"
DELTA = "create_date string, create_hour string, amount decimal(38,6), orders long"


def versions(orders: DataFrame) -> DataFrame:
    """Cleaned orders (``plans.gmv.clean_orders``, with ``version``) as the
    stored versions' columns."""
    return orders.select(F.col("id").cast("string").alias("id"), "create_date", "create_hour",
                         F.col("total_amount").cast(MONEY).alias("amount"), F.col("version").cast("long").alias("version"))


def differences(new: DataFrame, old: DataFrame) -> DataFrame:
    """Per day and hour what newer versions change. ``new`` and ``old`` have one
    row per id; an order without an amount counts as an order of nothing."""
    o = old.select("id", *[F.col(c).alias(f"old_{c}") for c in ("create_date", "create_hour", "amount")])
    parts = F.array(
        F.struct("create_date", "create_hour", F.coalesce("amount", F.lit(0).cast(MONEY)).alias("amount"),
                 F.lit(1).cast("long").alias("orders")),
        F.when(F.col("known"), F.struct(
            F.col("old_create_date").alias("create_date"), F.col("old_create_hour").alias("create_hour"),
            (-F.coalesce("old_amount", F.lit(0))).cast(MONEY).alias("amount"), F.lit(-1).cast("long").alias("orders"))))
    return (new.join(o.withColumn("known", F.lit(True)), "id", "left")
            .select(F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("d")).select("d.*")
            .groupBy("create_date", "create_hour").agg(F.sum("amount").alias("amount"), F.sum("orders").alias("orders"))
            .filter((F.col("amount") != 0) | (F.col("orders") != 0)))


def keep(rows: DataFrame, batch_id: int, versions_path: str, deltas_path: str) -> None:
    """Stores the batch's newer versions and the differences they make. Both
    tables are replaced batch by batch and a batch reads only earlier ones, so a
    retried batch writes the same differences again."""
    spark = rows.sparkSession
    rows = latest_per_key(rows, ["id"], ["version", "create_date", "create_hour", "amount"]).persist()
    try:
        old = sinks.read_keyed(spark, versions_path, ["id"], ["version"], empty_schema=ORDER, upto=batch_id - 1,
                               only=rows.select("id")).drop(sinks.BATCH_COL, sinks.KEY_BUCKET)
        newer = (rows.join(old.select("id", F.col("version").alias("stored")), "id", "left")
                 .filter(F.col("stored").isNull() | (F.col("version") > F.col("stored"))).drop("stored")).persist()
        try:
            sinks.write_batch(differences(newer, old), batch_id, deltas_path, ["create_date"])
            sinks.write_keyed(newer, batch_id, versions_path, ["id"])
        finally:
            newer.unpersist()
    finally:
        rows.unpersist()


def revenue_sink(orders_path: str, deltas_path: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, batch_id: keep(versions(batch), batch_id, orders_path, deltas_path)


def first_seen_sink(devices_path: str, deltas_path: str) -> Callable[[DataFrame, int], None]:
    """AGG14 by record time, whatever the order of arrival: a device is an order
    of one, placed at its earliest start-up, and an earlier start-up is its newer
    version. A late row thus moves the device from the hour that had it."""
    def run(batch: DataFrame, batch_id: int) -> None:
        first = dau_plan.first_seen(batch.select("mid", "ts"))
        rows = first.select(F.col("mid").alias("id"), F.col("log_date").alias("create_date"),
                            F.col("log_hour").alias("create_hour"), F.lit(1).cast(MONEY).alias("amount"),
                            (-F.col("ts")).alias("version"))
        keep(rows, batch_id, devices_path, deltas_path)
    return run


def new_devices(spark: SparkSession, path: str, days: list[str]) -> DataFrame:
    """``log_date, log_hour, v``: devices first seen in each hour of the days,
    from those days' differences only. ``path``: what ``first_seen_app`` wrote."""
    deltas = sinks.read_days(spark, f"{path}/deltas", "create_date", days, empty_schema=DELTA)
    return (deltas.filter(F.col("create_date").isin(days))
            .groupBy(F.col("create_date").alias("log_date"), F.col("create_hour").alias("log_hour"))
            .agg(F.sum("orders").alias("v")).filter(F.col("v") != 0))


def by_hour(deltas: DataFrame) -> DataFrame:
    """AGG6 from stored differences; an hour whose orders all moved away has no
    row."""
    return (deltas.groupBy("create_date", "create_hour")
            .agg(F.round(F.sum("amount").cast("double"), 2).alias("gmv"), F.sum("orders").alias("orders"))
            .filter(F.col("orders") != 0).drop("orders"))


def day_by_hour(spark: SparkSession, deltas_path: str, date: str) -> DataFrame:
    """One day's hours: only that day's differences are listed and read."""
    return by_hour(sinks.read_days(spark, deltas_path, "create_date", [date], empty_schema=DELTA))


def day_total(spark: SparkSession, deltas_path: str, date: str) -> DataFrame:
    """AGG5 of one day; NULL when it has no orders."""
    days = sinks.read_days(spark, deltas_path, "create_date", [date], empty_schema=DELTA)
    return days.agg(F.when(F.sum("orders") != 0, F.round(F.sum("amount").cast("double"), 2)).alias("gmv"))
