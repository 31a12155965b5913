"""Dashboard KPIs: card list per day and the hour-series selector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopflow.constants import CARD_DAU, CARD_NEW_MID, CARD_ORDER_AMOUNT
from shopflow.operators.joins import today_vs_yesterday
from shopflow.plans import dau as dau_plan
from shopflow.plans import gmv as gmv_plan

CARD_IDS = (CARD_DAU[0], CARD_NEW_MID[0], CARD_ORDER_AMOUNT[0])


VALUES = {CARD_DAU[0]: "dau", CARD_NEW_MID[0]: "new_mid", CARD_ORDER_AMOUNT[0]: "gmv"}


def activity(startup: DataFrame, orders: DataFrame) -> DataFrame:
    """Per day and hour with a start-up or an order: ``dau`` and ``new_mid``
    (devices whose first start-up of the day, and ever, falls there) and
    ``gmv``. Each input is read once; the window over a device's days is as
    large as the number of days it was active."""
    days = dau_plan.device_days(startup)
    is_new = F.col("ts") == F.min("ts").over(Window.partitionBy("mid"))
    devices = (days.withColumn("is_new", is_new.cast("long"))
               .groupBy(F.col("log_date").alias("dt"), F.col("log_hour").alias("hour"))
               .agg(F.count(F.lit(1)).alias("dau"), F.sum("is_new").alias("new_mid")))
    revenue = gmv_plan.gmv_by_hour(orders).select(
        F.col("create_date").alias("dt"), F.col("create_hour").alias("hour"), "gmv")
    return (devices.unionByName(revenue, allowMissingColumns=True).groupBy("dt", "hour")
            .agg(*[F.max(c).alias(c) for c in VALUES.values()]))


def realtime_total(startup: DataFrame, orders: DataFrame) -> DataFrame:
    """SET1: for every day with activity, three cards ``(id, name, value)``.

    DAU and new devices are counts (0 on a day without rows); order amount is
    the revenue sum and stays NULL on a day without orders."""
    days = dau_plan.device_days(startup)
    is_new = F.col("ts") == F.min("ts").over(Window.partitionBy("mid"))
    devices = (days.withColumn("is_new", is_new.cast("long")).groupBy(F.col("log_date").alias("dt"))
               .agg(F.count(F.lit(1)).alias("dau"), F.sum("is_new").alias("new_mid")))
    revenue = gmv_plan.gmv_total(orders).select(F.col("create_date").alias("dt"), "gmv")
    wide = (devices.unionByName(revenue, allowMissingColumns=True).groupBy("dt")
            .agg(*[F.max(c).alias(c) for c in VALUES.values()]))
    cards = F.array(
        F.struct(F.lit(CARD_DAU[0]).alias("id"), F.lit(CARD_DAU[1]).alias("name"),
                 F.coalesce(F.col("dau"), F.lit(0)).cast("double").alias("value")),
        F.struct(F.lit(CARD_NEW_MID[0]).alias("id"), F.lit(CARD_NEW_MID[1]).alias("name"),
                 F.coalesce(F.col("new_mid"), F.lit(0)).cast("double").alias("value")),
        F.struct(F.lit(CARD_ORDER_AMOUNT[0]).alias("id"),
                 F.lit(CARD_ORDER_AMOUNT[1]).alias("name"),
                 F.col("gmv").cast("double").alias("value")),
    )
    return (wide.select("dt", F.explode(cards).alias("c"))
            .select("dt", "c.id", "c.name", "c.value"))


def realtime_hours(startup: DataFrame, orders: DataFrame, card_id: str | None = None) -> DataFrame:
    """SET3 + JN8: hour series (today vs yesterday, 24 zero-filled hours per
    activity day) of every card, or of the selected one; an unknown id gives
    an empty result of the same schema.
    Output: ``id, dt, hour, today, yesterday`` (doubles)."""
    values = [c for c in VALUES if card_id in (None, c)]
    packed = activity(startup, orders).withColumn(
        "v", F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(i) for i, c in VALUES.items()]))
    series = today_vs_yesterday(packed, "dt", "hour", "v", fill=False)
    rows = F.array(*[F.struct(F.lit(c).alias("id"),
                              *[F.coalesce(F.col(f"{side}.{c}"), F.lit(0.0)).alias(side)
                                for side in ("today", "yesterday")]) for c in values or VALUES])
    out = (series.select("dt", "hour", F.explode(rows).alias("r"))
           .select("r.id", "dt", "hour", "r.today", "r.yesterday"))
    return out if values else out.limit(0)
