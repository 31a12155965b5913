"""Order revenue (GMV): cleaning, totals, hourly series, provinces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.text import mask_phone
from shopflow.functions.time import with_create_date_hour
from shopflow.operators.joins import today_vs_yesterday


def clean_orders(orders: DataFrame) -> DataFrame:
    """PRJ3 + PRJ4: derive ``create_date``/``create_hour`` from
    ``create_time`` and mask the consignee phone (null-safe)."""
    out = with_create_date_hour(orders)
    if "consignee_tel" in out.columns:
        out = out.withColumn("consignee_tel", mask_phone(F.col("consignee_tel")))
    return out


def on_day(orders: DataFrame, date: str | None) -> DataFrame:
    """Orders with ``create_date``/``create_hour``, of one day if given. A
    stored table has these columns: they are kept, so a day filter reaches its
    partitions."""
    stored = {"create_date", "create_hour"} <= set(orders.columns)
    o = orders if stored else with_create_date_hour(orders)
    return o if date is None else o.filter(F.col("create_date") == date)


def gmv_total(orders: DataFrame, date: str | None = None) -> DataFrame:
    """AGG5: revenue per day (NULL-free days only; a day with no orders has
    no row, its total is NULL as in the reference)."""
    o = on_day(orders, date)
    return o.groupBy("create_date").agg(
        F.round(F.sum("total_amount"), 2).alias("gmv"))


def gmv_by_hour(orders: DataFrame, date: str | None = None) -> DataFrame:
    """AGG6 + PRJ21: revenue per day and hour as double."""
    o = on_day(orders, date)
    return o.groupBy("create_date", "create_hour").agg(
        F.round(F.sum("total_amount"), 2).cast("double").alias("gmv"))


def gmv_today_vs_yesterday(orders: DataFrame) -> DataFrame:
    return today_vs_yesterday(gmv_by_hour(orders), "create_date", "create_hour",
                              "gmv", zero=F.lit(0.0))


def sales_by_province(orders: DataFrame, customer: DataFrame,
                      nation: DataFrame) -> DataFrame:
    """AGG15: order count and revenue per province (nation).

    Orders are pre-aggregated per customer *before* the join, so the join
    shuffles one row per customer instead of one per order, and a customer
    holding a third of all orders is combined map-side. How the small nation
    side is joined is left to Spark, which knows its size."""
    per_cust = (orders.groupBy(F.col("o_custkey"))
                .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("amt")))
    cust = customer.select("c_custkey", "c_nationkey")
    per_nation = (per_cust.join(cust, per_cust.o_custkey == cust.c_custkey, "left")
                  .groupBy("c_nationkey")
                  .agg(F.sum("n").alias("order_count"), F.sum("amt").alias("amt")))
    nat = nation.select("n_nationkey", "n_name")
    return (per_nation.join(nat, per_nation.c_nationkey == nat.n_nationkey, "left")
            .select(F.col("c_nationkey").cast("string").alias("province_id"),
                    F.col("n_name").alias("province_name"),
                    F.col("order_count"),
                    F.round(F.col("amt"), 2).alias("order_amount")))
