"""Sale-detail wide table: orders x order lines x users.

Inputs are the domain records of ``fixtures`` (or decoded topic rows):
orders ``id, user_id, order_status, total_amount, create_time``; lines
``id, order_id, sku_id, sku_name?, order_price, sku_num``; users
``id, login_name, user_level, birthday, gender, version``.

Join shapes are chosen for skew: the fact side (lines) is always the
streamed/preserved side of an inner or left join, so AQE can split a hot
order's or hot sku's partition; the "lonely" rows of the unique side come
from an anti join against de-duplicated keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.numeric import age_years
from shopflow.functions.time import create_date
from shopflow.operators.dedup import latest_per_key
from shopflow.operators.joins import interval_join

ORDER_COLS = ("order_status", "create_time", "user_id")


def order_side(orders: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """PRJ5/PRJ12: order columns of the wide row, keyed by ``order_id``."""
    return orders.select(F.col("id").alias("order_id"), *ORDER_COLS,
                         create_date(F.col("create_time")).alias("dt"), *extra)


def line_side(lines: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """PRJ13: line columns, price string -> double (NULL if not a number)."""
    cols = [F.col("id").alias("order_detail_id"), "order_id", "sku_id",
            F.col("order_price").try_cast("double").alias("sku_price")]
    if "sku_name" in lines.columns:
        cols.append("sku_name")
    return lines.select(*cols, *extra)


def sale_detail_wide(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """JN6 inner: one wide row per order line whose order is known."""
    return line_side(lines).join(order_side(orders), "order_id", "inner")


def order_line_full_outer(orders: DataFrame, lines: DataFrame,
                          batch: str = "batch") -> DataFrame:
    """JN5: same-batch full outer join on ``(order_id, batch)``: matched pairs,
    orders whose lines are not in the batch, lines whose order is not. Both
    inputs carry the ``batch`` column (micro-batch id or arrival bucket). Lines
    of one order are bounded by the order, so one native join, which reads each
    side once, does; for keys without such a bound see
    ``operators.joins.full_outer_unique``."""
    o, d = order_side(orders, (batch,)), line_side(lines, (batch,))
    return d.join(o, ["order_id", batch], "full")


def order_line_left(orders: DataFrame, lines: DataFrame, batch: str = "batch") -> DataFrame:
    """JN6 left: every order of the batch, with its lines of the batch if any."""
    o, d = order_side(orders, (batch,)), line_side(lines, (batch,))
    return d.join(o, ["order_id", batch], "right")


def order_line_right(orders: DataFrame, lines: DataFrame, batch: str = "batch") -> DataFrame:
    """JN6 right: every line of the batch, with its order of the batch if any."""
    o, d = order_side(orders, (batch,)), line_side(lines, (batch,))
    return d.join(o, ["order_id", batch], "left")


def sale_detail_interval(orders: DataFrame, lines: DataFrame, order_time: str,
                         line_time: str, bound_seconds: int) -> DataFrame:
    """JN4/STR5 batch form: an order and a line join when the line arrives
    within ``bound_seconds`` of the order (either side may be late)."""
    o = order_side(orders, (order_time,))
    d = line_side(lines, (line_time,))
    return interval_join(o, d, ["order_id"], order_time, line_time, bound_seconds)


def user_dim_latest(users: DataFrame, order: tuple[str, ...] = ("version",)) -> DataFrame:
    """SNK4/WIN2: latest row per user id (map-side combined max)."""
    return latest_per_key(users, ["id"], list(order)).drop(*order)


def user_age(users: DataFrame, as_of: str | Column) -> DataFrame:
    """PRJ15/PRJ23: whole years of age as of a date."""
    return users.withColumn("user_age", age_years(F.col("birthday"), as_of))


def enrich(wide: DataFrame, users_latest: DataFrame, as_of: str | Column) -> DataFrame:
    """JN7/PRJ14: left join the user dimension; a missing user keeps gender and
    level NULL and age 0 (the record default)."""
    u = user_age(users_latest, as_of).select(
        F.col("id").alias("user_id"), F.col("gender").alias("user_gender"),
        "user_age", "user_level")
    return (wide.join(u, "user_id", "left")
            .withColumn("user_age", F.coalesce(F.col("user_age"), F.lit(0))))


SALE_DETAIL_COLS = ("order_detail_id", "order_id", "order_status", "create_time",
                    "user_id", "sku_id", "user_gender", "user_age", "user_level",
                    "sku_price", "sku_name", "dt")


def sale_detail_json(wide: DataFrame) -> DataFrame:
    """PRJ11: each wide row as a JSON document keyed by its line id."""
    cols = [c for c in SALE_DETAIL_COLS if c in wide.columns]
    return wide.select("order_detail_id",
                       F.to_json(F.struct(*cols)).alias("doc"))
