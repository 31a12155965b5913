"""Domain records derived from the driver's parquet tables (see FIXTURES.md).

Every mapping is a projection (plus, for order lines and provinces, a join), so
it runs as part of the query plan: Catalyst prunes the scan to the columns the
caller ends up using and pushes filters below the projection.

Keys keep their native BIGINT type here (joins hash and sort 8-byte keys);
records decoded from topics carry the same keys as strings. The plans are
type-agnostic, and ``as_record_ids`` renders the ids as the record's strings
at the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.time import epoch_ms

# --- fixed values of the fixture mapping -----------------------------------
# driver event_type -> app event id (evid)
EVID_OF_EVENT_TYPE = {
    "purchase": "coupon",
    "click": "clickItem",
    "view": "addFavor",
    "signup": "addCart",
    "error": "addComment",
}
N_EVENT_DEVICES = 10          # event-log device id = user_id % 10
MISSING_USER_MODULUS = 50     # customers with key % 50 == 0 are missing where users are joined
UPDATED_USER_MODULUS = 10     # customers with key % 10 == 1 get a 2nd version
UPDATED_USER_LEVEL = "VIP"
BIRTHDAY_BASE = "1950-01-01"  # birthday = base + (custkey * 7919 % 22000) days
BIRTHDAY_MULT, BIRTHDAY_SPAN = 7919, 22000
PHONE_PREFIX = "13"           # phone = '13' || lpad(custkey, 9, '0')
# change-feed synthesis: op by key, and some entries are not row data
CDC_UPDATE_MODULUS, CDC_DELETE_MODULUS, CDC_NON_ROWDATA_MODULUS = 5, 7, 11
CDC_DATABASE = "shop"


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def map_values(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None
                else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(default))


RECORD_ID_COLS = ("id", "order_id", "user_id", "sku_id")


def as_record_ids(df: DataFrame) -> DataFrame:
    """Render key columns as the record's string ids (final projection)."""
    return df.select(*[F.col(c).cast("string").alias(c)
                       if c in RECORD_ID_COLS and dict(df.dtypes)[c] != "string" else F.col(c)
                       for c in df.columns])


# --- app logs ----------------------------------------------------------------

def startup_logs(events: DataFrame) -> DataFrame:
    """Start-up log per event row: device = account = user_id."""
    return events.select(
        F.col("event_id"),
        _s("user_id").alias("mid"),
        _s("user_id").alias("uid"),
        F.lit("startup").alias("type"),
        epoch_ms(F.col("ts")).alias("ts"),
    )


def event_logs(events: DataFrame) -> DataFrame:
    """Event log per event row: device = user_id % 10, item id from props."""
    return events.select(
        F.col("event_id"),
        _s(F.col("user_id") % N_EVENT_DEVICES).alias("mid"),
        _s("user_id").alias("uid"),
        F.lit("event").alias("type"),
        map_values(F.col("event_type"), EVID_OF_EVENT_TYPE).alias("evid"),
        F.get_json_object("props", "$.k").alias("itemid"),
        epoch_ms(F.col("ts")).alias("ts"),
    )


def raw_log_json(events: DataFrame) -> DataFrame:
    """The raw JSON lines a client would send: one start-up line and one event
    line per driver event (ids as JSON numbers where the producer sends them)."""
    ms = epoch_ms(F.col("ts"))
    startup = events.select(
        F.col("event_id"), F.lit("startup").alias("kind"),
        F.to_json(F.struct(
            F.lit("startup").alias("type"), _s("user_id").alias("mid"),
            _s("user_id").alias("uid"), ms.alias("ts"))).alias("value"))
    event = events.select(
        F.col("event_id"), F.lit("event").alias("kind"),
        F.to_json(F.struct(
            F.lit("event").alias("type"),
            _s(F.col("user_id") % N_EVENT_DEVICES).alias("mid"),
            _s("user_id").alias("uid"),
            map_values(F.col("event_type"), EVID_OF_EVENT_TYPE).alias("evid"),
            F.get_json_object("props", "$.k").try_cast("long").alias("itemid"),
            ms.alias("ts"))).alias("value"))
    return startup.unionByName(event)


# --- orders, lines, users ----------------------------------------------------

def order_info(orders: DataFrame, with_time: bool = False) -> DataFrame:
    """Order records; ``with_time`` adds ``order_time`` (TIMESTAMP) for
    event-time joins and batching."""
    create_time = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss")
    extra = [F.col("o_orderdate").cast("timestamp").alias("order_time")] if with_time else []
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        create_time.alias("create_time"),
        F.concat(F.lit(PHONE_PREFIX),
                 F.lpad(_s("o_custkey"), 9, "0")).alias("consignee_tel"),
        *extra,
    )


def order_lines(lineitem: DataFrame, with_time: bool = False) -> DataFrame:
    """Order lines without the sku name (it needs the part table);
    ``with_time`` adds the line's arrival ``line_time`` (ship date)."""
    extra = [F.col("l_shipdate").cast("timestamp").alias("line_time")] if with_time else []
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey",
                    "l_suppkey").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.col("l_quantity").alias("sku_num"),
        *extra,
    )


def order_lines_named(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Order lines with ``sku_name``. The line side streams through the join
    (AQE may split a hot sku's partition); ``part`` is one row per key."""
    parts = part.select(F.col("p_partkey").alias("sku_id"), F.col("p_name").alias("sku_name"))
    return order_lines(lineitem).join(parts, "sku_id", "left")


def user_versions(customer: DataFrame, some_missing: bool = False) -> DataFrame:
    """User rows as they arrive on the user topic: version 1 for every
    customer, version 2 (level upgraded) for some. With ``some_missing``, as
    the sale-detail queries need it, some customers have no user row yet."""
    key = F.col("c_custkey")
    if some_missing:
        customer = customer.filter(key % MISSING_USER_MODULUS != 0)
    base = customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_format(F.date_add(F.lit(BIRTHDAY_BASE).cast("date"),
                                 ((key * BIRTHDAY_MULT) % BIRTHDAY_SPAN).cast("int")),
                      "yyyy-MM-dd").alias("birthday"),
        F.when(key % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.lit(1).alias("version"),
        key.alias("_key"),
    )
    v2 = (base.filter(F.col("_key") % UPDATED_USER_MODULUS == 1)
          .withColumn("user_level", F.lit(UPDATED_USER_LEVEL))
          .withColumn("version", F.lit(2)))
    return base.unionByName(v2).drop("_key")


def purchase_orders(events: DataFrame) -> DataFrame:
    """Hourly revenue source: purchase events as orders (amount = value)."""
    return events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("id"),
        F.col("value").alias("total_amount"),
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("create_time"),
    )


# --- change feed --------------------------------------------------------------

def _change_entries(df: DataFrame, table: str, key: str, cols: dict) -> DataFrame:
    k = F.col(key)
    op = (F.when(k % CDC_DELETE_MODULUS == 0, F.lit("DELETE"))
          .when(k % CDC_UPDATE_MODULUS == 0, F.lit("UPDATE"))
          .otherwise(F.lit("INSERT")))
    entry_type = (F.when(k % CDC_NON_ROWDATA_MODULUS == 0, F.lit("TRANSACTIONBEGIN"))
                  .otherwise(F.lit("ROWDATA")))
    after = F.array(*[F.struct(F.lit(name).alias("name"), _s(expr).alias("value"))
                      for name, expr in cols.items()])
    return df.select(
        entry_type.alias("entry_type"), F.lit(CDC_DATABASE).alias("database"),
        F.lit(table).alias("table"),
        op.alias("op"), k.cast("long").alias("key"),
        F.array(F.struct(after.alias("after"))).alias("rows"))


def change_entries(orders: DataFrame, lineitem: DataFrame,
                   customer: DataFrame) -> DataFrame:
    """One change-feed entry per order, order line and customer row."""
    o = _change_entries(orders, "order_info", "o_orderkey", {
        "id": F.col("o_orderkey"), "user_id": F.col("o_custkey"),
        "order_status": F.col("o_orderstatus"),
        "total_amount": F.col("o_totalprice"),
        "create_time": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        "consignee_tel": F.concat(F.lit(PHONE_PREFIX), F.lpad(_s("o_custkey"), 9, "0")),
    })
    d = _change_entries(lineitem, "order_detail", "l_orderkey", {
        "id": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey"),
        "order_price": F.col("l_extendedprice"), "sku_num": F.col("l_quantity"),
    })
    u = _change_entries(customer, "user_info", "c_custkey", {
        "id": F.col("c_custkey"), "login_name": F.col("c_name"),
        "user_level": F.col("c_mktsegment"),
    })
    return o.unionByName(d).unionByName(u)
