"""Record schemas of the domain (fixed, never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw app log JSON as the client sends it. Numeric ids (pgid, npgid, itemid)
# are read as strings: from_json renders any JSON scalar into a StringType
# field as its text.
STARTUP_LOG = _struct(
    ("mid", S), ("uid", S), ("appid", S), ("area", S), ("os", S), ("ch", S),
    ("type", S), ("vs", S), ("logDate", S), ("logHour", S), ("ts", L),
)

EVENT_LOG = _struct(
    ("mid", S), ("uid", S), ("appid", S), ("area", S), ("os", S), ("type", S),
    ("evid", S), ("pgid", S), ("npgid", S), ("itemid", S), ("logDate", S),
    ("logHour", S), ("ts", L),
)

# One JSON schema that covers both log kinds; routing looks at `type`.
RAW_LOG = _struct(
    ("type", S), ("mid", S), ("uid", S), ("appid", S), ("area", S), ("os", S),
    ("ch", S), ("vs", S), ("evid", S), ("pgid", S), ("npgid", S),
    ("itemid", S), ("ts", L),
)

ORDER_INFO = _struct(
    ("id", S), ("province_id", S), ("consignee", S), ("order_comment", S),
    ("consignee_tel", S), ("order_status", S), ("payment_way", S),
    ("user_id", S), ("img_url", S), ("total_amount", D), ("expire_time", S),
    ("delivery_address", S), ("create_time", S), ("operate_time", S),
    ("tracking_no", S), ("parent_order_id", S), ("out_trade_no", S),
    ("trade_body", S), ("create_date", S), ("create_hour", S),
)

ORDER_DETAIL = _struct(
    ("id", S), ("order_id", S), ("sku_name", S), ("sku_id", S),
    ("order_price", S), ("img_url", S), ("sku_num", S),
)

USER_INFO = _struct(
    ("id", S), ("login_name", S), ("user_level", S), ("birthday", S),
    ("gender", S),
)

SALE_DETAIL = _struct(
    ("order_detail_id", S), ("order_id", S), ("order_status", S),
    ("create_time", S), ("user_id", S), ("sku_id", S), ("user_gender", S),
    ("user_age", I), ("user_level", S), ("sku_price", D), ("sku_name", S),
    ("dt", S),
)

COUPON_ALERT = _struct(
    ("mid", S), ("uids", T.ArrayType(S)), ("itemIds", T.ArrayType(S)),
    ("events", T.ArrayType(S)), ("ts", L),
)

# A change-feed entry: one transaction/row-data entry with the after-images
# of the rows it touched.
CHANGE_COLUMN = _struct(("name", S), ("value", S))
CHANGE_ENTRY = _struct(
    ("entry_type", S), ("database", S), ("table", S), ("op", S), ("ts", L),
    ("rows", T.ArrayType(_struct(("after", T.ArrayType(CHANGE_COLUMN))))),
)

KPI_CARD = _struct(("id", S), ("name", S), ("value", D))
