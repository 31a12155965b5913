"""Registered queries and their DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs on the whole driver tables;
``ORACLE_SQL[name]`` computes the same rows in DuckDB over the pre-registered
views. Column names and types agree one-to-one (every computed column is
aliased; doubles are rounded to 2 decimals on both sides; days and hours are
strings).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow import constants as C
from shopflow import fixtures as fx
from shopflow import schemas
from shopflow.functions.json import TOPIC_EVENT, decode, good_rows
from shopflow.plans import alert, dau, gmv, ingest, kpi, sale, search
from shopflow.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


# fixed values used by the oracle SQL, filled into {{NAME}} placeholders so
# the SQL and the engine share one source (shopflow.constants)
_SQL_VALUES = {
    "CARD_DAU_NAME": C.CARD_DAU[1], "CARD_NEW_MID_NAME": C.CARD_NEW_MID[1],
    "CARD_ORDER_AMOUNT_NAME": C.CARD_ORDER_AMOUNT[1],
    "TOPIC_STARTUP": C.TOPIC_STARTUP, "TOPIC_EVENT": C.TOPIC_EVENT,
    "TOPIC_ORDER_INFO": C.TOPIC_ORDER_INFO, "TOPIC_ORDER_DETAIL": C.TOPIC_ORDER_DETAIL,
    "TOPIC_USER_INFO": C.TOPIC_USER_INFO,
    "BAND_UNDER_20": C.BAND_UNDER_20, "BAND_20_TO_30": C.BAND_20_TO_30,
    "BAND_30_PLUS": C.BAND_30_PLUS,
    "GENDER_M": C.GENDER_NAMES["M"], "GENDER_F": C.GENDER_NAMES["F"],
}


def _fill(sql: str) -> str:
    for k, v in _SQL_VALUES.items():
        sql = sql.replace("{{" + k + "}}", v)
    assert "{{" not in sql, sql
    return sql


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = _fill(sql.strip())
        return fn
    return deco


# ---------------------------------------------------------------------------
# oracle building blocks: the FIXTURES.md mapping in DuckDB SQL
# ---------------------------------------------------------------------------
def cte(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


C_STARTUP = """
startup AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         'startup' AS type, epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour
  FROM events)"""

C_DEDUP = """
dedup AS (
  SELECT event_id, mid, uid, type, ts, log_date, log_hour FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, event_id) AS rn
    FROM startup) WHERE rn = 1)"""

C_FIRST_SEEN = """
first_seen AS (
  SELECT mid, ts, event_id, log_date, log_hour FROM (
    SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, event_id) AS rn
    FROM startup) WHERE rn = 1)"""

C_PURCHASES = """
purchases AS (
  SELECT CAST(event_id AS VARCHAR) AS id, value AS total_amount,
         strftime(ts, '%Y-%m-%d') AS create_date, strftime(ts, '%H') AS create_hour
  FROM events WHERE event_type = 'purchase')"""

STARTUP = "\n" + C_STARTUP.strip()
DEDUP = STARTUP + ",\n" + C_DEDUP.strip()
FIRST_SEEN = STARTUP + ",\n" + C_FIRST_SEEN.strip()


def _startup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.startup_logs(Tables(spark, sf_dir).events)


# ---------------------------------------------------------------------------
# DAU
# ---------------------------------------------------------------------------
@register("log_date_hour", "WITH" + STARTUP + """
SELECT event_id, mid, uid, type, ts, log_date, log_hour FROM startup""")
def q_log_date_hour(spark, sf_dir):
    return dau.with_dates(_startup(spark, sf_dir))


@register("dau_dedup", "WITH" + DEDUP + " SELECT * FROM dedup")
def q_dau_dedup(spark, sf_dir):
    return dau.dau_dedup(_startup(spark, sf_dir))


@register("dau_any_per_mid", "WITH" + STARTUP + """
SELECT event_id, mid, uid, type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, event_id) AS rn FROM startup)
WHERE rn = 1""")
def q_dau_any_per_mid(spark, sf_dir):
    return dau.dau_any_per_mid(_startup(spark, sf_dir))


@register("dau_total", "WITH" + DEDUP + """
SELECT log_date, count(*) AS dau FROM dedup GROUP BY log_date""")
def q_dau_total(spark, sf_dir):
    return dau.dau_total(dau.device_days(_startup(spark, sf_dir)))


@register("dau_by_hour", "WITH" + DEDUP + """
SELECT log_date, log_hour, count(*) AS dau FROM dedup GROUP BY log_date, log_hour""")
def q_dau_by_hour(spark, sf_dir):
    return dau.dau_by_hour(dau.device_days(_startup(spark, sf_dir)))


@register("dau_hour_map", "WITH" + DEDUP + """,
by_hour AS (SELECT log_date, log_hour, count(*) AS dau FROM dedup GROUP BY log_date, log_hour)
SELECT log_date,
       '{' || string_agg('"' || log_hour || '":' || CAST(dau AS VARCHAR), ',' ORDER BY log_hour) || '}'
         AS hour_map
FROM by_hour GROUP BY log_date""")
def q_dau_hour_map(spark, sf_dir):
    return dau.dau_hour_map(dau.device_days(_startup(spark, sf_dir)))


# The "seen" set is what earlier micro-batches stored: start-ups before noon;
# the current batch is every start-up from noon on.
BATCH_SPLIT_HOUR = "12"


@register("dau_cross_batch_anti", "WITH" + STARTUP + f""",
seen AS (SELECT DISTINCT mid, log_date FROM startup WHERE log_hour < '{BATCH_SPLIT_HOUR}'),
batch AS (SELECT * FROM startup WHERE log_hour >= '{BATCH_SPLIT_HOUR}'),
fresh AS (SELECT b.* FROM batch b
          WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.mid = b.mid AND s.log_date = b.log_date))
SELECT event_id, mid, uid, type, ts, log_date, log_hour FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, event_id) AS rn FROM fresh)
WHERE rn = 1""")
def q_dau_cross_batch_anti(spark, sf_dir):
    s = dau.with_dates(_startup(spark, sf_dir))
    seen = s.filter(F.col("log_hour") < BATCH_SPLIT_HOUR).select("mid", "log_date")
    batch = s.filter(F.col("log_hour") >= BATCH_SPLIT_HOUR).drop("log_date", "log_hour")
    return dau.dau_cross_batch(batch, seen)


HOUR_SPINE_SQL = """
spine AS (SELECT dt, lpad(CAST(h AS VARCHAR), 2, '0') AS hour
          FROM (SELECT dt, unnest(range(24)) AS h FROM (SELECT DISTINCT dt FROM series)))"""

TODAY_VS_YESTERDAY_SQL = """,""" + HOUR_SPINE_SQL + """
SELECT sp.dt, sp.hour, coalesce(t.v, {zero}) AS today, coalesce(y.v, {zero}) AS yesterday
FROM spine sp
LEFT JOIN series t ON t.dt = sp.dt AND t.hour = sp.hour
LEFT JOIN series y ON y.dt = strftime(CAST(sp.dt AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d')
                  AND y.hour = sp.hour"""


@register("dau_today_vs_yesterday", "WITH" + DEDUP + """,
series AS (SELECT log_date AS dt, log_hour AS hour, count(*) AS v FROM dedup GROUP BY 1, 2)"""
          + TODAY_VS_YESTERDAY_SQL.format(zero="CAST(0 AS BIGINT)"))
def q_dau_today_vs_yesterday(spark, sf_dir):
    return dau.dau_today_vs_yesterday(dau.device_days(_startup(spark, sf_dir)))


@register("dedup_counts", "WITH" + STARTUP + """
SELECT log_date, count(*) AS rows_before, count(DISTINCT mid) AS rows_after
FROM startup GROUP BY log_date""")
def q_dedup_counts(spark, sf_dir):
    return dau.dedup_counts(_startup(spark, sf_dir))


@register("keyed_upsert_latest", "WITH" + STARTUP + f"""
SELECT index_name, doc_id, event_id, uid, ts, log_hour FROM (
  SELECT '{dau.DAU_INDEX_PREFIX}-' || log_date AS index_name, mid AS doc_id, event_id, uid, ts, log_hour,
         row_number() OVER (PARTITION BY log_date, mid ORDER BY ts DESC, event_id DESC) AS rn
  FROM startup) WHERE rn = 1""")
def q_keyed_upsert_latest(spark, sf_dir):
    return dau.dau_docs_latest(_startup(spark, sf_dir))


@register("new_devices", "WITH" + FIRST_SEEN + """
SELECT log_date, count(*) AS new_mid FROM first_seen GROUP BY log_date""")
def q_new_devices(spark, sf_dir):
    return dau.new_devices(_startup(spark, sf_dir))


@register("new_devices_by_hour", "WITH" + FIRST_SEEN + """
SELECT log_date, log_hour, count(*) AS new_mid FROM first_seen GROUP BY log_date, log_hour""")
def q_new_devices_by_hour(spark, sf_dir):
    return dau.new_devices_by_hour(_startup(spark, sf_dir))


# ---------------------------------------------------------------------------
# Orders and GMV
# ---------------------------------------------------------------------------



def _orders(spark, sf_dir):
    return fx.order_info(Tables(spark, sf_dir).orders)


def _purchases(spark, sf_dir):
    return fx.purchase_orders(Tables(spark, sf_dir).events)


@register("order_date_hour", """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
       strftime(o_orderdate, '%Y-%m-%d') AS create_date,
       strftime(o_orderdate, '%H') AS create_hour
FROM orders""")
def q_order_date_hour(spark, sf_dir):
    return fx.as_record_ids(gmv.clean_orders(_orders(spark, sf_dir)).select(
        "id", "create_time", "create_date", "create_hour"))


@register("mask_phone", """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       substr('13' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'), 1, 4) || '********'
         AS consignee_tel
FROM orders""")
def q_mask_phone(spark, sf_dir):
    return fx.as_record_ids(gmv.clean_orders(_orders(spark, sf_dir)).select("id", "consignee_tel"))


@register("gmv_total", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS create_date, round(sum(o_totalprice), 2) AS gmv
FROM orders GROUP BY 1""")
def q_gmv_total(spark, sf_dir):
    return gmv.gmv_total(_orders(spark, sf_dir))


@register("gmv_by_hour", cte(C_PURCHASES) + """
SELECT create_date, create_hour, round(sum(total_amount), 2) AS gmv
FROM purchases GROUP BY 1, 2""")
def q_gmv_by_hour(spark, sf_dir):
    return gmv.gmv_by_hour(_purchases(spark, sf_dir))


C_GMV_SERIES = """
series AS (SELECT create_date AS dt, create_hour AS hour, round(sum(total_amount), 2) AS v
           FROM purchases GROUP BY 1, 2)"""


@register("gmv_today_vs_yesterday", cte(C_PURCHASES, C_GMV_SERIES).rstrip()
          + TODAY_VS_YESTERDAY_SQL.format(zero="0.0"))
def q_gmv_today_vs_yesterday(spark, sf_dir):
    return gmv.gmv_today_vs_yesterday(_purchases(spark, sf_dir))


@register("sales_by_province", """
SELECT CAST(c.c_nationkey AS VARCHAR) AS province_id, n.n_name AS province_name,
       count(*) AS order_count, round(sum(o.o_totalprice), 2) AS order_amount
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2""")
def q_sales_by_province(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return gmv.sales_by_province(t.orders, t.customer, t.nation)


# ---------------------------------------------------------------------------
# KPI cards and hour series
# ---------------------------------------------------------------------------
@register("realtime_total", cte(C_STARTUP, C_DEDUP, C_FIRST_SEEN, """
d AS (SELECT log_date AS dt, count(*) AS v FROM dedup GROUP BY 1)""", """
n AS (SELECT log_date AS dt, count(*) AS v FROM first_seen GROUP BY 1)""", """
g AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1)""", """
days AS (SELECT dt FROM d UNION SELECT dt FROM n UNION SELECT dt FROM g)""") + """
SELECT days.dt, 'dau' AS id, '{{CARD_DAU_NAME}}' AS name, CAST(coalesce(d.v, 0) AS DOUBLE) AS value
FROM days LEFT JOIN d ON d.dt = days.dt
UNION ALL
SELECT days.dt, 'new_mid', '{{CARD_NEW_MID_NAME}}', CAST(coalesce(n.v, 0) AS DOUBLE)
FROM days LEFT JOIN n ON n.dt = days.dt
UNION ALL
SELECT days.dt, 'order_amount', '{{CARD_ORDER_AMOUNT_NAME}}', CAST(g.v AS DOUBLE)
FROM days LEFT JOIN g ON g.dt = days.dt""")
def q_realtime_total(spark, sf_dir):
    return kpi.realtime_total(_startup(spark, sf_dir), _orders(spark, sf_dir))


# spine of the KPI hour series: every day with a start-up or an order
TODAY_VS_YESTERDAY_ALLDAYS_SQL = TODAY_VS_YESTERDAY_SQL.replace(
    "FROM (SELECT DISTINCT dt FROM series)", "FROM alldays")
C_ALLDAYS = """
alldays AS (SELECT log_date AS dt FROM startup UNION SELECT create_date FROM purchases)"""


def _series_sql(card_id: str, series_cte: str, zero: str) -> str:
    return ("SELECT '" + card_id + "' AS id, dt, hour, CAST(today AS DOUBLE) AS today, "
            "CAST(yesterday AS DOUBLE) AS yesterday FROM (" + "WITH " + series_cte.strip()
            + TODAY_VS_YESTERDAY_ALLDAYS_SQL.format(zero=zero) + ")")


@register("realtime_hours", cte(C_STARTUP, C_DEDUP, C_FIRST_SEEN, C_PURCHASES, C_ALLDAYS) + "\n"
          + _series_sql("dau", "series AS (SELECT log_date AS dt, log_hour AS hour, count(*) AS v "
                               "FROM dedup GROUP BY 1, 2)", "0")
          + "\nUNION ALL\n"
          + _series_sql("new_mid", "series AS (SELECT log_date AS dt, log_hour AS hour, count(*) AS v "
                                   "FROM first_seen GROUP BY 1, 2)", "0")
          + "\nUNION ALL\n"
          + _series_sql("order_amount", C_GMV_SERIES, "0.0"))
def q_realtime_hours(spark, sf_dir):
    return kpi.realtime_hours(_startup(spark, sf_dir), _purchases(spark, sf_dir))


# ---------------------------------------------------------------------------
# Ingest: raw logs and change feed
# ---------------------------------------------------------------------------
STAMP_MS = 1704067200000   # fixed server stamp for the stamping query


def _evid_sql(col: str = "event_type") -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fx.EVID_OF_EVENT_TYPE.items())
    return f"CASE {col} {cases} END"


C_RAW_FIELDS = f"""
raw AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS uid,
         CAST(user_id % {fx.N_EVENT_DEVICES} AS VARCHAR) AS emid,
         {_evid_sql()} AS evid,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS itemid
  FROM events)"""


@register("ingest_stamp", cte(C_RAW_FIELDS) + f"""
SELECT event_id, 'startup' AS kind,
       '{{"type":"startup","mid":"' || uid || '","uid":"' || uid || '","ts":{STAMP_MS}}}' AS value
FROM raw
UNION ALL
SELECT event_id, 'event' AS kind,
       '{{"type":"event","mid":"' || emid || '","uid":"' || uid || '","evid":"' || evid || '"'
       || CASE WHEN itemid IS NULL THEN '' ELSE ',"itemid":' || itemid END
       || ',"ts":{STAMP_MS}}}' AS value
FROM raw""")
def q_ingest_stamp(spark, sf_dir):
    raw = fx.raw_log_json(Tables(spark, sf_dir).events)
    return ingest.stamp_logs(raw, F.lit(STAMP_MS))


@register("ingest_route", """
SELECT event_id, 'startup' AS kind, '{{TOPIC_STARTUP}}' AS topic FROM events
UNION ALL
SELECT event_id, 'event' AS kind, '{{TOPIC_EVENT}}' AS topic FROM events""")
def q_ingest_route(spark, sf_dir):
    raw = fx.raw_log_json(Tables(spark, sf_dir).events)
    return ingest.route_logs(raw).select("event_id", "kind", "topic")


def _op_sql(key: str) -> str:
    return (f"CASE WHEN {key} % {fx.CDC_DELETE_MODULUS} = 0 THEN 'DELETE' "
            f"WHEN {key} % {fx.CDC_UPDATE_MODULUS} = 0 THEN 'UPDATE' ELSE 'INSERT' END")


def _json_obj_sql(pairs: list[tuple[str, str]]) -> str:
    parts = [f"'\"{name}\":\"' || {expr} || '\"'" for name, expr in pairs]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


C_CHANGES = f"""
changes AS (
  SELECT 'order_info' AS "table", {_op_sql('o_orderkey')} AS op, o_orderkey AS key,
         {_json_obj_sql([('id', 'CAST(o_orderkey AS VARCHAR)'),
                         ('user_id', 'CAST(o_custkey AS VARCHAR)'),
                         ('order_status', 'o_orderstatus'),
                         ('total_amount', 'CAST(o_totalprice AS VARCHAR)'),
                         ('create_time', "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"),
                         ('consignee_tel', "'13' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')")])} AS value
  FROM orders WHERE o_orderkey % {fx.CDC_NON_ROWDATA_MODULUS} <> 0
  UNION ALL
  SELECT 'order_detail', {_op_sql('l_orderkey')}, l_orderkey,
         {_json_obj_sql([('id', "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"),
                         ('order_id', 'CAST(l_orderkey AS VARCHAR)'),
                         ('sku_id', 'CAST(l_partkey AS VARCHAR)'),
                         ('order_price', 'CAST(l_extendedprice AS VARCHAR)'),
                         ('sku_num', 'CAST(l_quantity AS VARCHAR)')])}
  FROM lineitem WHERE l_orderkey % {fx.CDC_NON_ROWDATA_MODULUS} <> 0
  UNION ALL
  SELECT 'user_info', {_op_sql('c_custkey')}, c_custkey,
         {_json_obj_sql([('id', 'CAST(c_custkey AS VARCHAR)'),
                         ('login_name', 'c_name'),
                         ('user_level', 'c_mktsegment')])}
  FROM customer WHERE c_custkey % {fx.CDC_NON_ROWDATA_MODULUS} <> 0)"""


def _changes(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return fx.change_entries(t.orders, t.lineitem, t.customer)


@register("cdc_flatten", cte(C_CHANGES) + 'SELECT "table", op, key, value FROM changes')
def q_cdc_flatten(spark, sf_dir):
    return ingest.flatten_changes(_changes(spark, sf_dir), fx.CDC_DATABASE)


@register("cdc_route", cte(C_CHANGES) + """
SELECT topic, "table", op, key, value FROM (
  SELECT *, CASE
    WHEN "table" = 'order_info' AND op = 'INSERT' THEN '{{TOPIC_ORDER_INFO}}'
    WHEN "table" = 'order_detail' AND op = 'INSERT' THEN '{{TOPIC_ORDER_DETAIL}}'
    WHEN "table" = 'user_info' AND op IN ('INSERT', 'UPDATE') THEN '{{TOPIC_USER_INFO}}'
  END AS topic FROM changes) WHERE topic IS NOT NULL""")
def q_cdc_route(spark, sf_dir):
    return ingest.route_changes(ingest.flatten_changes(_changes(spark, sf_dir), fx.CDC_DATABASE))


# ---------------------------------------------------------------------------
# Sale detail: joins, users, enrichment
# ---------------------------------------------------------------------------

AS_OF = "2024-01-01"          # age reference date of the enrichment queries
INTERVAL_BOUND_S = 30 * 86400  # late-half bound of the batch interval join
KEYWORD = "red widget"
PAGE_NO, PAGE_SIZE = 2, 20

C_O = """
o AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS order_status,
             strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
             CAST(o_custkey AS VARCHAR) AS user_id, strftime(o_orderdate, '%Y-%m-%d') AS dt,
             strftime(o_orderdate, '%Y-%m') AS batch, o_orderdate AS order_time
      FROM orders)"""
C_D = """
d AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_detail_id,
             CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
             l_extendedprice AS sku_price, strftime(l_shipdate, '%Y-%m') AS batch,
             l_shipdate AS line_time, l_partkey
      FROM lineitem)"""
C_USER_VERSIONS = f"""
uv AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
         strftime(DATE '{fx.BIRTHDAY_BASE}' + CAST((c_custkey * {fx.BIRTHDAY_MULT}) % {fx.BIRTHDAY_SPAN} AS INTEGER),
                  '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, 1 AS version, c_custkey
  FROM customer)"""
C_USERS = C_USER_VERSIONS + f""",
uv2 AS (SELECT * FROM uv UNION ALL
        SELECT id, login_name, '{fx.UPDATED_USER_LEVEL}', birthday, gender, 2, c_custkey FROM uv
        WHERE c_custkey % {fx.UPDATED_USER_MODULUS} = 1),
users AS (SELECT id, login_name, user_level, birthday, gender FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM uv2) WHERE rn = 1)"""
C_WIDE = """
wide AS (SELECT d.order_detail_id, d.order_id, d.sku_id, d.sku_price, p.p_name AS sku_name,
                o.order_status, o.create_time, o.user_id, o.dt
         FROM d JOIN o ON o.order_id = d.order_id
         LEFT JOIN part p ON p.p_partkey = d.l_partkey)"""
C_ENRICHED = f"""
enriched AS (
  SELECT w.*, u.gender AS user_gender,
         coalesce(CAST(datediff('day', CAST(u.birthday AS DATE), DATE '{AS_OF}') // 365 AS INTEGER), 0)
           AS user_age,
         u.user_level
  FROM wide w LEFT JOIN users u ON u.id = w.user_id)"""
# the joins' user dimension: some customers have no user row
C_JOINED_USERS = C_USERS.replace("FROM customer)", f"FROM customer WHERE c_custkey % {fx.MISSING_USER_MODULUS} <> 0)")
SALE_SQL = [C_O, C_D, C_JOINED_USERS, C_WIDE, C_ENRICHED]
C_HITS = f"""
hits AS (SELECT * FROM enriched
         WHERE list_has_all(regexp_split_to_array(lower(sku_name), '[^\\p{{L}}\\p{{Nd}}]+'),
                            {[t for t in KEYWORD.lower().split()]}))"""
ORDER_COLS_SQL = "order_status, create_time, user_id, dt"
LINE_COLS_SQL = "order_detail_id, sku_id, sku_price"


def _sale_inputs(spark, sf_dir, with_time=False):
    t = Tables(spark, sf_dir)
    orders = fx.order_info(t.orders, with_time=with_time)
    lines = fx.order_lines(t.lineitem, with_time=with_time)
    return orders, lines


def _batched(spark, sf_dir):
    orders, lines = _sale_inputs(spark, sf_dir, with_time=True)
    return (orders.withColumn("batch", F.date_format("order_time", "yyyy-MM")),
            lines.withColumn("batch", F.date_format("line_time", "yyyy-MM")))


@register("order_line_full_outer", cte(C_O, C_D) + f"""
SELECT coalesce(o.order_id, d.order_id) AS order_id, coalesce(o.batch, d.batch) AS batch,
       {LINE_COLS_SQL}, {ORDER_COLS_SQL}
FROM o FULL OUTER JOIN d ON o.order_id = d.order_id AND o.batch = d.batch""")
def q_order_line_full_outer(spark, sf_dir):
    return fx.as_record_ids(sale.order_line_full_outer(*_batched(spark, sf_dir)))


@register("order_line_left", cte(C_O, C_D) + f"""
SELECT o.order_id, o.batch, {LINE_COLS_SQL}, {ORDER_COLS_SQL}
FROM o LEFT JOIN d ON o.order_id = d.order_id AND o.batch = d.batch""")
def q_order_line_left(spark, sf_dir):
    return fx.as_record_ids(sale.order_line_left(*_batched(spark, sf_dir)))


@register("order_line_right", cte(C_O, C_D) + f"""
SELECT d.order_id, d.batch, {LINE_COLS_SQL}, {ORDER_COLS_SQL}
FROM d LEFT JOIN o ON o.order_id = d.order_id AND o.batch = d.batch""")
def q_order_line_right(spark, sf_dir):
    return fx.as_record_ids(sale.order_line_right(*_batched(spark, sf_dir)))


def _wide(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return sale.sale_detail_wide(fx.order_info(t.orders),
                                 fx.order_lines_named(t.lineitem, t.part))


def _users(spark, sf_dir):
    return sale.user_dim_latest(fx.user_versions(Tables(spark, sf_dir).customer))


def _enriched(spark, sf_dir):
    users = fx.user_versions(Tables(spark, sf_dir).customer, some_missing=True)
    return sale.enrich(_wide(spark, sf_dir), sale.user_dim_latest(users), AS_OF)


@register("sale_detail_wide", cte(C_O, C_D, C_WIDE) + "SELECT * FROM wide")
def q_sale_detail_wide(spark, sf_dir):
    return fx.as_record_ids(_wide(spark, sf_dir))


def _json_field(name: str, expr: str, quoted: bool = True) -> str:
    q = "\"" if quoted else ""
    return (f"CASE WHEN {expr} IS NULL THEN NULL ELSE '\"{name}\":{q}' || CAST({expr} AS VARCHAR) "
            f"|| '{q}' END")


@register("sale_detail_json", cte(*SALE_SQL) + "SELECT order_detail_id, '{' || concat_ws(',', "
          + ", ".join(_json_field(c, c, c not in ("user_age", "sku_price"))
                      for c in sale.SALE_DETAIL_COLS) + ") || '}' AS doc FROM enriched")
def q_sale_detail_json(spark, sf_dir):
    return sale.sale_detail_json(fx.as_record_ids(_enriched(spark, sf_dir)))


@register("sale_detail_interval", cte(C_O, C_D) + f"""
SELECT o.order_id, {ORDER_COLS_SQL}, {LINE_COLS_SQL}
FROM o JOIN d ON o.order_id = d.order_id
 AND d.line_time BETWEEN o.order_time - INTERVAL {INTERVAL_BOUND_S} SECOND
                     AND o.order_time + INTERVAL {INTERVAL_BOUND_S} SECOND""")
def q_sale_detail_interval(spark, sf_dir):
    orders, lines = _sale_inputs(spark, sf_dir, with_time=True)
    return fx.as_record_ids(
        sale.sale_detail_interval(orders, lines, "order_time", "line_time", INTERVAL_BOUND_S)
        .drop("order_time", "line_time"))


@register("user_dim_latest", cte(C_USERS) + "SELECT * FROM users")
def q_user_dim_latest(spark, sf_dir):
    return fx.as_record_ids(_users(spark, sf_dir))


@register("user_age", cte(C_USERS) + f"""
SELECT id, birthday,
       CAST(datediff('day', CAST(birthday AS DATE), DATE '{AS_OF}') // 365 AS INTEGER) AS user_age
FROM users""")
def q_user_age(spark, sf_dir):
    return fx.as_record_ids(
        sale.user_age(_users(spark, sf_dir), AS_OF).select("id", "birthday", "user_age"))


@register("sale_detail_enriched", cte(*SALE_SQL) + "SELECT * FROM enriched")
def q_sale_detail_enriched(spark, sf_dir):
    return fx.as_record_ids(_enriched(spark, sf_dir))


# ---------------------------------------------------------------------------
# Search
# ---------------------------------------------------------------------------
def _hits(spark, sf_dir):
    return search.search(_enriched(spark, sf_dir), KEYWORD)


@register("sale_search_total", cte(*SALE_SQL, C_HITS) + """
SELECT dt, count(*) AS total FROM hits GROUP BY dt""")
def q_sale_search_total(spark, sf_dir):
    return search.search_total(_hits(spark, sf_dir))


@register("sale_search_page", cte(*SALE_SQL, C_HITS) + f"""
SELECT * FROM hits ORDER BY dt, order_detail_id
LIMIT {PAGE_SIZE} OFFSET {(PAGE_NO - 1) * PAGE_SIZE}""")
def q_sale_search_page(spark, sf_dir):
    return fx.as_record_ids(search.search_page(_hits(spark, sf_dir), PAGE_NO, PAGE_SIZE))


C_TOTALS = "totals AS (SELECT dt, count(*) AS total FROM hits GROUP BY dt)"


def _top_sql(term: str, n: int) -> str:
    return f"""
top_{term} AS (SELECT * FROM (
  SELECT dt, {term}, count(*) AS doc_count,
         row_number() OVER (PARTITION BY dt ORDER BY count(*) DESC, {term}) AS rk
  FROM hits WHERE {term} IS NOT NULL GROUP BY dt, {term}) WHERE rk <= {n})"""


def _share_sql(n: str, total: str) -> str:
    return f"coalesce(round(CAST({n} AS DOUBLE) * 1000.0 / NULLIF(CAST({total} AS DOUBLE), 0)) / 10.0, 0.0)"


@register("gender_share", cte(*SALE_SQL, C_HITS, C_TOTALS, _top_sql("user_gender", 2)) + f"""
SELECT t.dt, t.user_gender, t.doc_count, {_share_sql('t.doc_count', 's.total')} AS share
FROM top_user_gender t JOIN totals s ON s.dt = t.dt""")
def q_gender_share(spark, sf_dir):
    return search.gender_share(_hits(spark, sf_dir))


@register("age_terms", cte(*SALE_SQL, C_HITS, _top_sql("user_age", 100)) + """
SELECT dt, user_age, doc_count FROM top_user_age""")
def q_age_terms(spark, sf_dir):
    return search.age_terms(_hits(spark, sf_dir))


@register("age_band_share", cte(*SALE_SQL, C_HITS, C_TOTALS, _top_sql("user_age", 100), f"""
bands AS (SELECT s.dt,
  {_share_sql("coalesce(sum(CASE WHEN t.user_age < 20 THEN t.doc_count ELSE 0 END), 0)", "s.total")} AS a,
  {_share_sql("coalesce(sum(CASE WHEN t.user_age >= 20 AND t.user_age < 30 THEN t.doc_count ELSE 0 END), 0)", "s.total")} AS b
  FROM totals s LEFT JOIN top_user_age t ON t.dt = s.dt GROUP BY s.dt, s.total)""") + """
SELECT dt, '{{BAND_UNDER_20}}' AS name, a AS value FROM bands
UNION ALL SELECT dt, '{{BAND_20_TO_30}}', b FROM bands
UNION ALL SELECT dt, '{{BAND_30_PLUS}}', round(100.0 - a - b, 1) FROM bands""")
def q_age_band_share(spark, sf_dir):
    return search.age_band_share(_hits(spark, sf_dir))


# ---------------------------------------------------------------------------
# Event logs: decode, alerts, upsert
# ---------------------------------------------------------------------------
ALERT_SIZE, ALERT_SLIDE = "4 hours", "1 hour"   # fixture scale (sparse events)
ALERT_SIZE_MS, ALERT_SLIDE_MS = 4 * 3600000, 3600000

C_EV = f"""
ev AS (SELECT event_id, CAST(user_id % {fx.N_EVENT_DEVICES} AS VARCHAR) AS mid,
              CAST(user_id AS VARCHAR) AS uid, {_evid_sql()} AS evid,
              json_extract_string(props, '$.k') AS itemid, epoch_us(ts) // 1000 AS ts
       FROM events)"""
C_EVW = f"""
evw AS (SELECT *, (ts // {ALERT_SLIDE_MS} - k) * {ALERT_SLIDE_MS} AS ws,
               (ts // {ALERT_SLIDE_MS} - k) * {ALERT_SLIDE_MS} + {ALERT_SIZE_MS} AS we
        FROM (SELECT ev.*, unnest(range({ALERT_SIZE_MS // ALERT_SLIDE_MS})) AS k FROM ev))"""
TS_FMT = "'%Y-%m-%d %H:%M:%S'"
C_ALERTS = """
grp AS (SELECT ws, we, mid, count(DISTINCT CASE WHEN evid = 'coupon' THEN uid END) AS n_accounts,
               count(*) AS n_events, max(CASE WHEN evid = 'clickItem' THEN 1 ELSE 0 END) AS clicked
        FROM evw GROUP BY ws, we, mid),
alerts AS (SELECT mid, ws, we, n_accounts, n_events, we AS ts FROM grp
           WHERE n_accounts >= 3 AND clicked = 0),
members AS (SELECT e.* FROM evw e JOIN alerts a ON a.ws = e.ws AND a.we = e.we AND a.mid = e.mid)"""


def _ms_str(col: str) -> str:
    return f"strftime(make_timestamp({col} * 1000), {TS_FMT})"


def _ev(spark, sf_dir):
    return fx.event_logs(Tables(spark, sf_dir).events)


def _tsfmt(c):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss").alias(c)


@register("json_decode", cte(C_EV) + "SELECT event_id, mid, uid, 'event' AS type, evid, itemid, ts FROM ev")
def q_json_decode(spark, sf_dir):
    raw = ingest.route_logs(fx.raw_log_json(Tables(spark, sf_dir).events))
    events = raw.filter(F.col("topic") == TOPIC_EVENT)
    decoded = good_rows(decode(events, schemas.EVENT_LOG, keep=("event_id",)))
    return decoded.select("event_id", "mid", "uid", "type", "evid", "itemid", "ts")


@register("coupon_alert", cte(C_EV, C_EVW, C_ALERTS) + f"""
SELECT mid, {_ms_str('ws')} AS window_start, {_ms_str('we')} AS window_end,
       n_accounts, n_events, ts FROM alerts""")
def q_coupon_alert(spark, sf_dir):
    a = alert.coupon_alerts(_ev(spark, sf_dir), ALERT_SIZE, ALERT_SLIDE)
    return a.select("mid", _tsfmt("window_start"), _tsfmt("window_end"),
                    "n_accounts", "n_events", "ts")


@register("coupon_alert_docs", cte(C_EV, C_EVW, C_ALERTS) + f"""
SELECT '{alert.ALERT_INDEX_PREFIX}-' || strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS index_name,
       mid || '-' || CAST(ts // 60000 AS VARCHAR) AS doc_id, mid, n_accounts, n_events, ts
FROM alerts""")
def q_coupon_alert_docs(spark, sf_dir):
    return alert.alert_docs(alert.coupon_alerts(_ev(spark, sf_dir), ALERT_SIZE, ALERT_SLIDE))


def _alert_members(spark, sf_dir, fn):
    ev = _ev(spark, sf_dir)
    alerts = alert.coupon_alerts(ev, ALERT_SIZE, ALERT_SLIDE)
    out = fn(ev, alerts, ALERT_SIZE, ALERT_SLIDE)
    return out.select(*[_tsfmt(c) if c in ("window_start", "window_end") else c
                        for c in out.columns])


@register("coupon_alert_accounts", cte(C_EV, C_EVW, C_ALERTS) + f"""
SELECT DISTINCT {_ms_str('ws')} AS window_start, {_ms_str('we')} AS window_end, mid, uid
FROM members WHERE evid = 'coupon'""")
def q_coupon_alert_accounts(spark, sf_dir):
    return _alert_members(spark, sf_dir, alert.alert_accounts)


@register("coupon_alert_items", cte(C_EV, C_EVW, C_ALERTS) + f"""
SELECT DISTINCT {_ms_str('ws')} AS window_start, {_ms_str('we')} AS window_end, mid, itemid
FROM members WHERE evid = 'coupon' AND itemid IS NOT NULL""")
def q_coupon_alert_items(spark, sf_dir):
    return _alert_members(spark, sf_dir, alert.alert_items)


@register("coupon_alert_events", cte(C_EV, C_EVW, C_ALERTS) + f"""
SELECT {_ms_str('ws')} AS window_start, {_ms_str('we')} AS window_end, mid, event_id, evid, ts
FROM members""")
def q_coupon_alert_events(spark, sf_dir):
    return _alert_members(spark, sf_dir, alert.alert_events)


# windows that slide by a batch interval of 5 s (longer than the app's 5 minutes:
# the fixture's events are sparse)
FINE_SIZE, FINE_SLIDE = "30 minutes", "5 seconds"
FINE_SIZE_MS, FINE_SLIDE_MS = 30 * 60_000, 5_000
C_FINE = (C_EVW.replace(str(ALERT_SLIDE_MS), str(FINE_SLIDE_MS)).replace(str(ALERT_SIZE_MS), str(FINE_SIZE_MS))
          .replace(f"range({ALERT_SIZE_MS // ALERT_SLIDE_MS})", f"range({FINE_SIZE_MS // FINE_SLIDE_MS})"))


@register("coupon_alert_5s", cte(C_EV, C_FINE, C_ALERTS) + f"""
SELECT mid, {_ms_str('ws')} AS window_start, {_ms_str('we')} AS window_end,
       n_accounts, n_events, ts FROM alerts""")
def q_coupon_alert_5s(spark, sf_dir):
    a = alert.coupon_alerts_paned(_ev(spark, sf_dir), FINE_SIZE, FINE_SLIDE)
    return a.select("mid", _tsfmt("window_start"), _tsfmt("window_end"), "n_accounts", "n_events", "ts")


@register("coupon_alert_5s_events", cte(C_EV, C_FINE, C_ALERTS) + f"""
SELECT mid, {_ms_str('ws')} AS window_start, {_ms_str('we')} AS window_end, event_id, evid, uid, ts FROM members""")
def q_coupon_alert_5s_events(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    alerts = alert.coupon_alerts_paned(ev, FINE_SIZE, FINE_SLIDE)
    return alert.paned_members(ev, alerts, FINE_SIZE, FINE_SLIDE).select(
        "mid", _tsfmt("window_start"), _tsfmt("window_end"), "event_id", "evid", "uid", "ts")


@register("events_until_click", cte(C_EV, C_EVW) + f""",
fc AS (SELECT ws, mid, min((ts, event_id)) AS fc FROM evw WHERE evid = 'clickItem' GROUP BY ws, mid)
SELECT e.mid, {_ms_str('e.ws')} AS window_start, {_ms_str('e.we')} AS window_end,
       e.event_id, e.evid, e.ts
FROM evw e LEFT JOIN fc ON fc.ws = e.ws AND fc.mid = e.mid
WHERE fc.fc IS NULL OR (e.ts, e.event_id) <= fc.fc""")
def q_events_until_click(spark, sf_dir):
    r = alert.events_until_click(_ev(spark, sf_dir), ALERT_SIZE, ALERT_SLIDE)
    return r.select("mid", _tsfmt("window_start"), _tsfmt("window_end"), "event_id", "evid", "ts")


@register("search_stats", cte(*SALE_SQL, C_HITS, C_TOTALS, _top_sql("user_gender", 2),
                              _top_sql("user_age", 100), f"""
bands AS (SELECT s.dt,
  {_share_sql("coalesce(sum(CASE WHEN t.user_age < 20 THEN t.doc_count ELSE 0 END), 0)", "s.total")} AS a,
  {_share_sql("coalesce(sum(CASE WHEN t.user_age >= 20 AND t.user_age < 30 THEN t.doc_count ELSE 0 END), 0)", "s.total")} AS b
  FROM totals s LEFT JOIN top_user_age t ON t.dt = s.dt GROUP BY s.dt, s.total)""", f"""
opts AS (
  SELECT dt, 0 AS idx, 'age' AS title, 0 AS ord, '{C.BAND_UNDER_20}' AS name, a AS value FROM bands
  UNION ALL SELECT dt, 0, 'age', 1, '{C.BAND_20_TO_30}', b FROM bands
  UNION ALL SELECT dt, 0, 'age', 2, '{C.BAND_30_PLUS}', round(100.0 - a - b, 1) FROM bands
  UNION ALL
  SELECT t.dt, 1, 'gender', -t.doc_count,
         CASE t.user_gender WHEN 'M' THEN '{C.GENDER_NAMES["M"]}' WHEN 'F' THEN '{C.GENDER_NAMES["F"]}' ELSE t.user_gender END,
         {_share_sql('t.doc_count', 's.total')}
  FROM top_user_gender t JOIN totals s ON s.dt = t.dt)""") + """
SELECT dt, idx, title,
       '[' || string_agg('{"name":"' || name || '","value":' || CAST(value AS VARCHAR) || '}', ','
                         ORDER BY ord, name) || ']' AS options
FROM opts GROUP BY dt, idx, title""")
def q_search_stats(spark, sf_dir):
    st = search.search_stats(_hits(spark, sf_dir))
    return st.select("dt", "idx", "title", F.to_json("options").alias("options"))
