"""Registered queries over what the streaming apps store, and over
day-partitioned tables.

Each query writes the driver tables' records as the messages a topic would
carry, lets an app consume them all, and reads the app's own output; or stores
a day-partitioned table and asks for one day of it. Folders lie below the
session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow import catalog as Q
from shopflow import fixtures as fx
from shopflow.functions.json import log_topic
from shopflow.operators import bitmaps, paging, postings
from shopflow.plans import dau, gmv, sale, search, serve
from shopflow.session import checkpoint_root
from shopflow.sources import changes, streams
from shopflow.sources.tables import Tables
from shopflow.streaming import apps, halves, jobs, revenue, sinks

DAY = "2024-01-07"   # a day of the driver's events
NOW = {"availableNow": True}


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/app-queries/{uuid.uuid4().hex}"


def _lines(messages: DataFrame, path: str) -> None:
    """One JSON message a line; rows are objects of strings, as on a topic."""
    (messages.select(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in messages.columns])).alias("value"))
     .write.mode("append").text(path))


def _run(app, raw: DataFrame, out: str, root: str, **options) -> None:
    name = f"{app.__name__}_{root.rsplit('/', 1)[-1][:8]}"
    app(raw, out, name=name, trigger=NOW, checkpoint=f"{root}/ck", **options).awaitTermination()


@Q.register("stream_dau_table", "WITH" + Q.STARTUP + " SELECT DISTINCT mid, log_date FROM startup")
def q_stream_dau_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1 STR1 STR4 STR6-8 STR10 SNK1 SNK3: start-up messages through the DAU
    app, several micro-batches, then the stored device days."""
    root = _folder(spark)
    raw = fx.raw_log_json(Tables(spark, sf_dir).events).filter("kind = 'startup'").select("value")
    raw.repartition(4).write.text(f"{root}/in")
    _run(apps.dau_app, streams.text_files(spark, f"{root}/in", 2), f"{root}/out", root)
    return sinks.read_table(spark, f"{root}/out").select("mid", "log_date")


_MESSAGES = """
SELECT '{place}' AS place, '{{{{TOPIC_STARTUP}}}}' AS topic,
       '{{"type":"startup","mid":"' || uid || '","uid":"' || uid || '"}}' AS message FROM raw
UNION ALL
SELECT '{place}', '{{{{TOPIC_EVENT}}}}', '{{"type":"event","mid":"' || emid || '","uid":"' || uid || '","evid":"' || evid || '"'
       || CASE WHEN itemid IS NULL THEN '' ELSE ',"itemid":' || itemid END || '}}' FROM raw"""


@Q.register("stream_ingest_topics", Q.cte(Q.C_RAW_FIELDS) + _MESSAGES.format(place="topic") + " UNION ALL "
            + _MESSAGES.format(place="archive"))
def q_stream_ingest_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6 SNK7 PRJ10 FLT7: raw messages through the ingest app, then every
    message that its topics and its archive hold. The stamp (the time of this
    run) must be a message's last field and is taken off."""
    root = _folder(spark)
    fx.raw_log_json(Tables(spark, sf_dir).events).select("value").write.text(f"{root}/in")
    _run(apps.ingest_app, streams.text_files(spark, f"{root}/in"), f"{root}/archive", root,
         routed_path=f"{root}/routed")
    topics = spark.read.text(f"{root}/routed").select(F.lit("topic").alias("place"), "topic", "value")
    archive = spark.read.text(f"{root}/archive").select(F.lit("archive").alias("place"),
                                                        log_topic(F.col("value")).alias("topic"), "value")
    return topics.unionByName(archive).select(
        "place", "topic", F.regexp_replace("value", r',"ts":\d+\}$', "}").alias("message"))


@Q.register("stream_gmv_day", Q.cte(Q.C_PURCHASES) + f"""
SELECT round(sum(total_amount), 2) AS gmv FROM purchases WHERE create_date = '{DAY}'""")
def q_stream_gmv_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4 FLT8 SNK1: order messages through the GMV app, then one day of its
    partitioned table."""
    root = _folder(spark)
    _lines(fx.purchase_orders(Tables(spark, sf_dir).events), f"{root}/in")
    _run(apps.gmv_app, streams.text_files(spark, f"{root}/in"), f"{root}/out", root)
    return serve.gmv_total(spark, f"{root}/out", DAY)


@Q.register("stream_user_dim", Q.cte(Q.C_USERS) + "SELECT id, login_name, user_level, birthday, gender FROM users")
def q_stream_user_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2 SNK4: user messages through the user app, later versions after a
    restart and a compaction, then the latest version per user."""
    root = _folder(spark)
    users = fx.user_versions(Tables(spark, sf_dir).customer)
    for version in (1, 2):
        _lines(users.filter(F.col("version") == version).drop("version"), f"{root}/in")
        _run(apps.user_app, streams.text_files(spark, f"{root}/in"), f"{root}/out", root)
        if version == 1:
            sinks.compact_keyed(spark, f"{root}/out", ["id"], ["version"])
    latest = sinks.read_keyed(spark, f"{root}/out", ["id"], ["version"])
    return latest.select("id", "login_name", "user_level", "birthday", "gender")


@Q.register("stream_alert_docs", Q.cte(Q.C_EV, Q.C_EVW, Q.C_ALERTS) + """
SELECT mid || '-' || CAST(ts // 60000 AS VARCHAR) AS doc_id, mid, ts FROM alerts""")
def q_stream_alert_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2 STR3 SNK2: event messages through the alert app, then the latest
    document per id."""
    root = _folder(spark)
    raw = fx.raw_log_json(Tables(spark, sf_dir).events).filter("kind = 'event'").select("value")
    raw.write.text(f"{root}/in")
    _run(apps.alert_app, streams.text_files(spark, f"{root}/in"), f"{root}/out", root,
         size=Q.ALERT_SIZE, slide=Q.ALERT_SLIDE, mode="update")
    docs = sinks.read_table(spark, f"{root}/out",
                            empty_schema="doc_id string, mid string, ts long, index_name string")
    return sinks.latest_view(docs, ["doc_id"]).select("doc_id", "mid", "ts")


_STORED: dict[tuple[str, str], str] = {}


def _day_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The tables that requests read, stored once per application and input."""
    key = spark.sparkContext.applicationId, sf_dir
    if key in _STORED:
        return f"{_STORED[key]}/dau", f"{_STORED[key]}/orders"
    root, t = _folder(spark), Tables(spark, sf_dir)
    sinks.write_batch(dau.dau_dedup(fx.startup_logs(t.events)), 0, f"{root}/dau", ["log_date"])
    sinks.write_batch(gmv.clean_orders(fx.purchase_orders(t.events)), 0, f"{root}/orders", ["create_date"])
    _STORED[key] = root
    return f"{root}/dau", f"{root}/orders"


@Q.register("request_total", Q.cte(Q.C_STARTUP, Q.C_DEDUP, Q.C_FIRST_SEEN, Q.C_PURCHASES) + f"""
SELECT 'dau' AS id, '{{{{CARD_DAU_NAME}}}}' AS name, CAST(count(*) AS DOUBLE) AS value FROM dedup WHERE log_date = '{DAY}'
UNION ALL SELECT 'new_mid', '{{{{CARD_NEW_MID_NAME}}}}', CAST(count(*) AS DOUBLE) FROM first_seen WHERE log_date = '{DAY}'
UNION ALL SELECT 'order_amount', '{{{{CARD_ORDER_AMOUNT_NAME}}}}', round(sum(total_amount), 2) FROM purchases
WHERE create_date = '{DAY}'""")
def q_request_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4 FLT8 SET1: the cards of one day from stored tables."""
    return serve.realtime_total(spark, *_day_tables(spark, sf_dir), DAY)


@Q.register("request_hours", Q.cte(Q.C_STARTUP, Q.C_DEDUP) + f"""
SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hour,
       CAST(count(*) FILTER (log_date = '{DAY}') AS DOUBLE) AS today,
       CAST(count(*) FILTER (log_date = CAST(DATE '{DAY}' - 1 AS VARCHAR)) AS DOUBLE) AS yesterday
FROM range(24) r(h) LEFT JOIN dedup ON CAST(log_hour AS INTEGER) = h GROUP BY 1""")
def q_request_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4 FLT8 SET3: the hours of one day and the day before."""
    return serve.realtime_hours(spark, "dau", *_day_tables(spark, sf_dir), DAY)


# --- order/line join with waiting halves ---------------------------------------

#: arrival times (order and ship dates) up to which the first releases reach
RELEASES = ("1997-04-01", "1999-06-01")
BOUND_S = Q.INTERVAL_BOUND_S
#: a message past every bound: the streams' clocks have moved on
LAST = "2100-01-01"


def _released(spark: SparkSession, df: DataFrame, path: str, run) -> None:
    """Writes rows in the order of their arrival ``at``, one release after the
    other, and lets ``run`` consume each before the next comes (the query starts
    again from its checkpoint every time)."""
    edges = [None, *RELEASES, None]
    for low, high in zip(edges, edges[1:]):
        part = df
        if low is not None:
            part = part.filter(F.col("at") >= F.lit(low).cast("timestamp"))
        if high is not None:
            part = part.filter(F.col("at") < F.lit(high).cast("timestamp"))
        part.write.mode("append").partitionBy("side").parquet(path)
        run()
    clock = spark.range(1).select(F.lit(None).cast("string").alias("order_id"), F.lit(None).cast("string").alias("body"),
                                  F.lit(LAST).cast("timestamp").alias("at"),
                                  F.explode(F.array(F.lit(halves.ORDER_ONLY), F.lit(halves.LINE_ONLY))).alias("side"))
    clock.write.mode("append").partitionBy("side").parquet(path)
    run()


def _halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return (halves.half(fx.order_info(t.orders, with_time=True), halves.ORDER_ONLY, "id", "order_time",
                        ["order_status", "create_time", "user_id"])
            .unionByName(halves.half(fx.order_lines(t.lineitem, with_time=True), halves.LINE_ONLY, "order_id",
                                     "line_time", ["id", "sku_id", "order_price"])))


def _topic(spark: SparkSession, path: str, side: str) -> DataFrame:
    return (streams.parquet_files(spark, path, halves.HALF).filter(F.col("side") == side)
            .withColumn("side", F.when(F.col("order_id").isNull(), halves.CLOCK).otherwise(F.col("side"))))


@Q.register("stream_order_lines", Q.cte(Q.C_O, Q.C_D) + f"""
SELECT o.order_id, d.order_detail_id, d.sku_id, d.sku_price, o.order_status, o.create_time, o.user_id
FROM o JOIN d ON o.order_id = d.order_id
 AND d.line_time BETWEEN o.order_time - INTERVAL {BOUND_S} SECOND AND o.order_time + INTERVAL {BOUND_S} SECOND""")
def q_stream_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5 STR5 JN4: orders and lines as they arrive, joined in keyed state that
    holds each half until its bound has passed."""
    root, rows = _folder(spark), _halves(spark, sf_dir)
    buckets = halves.buckets_for(rows.count())

    def run() -> None:
        both = _topic(spark, f"{root}/in", halves.ORDER_ONLY).unionByName(
            _topic(spark, f"{root}/in", halves.LINE_ONLY))
        jobs.start(halves.halves_stream(both, BOUND_S, buckets=buckets), f"halves_{root[-8:]}", halves.halves_sink(f"{root}/out"),
                   trigger=NOW, checkpoint=f"{root}/ck").awaitTermination()
    _released(spark, rows, f"{root}/in", run)
    pairs = sinks.read_table(spark, f"{root}/out").filter(F.col("found") == halves.PAIR)
    return pairs.select("order_id", halves.field("line_body", "id").alias("order_detail_id"),
                        halves.field("line_body", "sku_id"),
                        halves.field("line_body", "order_price", "double").alias("sku_price"),
                        *[halves.field("order_body", c) for c in ("order_status", "create_time", "user_id")])


@Q.register("stream_late_halves", Q.cte(Q.C_O, Q.C_D, f"""
pairs AS (SELECT d.order_detail_id, o.order_id, o.order_time IS NOT NULL AND d.line_time BETWEEN
                 o.order_time - INTERVAL {BOUND_S} SECOND AND o.order_time + INTERVAL {BOUND_S} SECOND AS in_time,
                 coalesce(o.order_id, d.order_id) AS id
          FROM d LEFT JOIN o ON o.order_id = d.order_id)""") + """
SELECT CASE WHEN in_time THEN 'pair' WHEN order_id IS NOT NULL THEN 'late' ELSE 'line' END AS found,
       id AS order_id, order_detail_id FROM pairs
UNION ALL
SELECT 'order', order_id, NULL FROM o WHERE order_id NOT IN (SELECT order_id FROM d)""")
def q_stream_late_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR9 STR5: the outer stream-stream join's pairs and halves, then the
    repair step over what it stored; every line and every lone order once."""
    root, rows = _folder(spark), _halves(spark, sf_dir)
    buckets = halves.buckets_for(rows.count())

    def run() -> None:
        joined = halves.outer_stream(*[_topic(spark, f"{root}/in", s)
                                       for s in (halves.ORDER_ONLY, halves.LINE_ONLY)], BOUND_S, buckets=buckets)
        jobs.start(joined, f"outer_{root[-8:]}", halves.halves_sink(f"{root}/out"), trigger=NOW,
                   checkpoint=f"{root}/ck").awaitTermination()
    _released(spark, rows, f"{root}/in", run)
    return halves.repaired(spark, f"{root}/out").select(
        "found", "order_id", halves.field("line_body", "id").alias("order_detail_id"))


# --- inverted index, device bitmaps ---------------------------------------------

def _batches(df: DataFrame, key: str, n: int = 2) -> list[DataFrame]:
    """The rows in the batches they arrive in (dealt by key)."""
    own = F.pmod(F.xxhash64(key), F.lit(n))
    return [df.filter(own == i) for i in range(n)]


@Q.register("index_search_total", Q.cte(*Q.SALE_SQL, Q.C_HITS) + """
SELECT dt, count(*) AS total FROM hits GROUP BY dt""")
def q_index_search_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5 FLT9 AGG12: sale lines indexed in two batches, then the keyword's
    totals from the posting lists of its tokens alone."""
    root, t = _folder(spark), Tables(spark, sf_dir)
    wide = sale.sale_detail_wide(fx.order_info(t.orders), fx.order_lines_named(t.lineitem, t.part))
    # a line id occurs more than once in the driver's table: each is a hit. It
    # begins with its order's id, by which the join has already dealt the rows
    numbered = wide.select("dt", "sku_name", F.concat_ws("#", "order_detail_id", F.row_number().over(
        Window.partitionBy("order_id", "order_detail_id").orderBy("sku_price"))).alias("doc_id"))
    numbered.write.parquet(f"{root}/docs")   # joined and numbered once for both batches
    docs = spark.read.parquet(f"{root}/docs")
    for i, batch in enumerate(_batches(docs, "doc_id")):
        postings.write_postings(postings.posting_rows(batch, "doc_id", "sku_name", "dt"), i, f"{root}/postings")
    return search.search_total(postings.lookup(spark, f"{root}/postings", Q.KEYWORD))


def _device_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start-ups in two deliveries, late ones among them: numbers and bitmaps
    stored batch by batch."""
    root = _folder(spark)
    rows = dau.with_dates(fx.startup_logs(Tables(spark, sf_dir).events)).select("event_id", "mid", "log_date")
    for i, batch in enumerate(_batches(rows, "event_id")):
        known = sinks.read_table(spark, f"{root}/numbers", before_batch=i, empty_schema="mid string, slot int, n long")
        sinks.write_batch(bitmaps.number(batch, known), i, f"{root}/numbers")
        numbers = sinks.read_table(spark, f"{root}/numbers").drop(sinks.BATCH_COL)
        sinks.write_batch(bitmaps.day_bits(batch, numbers), i, f"{root}/bits", ["log_date"])
    return sinks.read_table(spark, f"{root}/bits")


@Q.register("bitmap_dau_total", "WITH" + Q.DEDUP + """
SELECT log_date, count(*) AS dau FROM dedup GROUP BY log_date""")
def q_bitmap_dau_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3: devices per day from stored bitmaps."""
    return bitmaps.totals(_device_bits(spark, sf_dir))


@Q.register("bitmap_new_devices", "WITH" + Q.FIRST_SEEN + """
SELECT log_date, count(*) AS new_mid FROM first_seen GROUP BY log_date""")
def q_bitmap_new_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG14: new devices per day from stored bitmaps, right although part of
    every day comes in the second delivery."""
    return bitmaps.new_per_day(_device_bits(spark, sf_dir))


# --- revenue by differences, pages, change feed, user lookup ----------------------

#: the second delivery: unchanged orders, and changed ones an hour later
AGAIN, CHANGED, MORE = 5, 7, 10.0


@Q.register("stream_revenue_hours", f"""
WITH purchases AS (
  SELECT CASE WHEN event_id % {CHANGED} = 0 THEN value + {MORE} ELSE value END AS amount,
         CASE WHEN event_id % {CHANGED} = 0 THEN ts + INTERVAL 1 HOUR ELSE ts END AS moved
  FROM events WHERE event_type = 'purchase')
SELECT strftime(moved, '%Y-%m-%d') AS create_date, strftime(moved, '%H') AS create_hour, round(sum(amount), 2) AS gmv
FROM purchases GROUP BY 1, 2""")
def q_stream_revenue_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5 AGG6: orders, then some again and some changed, through the revenue
    app; hours from its stored differences."""
    root = _folder(spark)
    first = fx.purchase_orders(Tables(spark, sf_dir).events)
    changed = F.col("id") % CHANGED == 0
    later = F.date_format(F.to_timestamp("create_time") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm:ss")
    second = first.filter(changed | (F.col("id") % AGAIN == 0)).select(
        "id", F.when(changed, F.col("total_amount") + MORE).otherwise(F.col("total_amount")).alias("total_amount"),
        F.when(changed, later).otherwise(F.col("create_time")).alias("create_time"))
    for delivery in (first, second):
        _lines(delivery, f"{root}/in")
        _run(apps.revenue_app, streams.text_files(spark, f"{root}/in"), f"{root}/out", root)
    return revenue.by_hour(sinks.read_table(spark, f"{root}/out/deltas"))


PAGE_ORDER = ["dt", "order_detail_id", "sku_price"]
PAGE_SIZE, NEAR, FAR = 20, 2, 700
C_PAGED = "SELECT dt, order_detail_id, order_id, sku_id, sku_price FROM d JOIN o USING (order_id)"


def _page_sql(page_no: int) -> str:
    return (Q.cte(Q.C_O, Q.C_D) + f"SELECT * FROM ({C_PAGED}) ORDER BY {', '.join(PAGE_ORDER)} "
            f"LIMIT {PAGE_SIZE} OFFSET {(page_no - 1) * PAGE_SIZE}")


def _sale_page(spark: SparkSession, sf_dir: str, page_no: int) -> DataFrame:
    root, t = _folder(spark), Tables(spark, sf_dir)
    wide = fx.as_record_ids(sale.sale_detail_wide(fx.order_info(t.orders), fx.order_lines(t.lineitem)))
    paging.build(wide.select("dt", "order_detail_id", "order_id", "sku_id", "sku_price"), PAGE_ORDER,
                 f"{root}/pages", part_rows=2_000)
    return paging.page(spark, f"{root}/pages", PAGE_ORDER, page_no, PAGE_SIZE)


@Q.register("sale_page_near", _page_sql(NEAR))
def q_sale_page_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIM2 PRJ19: the second page of all sale lines, from one part."""
    return _sale_page(spark, sf_dir, NEAR)


@Q.register("sale_page_far", _page_sql(FAR))
def q_sale_page_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIM2 PRJ19: a page far behind, from one part as well."""
    return _sale_page(spark, sf_dir, FAR)


@Q.register("stream_change_feed", Q.cte(Q.C_CHANGES) + """
SELECT topic, value FROM (
  SELECT *, CASE
    WHEN "table" = 'order_info' AND op = 'INSERT' THEN '{{TOPIC_ORDER_INFO}}'
    WHEN "table" = 'order_detail' AND op = 'INSERT' THEN '{{TOPIC_ORDER_DETAIL}}'
    WHEN "table" = 'user_info' AND op IN ('INSERT', 'UPDATE') THEN '{{TOPIC_USER_INFO}}'
  END AS topic FROM changes) WHERE topic IS NOT NULL""")
def q_stream_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3 FLT5 FLT6 PRJ9 SNK6: change entries of two databases as files, read
    by the change-feed source in fetches and routed, in two runs; then every
    message of the topics."""
    root, t = _folder(spark), Tables(spark, sf_dir)
    entries = fx.change_entries(t.orders, t.lineitem, t.customer).drop("key")
    other = entries.withColumn("database", F.lit("other"))
    for i, part in enumerate((entries.filter("table <> 'order_detail'").unionByName(other.filter("table = 'user_info'")),
                              entries.filter("table = 'order_detail'"))):
        # names must grow from delivery to delivery
        part.select(F.to_json(F.struct(*part.columns)).alias("value")).write.text(f"{root}/drop-{i}", compression="gzip")
        changes.deliver(spark, f"{root}/drop-{i}", f"{root}/in", f"{i:04d}")
        _run(apps.cdc_app, changes.change_files(spark, f"{root}/in", fx.CDC_DATABASE), f"{root}/out", root)
    return spark.read.text(f"{root}/out").select("topic", "value")


@Q.register("stream_first_seen", "WITH" + Q.FIRST_SEEN + """
SELECT log_date, log_hour, count(*) AS new_mid FROM first_seen GROUP BY log_date, log_hour""")
def q_stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG14: start-ups, the later half of the month first, through the
    first-seen app; new devices per hour of their earliest record."""
    root = _folder(spark)
    raw = fx.raw_log_json(Tables(spark, sf_dir).events).filter("kind = 'startup'")
    day = F.dayofmonth(F.timestamp_millis(F.get_json_object("value", "$.ts").cast("long")))
    for late in (True, False):
        raw.filter((day > 15) if late else (day <= 15)).select("value").write.mode("append").text(f"{root}/in")
        _run(apps.first_seen_app, streams.text_files(spark, f"{root}/in"), f"{root}/out", root)
    deltas = sinks.read_table(spark, f"{root}/out/deltas")
    return (deltas.groupBy(F.col("create_date").alias("log_date"), F.col("create_hour").alias("log_hour"))
            .agg(F.sum("orders").alias("new_mid")).filter("new_mid <> 0"))
