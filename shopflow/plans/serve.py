"""Request-time queries over the tables the streaming apps write.

These answer the dashboard's requests for one day -- KPI cards, the hour
series of one card, and a sale-detail search page with its stats -- from the
day-partitioned outputs (DAU table by ``log_date``, orders by
``create_date``, sale detail by ``dt``). Day filters hit the partition
column and only the folders of those days are listed, so a request costs what
its days hold; new devices come from the changes that the first-seen app writes
(without them, from the device column of all days).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow import schemas
from shopflow.constants import BAND_20_TO_30, BAND_30_PLUS, BAND_UNDER_20
from shopflow.operators.joins import today_vs_yesterday
from shopflow.plans import kpi, search
from shopflow.streaming import revenue, sinks

#: columns of a stored table that has no rows for a day
DAU_COLS = "mid string, log_date string, log_hour string"
ORDER_COLS = "id string, total_amount double, create_date string, create_hour string"
SALE_COLS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.SALE_DETAIL.fields)


def _day_before(date: str) -> str:
    """Request parameter arithmetic (no Spark job)."""
    return (_dt.date.fromisoformat(date) - _dt.timedelta(days=1)).isoformat()


def _dau(spark: SparkSession, dau_path: str, days: list[str]) -> DataFrame:
    """Stored devices of the given days; other days are not even listed."""
    return (sinks.read_days(spark, dau_path, "log_date", days, empty_schema=DAU_COLS)
            .filter(F.col("log_date").isin(days)))


def _dau_until(spark: SparkSession, dau_path: str, date: str) -> DataFrame:
    return (sinks.read_table(spark, dau_path, empty_schema=DAU_COLS)
            .filter(F.col("log_date") <= date).select("mid", "log_date", "log_hour"))


def _orders(spark: SparkSession, orders_path: str, days: list[str]) -> DataFrame:
    """Orders of the given days, latest version per order id: a re-delivered
    order is counted once. An order's ``create_date`` never changes, so its
    versions share a day partition and only those days are read."""
    o = (sinks.read_days(spark, orders_path, "create_date", days, empty_schema=ORDER_COLS)
         .filter(F.col("create_date").isin(days)))
    order = [c for c in ("version",) if c in o.columns]  # arrival, within a batch
    return sinks.latest_view(o, ["id"], order).drop(sinks.BATCH_COL)


def dau_total(spark: SparkSession, dau_path: str, date: str) -> DataFrame:
    """Active devices of one day (one partition)."""
    d = _dau(spark, dau_path, [date])
    return d.agg(F.count(F.lit(1)).alias("dau"))


def new_devices(spark: SparkSession, dau_path: str, date: str,
                first_path: str | None = None) -> DataFrame:
    """Devices active on ``date`` and on no earlier day: one day of the
    first-seen changes, or without them the device column of all days so far."""
    if first_path:
        first = revenue.new_devices(spark, first_path, [date])
        return first.agg(F.coalesce(F.sum("v"), F.lit(0)).alias("new_mid"))
    t = _dau_until(spark, dau_path, date)
    today = t.filter(F.col("log_date") == date).select("mid")
    before = t.filter(F.col("log_date") < date).select("mid")
    return (today.join(before.distinct(), "mid", "left_anti")
            .agg(F.count(F.lit(1)).alias("new_mid")))


def gmv_total(spark: SparkSession, orders_path: str, date: str) -> DataFrame:
    """Revenue of one day; NULL when the day has no orders."""
    o = _orders(spark, orders_path, [date])
    return o.agg(F.round(F.sum("total_amount"), 2).alias("gmv"))


def realtime_total(spark: SparkSession, dau_path: str, orders_path: str, date: str,
                   first_path: str | None = None) -> DataFrame:
    """The three KPI cards of one day: ``id, name, value``."""
    cards = [(kpi.CARD_DAU, dau_total(spark, dau_path, date).select(F.col("dau").cast("double"))),
             (kpi.CARD_NEW_MID, new_devices(spark, dau_path, date, first_path)
              .select(F.col("new_mid").cast("double"))),
             (kpi.CARD_ORDER_AMOUNT, gmv_total(spark, orders_path, date)
              .select(F.col("gmv").cast("double")))]
    out = None
    for (cid, name), v in cards:
        row = v.select(F.lit(cid).alias("id"), F.lit(name).alias("name"),
                       F.col(v.columns[0]).alias("value"))
        out = row if out is None else out.unionByName(row)
    return out


def realtime_hours(spark: SparkSession, card_id: str, dau_path: str, orders_path: str,
                   date: str, fill: bool = True, first_path: str | None = None) -> DataFrame:
    """Hour series of one card for ``date`` next to the day before (24 rows;
    without ``fill``, NULL in hours without data); an unknown id gives an empty
    result. Reads two day partitions (new devices without a first-seen table:
    all days up to ``date``)."""
    days = [date, _day_before(date)]
    # the requested day is the spine: always 24 rows, zero-filled
    spine = spark.createDataFrame([(date,)], "dt string")
    if card_id == kpi.CARD_DAU[0]:
        s = (_dau(spark, dau_path, days)
             .groupBy("log_date", "log_hour").agg(F.count(F.lit(1)).alias("v")))
        series = today_vs_yesterday(s, "log_date", "log_hour", "v", days=spine, fill=fill)
    elif card_id == kpi.CARD_ORDER_AMOUNT[0]:
        s = (_orders(spark, orders_path, days)
             .groupBy("create_date", "create_hour")
             .agg(F.round(F.sum("total_amount"), 2).alias("v")))
        series = today_vs_yesterday(s, "create_date", "create_hour", "v", zero=F.lit(0.0),
                                    days=spine, fill=fill)
    elif card_id == kpi.CARD_NEW_MID[0]:
        if first_path:
            s = revenue.new_devices(spark, first_path, days)
        else:
            first = (_dau_until(spark, dau_path, date).groupBy("mid")
                     .agg(F.min(F.struct("log_date", "log_hour")).alias("f")).select("f.*"))
            s = (first.filter(F.col("log_date").isin(days))
                 .groupBy("log_date", "log_hour").agg(F.count(F.lit(1)).alias("v")))
        series = today_vs_yesterday(s, "log_date", "log_hour", "v", days=spine, fill=fill)
    else:
        s = spark.createDataFrame([], "log_date string, log_hour string, v long")
        series = today_vs_yesterday(s, "log_date", "log_hour", "v", days=spine.limit(0))
    return (series.filter(F.col("dt") == date)
            .select("hour", F.col("today").cast("double").alias("today"),
                    F.col("yesterday").cast("double").alias("yesterday")))


@dataclass
class SaleDetailResult:
    """The search page: ``total`` hits, one ``detail`` page and the two
    ``stat`` rows (age bands, gender shares)."""
    total: DataFrame
    detail: DataFrame
    stat: DataFrame


def sale_detail(spark: SparkSession, sale_path: str, date: str, page_no: int, size: int,
                keyword: str) -> SaleDetailResult:
    """One search request: the day's partition, all-terms keyword match, a
    1-based page in line-id order and the age/gender stats. Read the latest
    document per line id (upsert view). Without a hit the total is 0, the first
    two age bands have share 0 and no gender is listed."""
    day = (sinks.read_days(spark, sale_path, "dt", [date], empty_schema=SALE_COLS).filter(F.col("dt") == date))
    docs = sinks.latest_view(day, ["order_detail_id"]).drop(sinks.BATCH_COL)
    hits = search.search(docs, keyword)
    stats = search.search_stats(hits).drop("dt")
    return SaleDetailResult(
        total=hits.agg(F.count(F.lit(1)).alias("total")),
        detail=search.search_page(hits, page_no, size),
        stat=(_no_hits(spark).join(stats, ["idx", "title"], "left")
              .select("idx", "title", F.coalesce("options", "none").alias("options")).orderBy("idx")),
    )


def _no_hits(spark: SparkSession) -> DataFrame:
    """The stats of a search without hits (two rows)."""
    bands = [(BAND_UNDER_20, 0.0), (BAND_20_TO_30, 0.0), (BAND_30_PLUS, 100.0)]
    return spark.createDataFrame([(0, search.STAT_AGE, bands), (1, search.STAT_GENDER, [])],
                                 "idx int, title string, none array<struct<name:string,value:double>>")


def _number(value: F.Column, card_id: F.Column) -> F.Column:
    """A card's value as a JSON number: counts are whole, revenue is not."""
    whole = card_id.isin(kpi.CARD_DAU[0], kpi.CARD_NEW_MID[0])
    return F.when(whole, F.parse_json(value.cast("bigint").cast("string"))) \
        .otherwise(F.parse_json(value.cast("double").cast("string")))


def realtime_total_json(spark: SparkSession, dau_path: str, orders_path: str,
                        date: str, first_path: str | None = None) -> DataFrame:
    """The ``realtime-total`` response body: a JSON list of the three cards
    (one row, one ``body`` column; 3 entries collected). Counts are whole
    numbers; the revenue of a day without orders is null."""
    cards = realtime_total(spark, dau_path, orders_path, date, first_path).withColumn(
        "ord", F.when(F.col("id") == kpi.CARD_DAU[0], 0)
        .when(F.col("id") == kpi.CARD_NEW_MID[0], 1).otherwise(2))
    entries = F.array_sort(F.collect_list(F.struct("ord", "id", "name", "value")))
    return cards.agg(F.to_json(F.transform(entries, lambda e: F.struct(
        e["id"].alias("id"), e["name"].alias("name"), _number(e["value"], e["id"]).alias("value"))),
        {"ignoreNullFields": "false"}).alias("body"))


def realtime_hours_json(spark: SparkSession, card_id: str, dau_path: str, orders_path: str,
                        date: str, first_path: str | None = None) -> DataFrame:
    """The ``realtime-hours`` response body ``{"yesterday": {HH: v},
    "today": {HH: v}}`` with only the hours that have data (the page fills
    the rest; an hour whose total is 0 has data); an unknown id gives ``{}``.
    At most 24 entries per day are collected."""
    if card_id not in kpi.CARD_IDS:
        return spark.range(1).select(F.lit("{}").alias("body"))
    s = realtime_hours(spark, card_id, dau_path, orders_path, date, False, first_path)
    kind = "double" if card_id == kpi.CARD_ORDER_AMOUNT[0] else "bigint"

    def hour_map(col: str):
        entries = F.array_sort(F.collect_list(
            F.when(F.col(col).isNotNull(), F.struct(F.col("hour"), F.col(col).cast(kind).alias(col)))))
        return F.map_from_entries(F.filter(entries, lambda e: e.isNotNull()))
    return s.agg(F.to_json(F.struct(hour_map("yesterday").alias("yesterday"),
                                    hour_map("today").alias("today"))).alias("body"))
