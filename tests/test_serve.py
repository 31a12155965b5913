"""Request-time queries over stored, day-partitioned tables agree with the
all-days catalog queries for the requested day."""

import os

import pytest
from pyspark.sql import functions as F

from shopflow import fixtures as fx
from shopflow.catalog import KEYWORD, QUERIES, _enriched
from shopflow.plans import dau, gmv, kpi, serve
from shopflow.sources.tables import Tables
from shopflow.streaming import sinks
from tests.conftest import SF01

DAY = "2024-01-07"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("serve"))
    t = Tables(spark, SF01)
    paths = {k: os.path.join(root, k) for k in ("dau", "orders", "sale")}
    sinks.write_batch(dau.dau_dedup(fx.startup_logs(t.events)), 0, paths["dau"], ["log_date"])
    sinks.write_batch(gmv.clean_orders(fx.purchase_orders(t.events)), 0, paths["orders"],
                      ["create_date"])
    sinks.write_batch(fx.as_record_ids(_enriched(spark, SF01)), 0, paths["sale"], ["dt"])
    return paths


def test_realtime_total_for_one_day(spark, stored):
    got = {r.id: r.value for r in serve.realtime_total(spark, stored["dau"], stored["orders"], DAY).collect()}
    t = Tables(spark, SF01)
    want = {r.id: r.value for r in kpi.realtime_total(fx.startup_logs(t.events), fx.purchase_orders(t.events))
            .filter(F.col("dt") == DAY).collect()}
    assert got == want


@pytest.mark.parametrize("card", ["dau", "new_mid", "order_amount"])
def test_realtime_hours_for_one_day(spark, stored, card):
    got = sorted(tuple(r) for r in serve.realtime_hours(spark, card, stored["dau"], stored["orders"], DAY).collect())
    want = sorted(tuple(r) for r in QUERIES["realtime_hours"](spark, SF01)
                  .filter((F.col("id") == card) & (F.col("dt") == DAY))
                  .select("hour", "today", "yesterday").collect())
    assert len(got) == 24 and got == want


def test_unknown_card_is_empty(spark, stored):
    assert serve.realtime_hours(spark, "x", stored["dau"], stored["orders"], DAY).count() == 0


def test_sale_detail_request(spark, stored):
    totals = QUERIES["sale_search_total"](spark, SF01).orderBy(F.desc("total"), "dt").first()
    day = totals.dt
    res = serve.sale_detail(spark, stored["sale"], day, 1, 2, KEYWORD)
    assert res.total.first().total == totals.total
    assert res.detail.count() == min(2, totals.total)
    want = [(r.idx, r.title, r.options) for r in QUERIES["search_stats"](spark, SF01)
            .filter(F.col("dt") == day).orderBy("idx").collect()]
    got = [(r.idx, r.title, r.options) for r in
           res.stat.select("idx", "title", F.to_json("options").alias("options")).collect()]
    assert got == want
    plan = res.total._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_json_bodies(spark, stored):
    import json
    body = json.loads(serve.realtime_total_json(spark, stored["dau"], stored["orders"], DAY).first().body)
    assert [c["id"] for c in body] == ["dau", "new_mid", "order_amount"]
    cards = {r.id: r.value for r in serve.realtime_total(spark, stored["dau"], stored["orders"], DAY).collect()}
    assert {c["id"]: c["value"] for c in body} == cards
    assert [type(c["value"]) for c in body] == [int, int, float]
    empty = json.loads(serve.realtime_total_json(spark, stored["dau"], stored["orders"], "1999-01-01").first().body)
    assert [c["value"] for c in empty] == [0, 0, None]
    hours = json.loads(serve.realtime_hours_json(spark, "dau", stored["dau"], stored["orders"], DAY).first().body)
    rows = serve.realtime_hours(spark, "dau", stored["dau"], stored["orders"], DAY).collect()
    assert hours["today"] == {r.hour: r.today for r in rows if r.today}
    assert hours["yesterday"] == {r.hour: r.yesterday for r in rows if r.yesterday}
    assert all(isinstance(v, int) for v in hours["today"].values())
    assert serve.realtime_hours_json(spark, "x", stored["dau"], stored["orders"], DAY).first().body == "{}"


def test_redelivered_order_counted_once(spark, tmp_path):
    path = str(tmp_path / "orders")
    schema = "id string, total_amount double, create_time string, create_date string, create_hour string"
    o = [("1", 10.0, "2024-01-07 05:00:00", "2024-01-07", "05"),
         ("2", 5.5, "2024-01-07 06:00:00", "2024-01-07", "06")]
    sinks.write_batch(spark.createDataFrame(o, schema), 0, path, ["create_date"])
    sinks.write_batch(spark.createDataFrame(o[:1], schema), 1, path, ["create_date"])  # re-sent
    assert serve.gmv_total(spark, path, "2024-01-07").first().gmv == 15.5
    hours = {r.hour: r.today for r in serve.realtime_hours(spark, "order_amount", path, path, "2024-01-07").collect()}
    assert hours["05"] == 10.0 and hours["06"] == 5.5
    assert serve.gmv_total(spark, path, "2024-01-08").first().gmv is None
    free = [("3", 0.0, "2024-01-08 09:00:00", "2024-01-08", "09")]
    sinks.write_batch(spark.createDataFrame(free, schema), 2, path, ["create_date"])
    import json
    body = json.loads(serve.realtime_hours_json(spark, "order_amount", path, path, "2024-01-08").first().body)
    assert body == {"yesterday": {"05": 10.0, "06": 5.5}, "today": {"09": 0.0}}


def test_versions_of_one_batch_go_by_arrival(spark, tmp_path):
    path = str(tmp_path / "orders")
    schema = "id string, total_amount double, version long, create_date string, create_hour string"
    rows = [("1", 99.0, 1, "2024-01-07", "05"), ("1", 5.0, 2, "2024-01-07", "05")]
    sinks.write_batch(spark.createDataFrame(rows, schema), 0, path, ["create_date"])
    assert serve.gmv_total(spark, path, "2024-01-07").first().gmv == 5.0


def test_search_without_hits(spark, stored):
    day = QUERIES["sale_search_total"](spark, SF01).first().dt
    res = serve.sale_detail(spark, stored["sale"], day, 1, 5, "nosuchword")
    assert res.total.first().total == 0 and res.detail.count() == 0
    stats = [(r.title, [tuple(o) for o in r.options]) for r in res.stat.collect()]
    assert [t for t, _ in stats] == ["age", "gender"]
    assert [v for _, v in stats[0][1]] == [0.0, 0.0, 100.0] and stats[1][1] == []


def test_stored_orders_are_pruned(spark, stored):
    table = sinks.read_table(spark, stored["orders"])
    for fn in (gmv.gmv_total, gmv.gmv_by_hour):
        plan = fn(table, DAY)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(create_date" in plan


def test_first_seen_table_answers_new_devices(spark, stored, tmp_path):
    """Written by its app in several batches, the earliest records last, the
    table gives the answers of all days, from the requested day's folder."""
    from shopflow.sources import streams
    from shopflow.streaming import apps
    raw = fx.raw_log_json(Tables(spark, SF01).events).filter("kind = 'startup'")
    src, out = str(tmp_path / "in"), str(tmp_path / "first")
    day = F.dayofmonth(F.timestamp_millis(F.get_json_object("value", "$.ts").cast("long")))
    for part in (2, 0, 1):
        raw.filter(F.least(F.floor((day - 1) / 10), F.lit(2)) == part).select("value") \
            .coalesce(1).write.mode("append").text(src)
        apps.first_seen_app(streams.text_files(spark, src, 1), out, trigger={"availableNow": True},
                            checkpoint=str(tmp_path / "ck")).awaitTermination()
    want = {r.log_date: r.new_mid for r in QUERIES["new_devices"](spark, SF01).collect()}
    for date in [*want, "2024-01-25"]:
        assert serve.new_devices(spark, stored["dau"], date, out).first()[0] == want.get(date, 0)
        assert serve.new_devices(spark, stored["dau"], date).first()[0] == want.get(date, 0)
    hours = serve.realtime_hours(spark, "new_mid", stored["dau"], stored["orders"], min(want), first_path=out)
    assert sum(r.today for r in hours.collect()) == want[min(want)]
    days = {f.split("create_date=")[1].split("/")[0] for f in
            serve.new_devices(spark, stored["dau"], min(want), out).inputFiles()}
    assert days == {min(want)}


def test_requests_list_their_days_only(spark, stored):
    """Files of other days are in no plan."""
    def days(df):
        return {f.split("=")[1].split("/")[0] for f in df.inputFiles()}
    assert days(serve.dau_total(spark, stored["dau"], DAY)) == {DAY}
    assert days(serve.gmv_total(spark, stored["orders"], DAY)) == {DAY}
    hours = serve.realtime_hours(spark, "dau", stored["dau"], stored["orders"], DAY)
    assert days(hours) == {DAY, "2024-01-06"}
    day = QUERIES["sale_search_total"](spark, SF01).first().dt
    assert days(serve.sale_detail(spark, stored["sale"], day, 1, 5, KEYWORD).detail) == {day}


def test_compacted_days_read_the_same(spark, tmp_path):
    path = str(tmp_path / "t")
    def batch(*keys):
        return spark.createDataFrame([(k, "2024-01-01") for k in keys] + [(k, "2024-01-02") for k in keys], "k string, dt string")
    for i in range(3):
        sinks.write_batch(batch(f"a{i}"), i, path, ["dt"])
    def read(**how):
        return sorted(r.k for r in sinks.read_days(spark, path, "dt", ["2024-01-01"], **how).collect())
    assert sinks.compact_days(spark, path, "dt", ["2024-01-01", "1999-01-01"]) == {"2024-01-01": 2}
    sinks.write_batch(batch("a3"), 3, path, ["dt"])
    for dropped in (3, 0):
        assert read() == ["a0", "a1", "a2", "a3"]
        assert read(before_batch=2) == ["a0", "a1"]
        assert read(after_batch=0) == ["a1", "a2", "a3"] and read(after_batch=2) == ["a3"]
        folders = {f.rsplit("/", 2)[1] for f in sinks.read_days(spark, path, "dt", ["2024-01-01"]).inputFiles()}
        assert folders == {"upto=2", "batch_id=3"}
        assert sinks.drop_compacted(spark, path, "dt", ["2024-01-01"]) == dropped
    sinks.compact_days(spark, path, "dt", ["2024-01-01"])
    assert read() == ["a0", "a1", "a2", "a3"]
