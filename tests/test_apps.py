"""End to end: change feed -> routed topics -> GMV, user and sale-detail apps,
each compared with the batch answer on the same rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from shopflow import fixtures as fx
from shopflow import schemas
from shopflow.catalog import QUERIES
from shopflow.plans import gmv
from shopflow.sources import streams
from shopflow.sources.tables import Tables
from shopflow.streaming import apps, jobs, sinks
from tests.conftest import SF001
from tests.test_streaming import NOW, write_batches


def _topic_files(routed, topic, folder, parts=3):
    values = [r.value for r in routed.filter(F.col("topic") == topic).orderBy("key", "value").collect()]
    step = (len(values) + parts - 1) // parts
    write_batches(folder, [values[i:i + step] for i in range(0, len(values), step)])
    return values


def test_change_feed_to_gmv_users_and_sale_detail(spark, workdir):
    routed = QUERIES["cdc_route"](spark, SF001)
    d = {k: os.path.join(workdir, k) for k in ("o", "l", "u", "gmv", "users", "sale", "ck")}
    orders_json = _topic_files(routed, "TOPIC_ORDER_INFO", d["o"])
    lines_json = _topic_files(routed, "TOPIC_ORDER_DETAIL", d["l"])
    _topic_files(routed, "TOPIC_USER_INFO", d["u"])

    # GMV app: cleaned orders table, then the GMV query over it
    apps.gmv_app(streams.text_files(spark, d["o"], 1), d["gmv"], trigger=NOW,
                 checkpoint=d["ck"] + "/gmv").awaitTermination()
    table = sinks.read_table(spark, d["gmv"])
    got = {r.create_date: r.gmv for r in gmv.gmv_total(table.drop("create_date", "create_hour")).collect()}
    ids = {json.loads(v)["id"] for v in orders_json}
    src = fx.order_info(Tables(spark, SF001).orders).filter(F.col("id").isin(list(ids)))
    want = {r.create_date: r.gmv for r in gmv.gmv_total(src).collect()}
    assert got == want and len(want) > 0
    masked = table.select("consignee_tel").first()[0]
    assert masked.endswith("********") and len(masked) == 12

    # user app, then the sale-detail app joining both topics and the users
    apps.user_app(streams.text_files(spark, d["u"], 1), d["users"], trigger=NOW,
                  checkpoint=d["ck"] + "/users").awaitTermination()
    q = apps.sale_detail_app(streams.text_files(spark, d["o"], 1), streams.text_files(spark, d["l"], 1),
                             d["users"], d["sale"], "2024-01-01", trigger=NOW,
                             checkpoint=d["ck"] + "/sale")
    q.awaitTermination()
    got = sorted(r.order_detail_id for r in spark.read.parquet(d["sale"]).collect())
    # with multiplicity: at sf0.001 one line id occurs twice in lineitem
    lines = [json.loads(v) for v in lines_json]
    want = sorted(x["id"] for x in lines if x["order_id"] in ids)
    assert got == want and len(want) > 0
    rows = spark.read.parquet(d["sale"]).collect()
    assert all(r.user_age is not None for r in rows)
    assert {r.user_level for r in rows} <= {"AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD",
                                            "MACHINERY", None}


def test_command_line_dau_app(spark, workdir):
    src = os.path.join(workdir, "in")
    write_batches(src, [[{"type": "startup", "mid": "a", "uid": "1", "ts": 1704067200000}],
                        [{"type": "startup", "mid": "a", "uid": "1", "ts": 1704067300000}]])
    out = os.path.join(workdir, "dau")
    apps.main(["dau", "--input", src, "--out", out, "--max-files", "1", "--available-now"])
    rows = spark.read.parquet(out).collect()
    assert [(r.mid, r.log_date) for r in rows] == [("a", "2024-01-01")]


def _lines(folder, lines):
    os.makedirs(folder)
    with open(os.path.join(folder, "part.txt"), "w") as f:
        f.write("\n".join(lines))


def test_ingest_feeds_dau_and_loses_no_line(spark, workdir):
    """Router output is the next app's input; rejected lines are kept as they
    came; nested and repeated keys survive with their types."""
    d = {k: os.path.join(workdir, k) for k in ("in", "arch", "routed", "dau", "dead")}
    good = ['{"type":"startup","mid":"a","uid":"1","os":"x","vs":"1.2","appid":"s","area":"b","ch":"c","ts":5}',
            '{"type":"startup","mid":"b","mid":"c","uid":"2"}',
            '{"type":"event","mid":"a","evid":"coupon","itemid":3,"more":{"k":[1,true,null]}}',
            '{"type":"startup","uid":"no device"}']
    bad = ['{"type":"startup","mid":', "[1,2]", "plain text"]
    _lines(d["in"], good + bad)
    apps.ingest_app(streams.text_files(spark, d["in"]), d["arch"], d["routed"], trigger=NOW,
                    checkpoint=workdir + "/ck1").awaitTermination()
    archived = [json.loads(r.value) for r in spark.read.text(d["arch"]).collect()]
    assert len(archived) == 4 and all(isinstance(a["ts"], int) and a["ts"] > 5 for a in archived)
    assert {"k": [1, True, None]} in [a.get("more") for a in archived]
    assert sorted(r.value for r in spark.read.text(jobs.dead_path(d["arch"])).collect()) == sorted(bad)
    topic = streams.text_files(spark, apps.topic_folder(d["routed"], "GMALL_STARTUP"))
    apps.dau_app(topic, d["dau"], trigger=NOW, checkpoint=workdir + "/ck2").awaitTermination()
    rows = {r.mid: r for r in spark.read.parquet(d["dau"]).collect()}
    assert set(rows) == {"a", "c"}
    stored = rows["a"].asDict()
    assert {k: stored[k] for k in ("appid", "area", "os", "ch", "vs")} == \
        {"appid": "s", "area": "b", "os": "x", "ch": "c", "vs": "1.2"}
    assert set(schemas.STARTUP_LOG.names) - {"logDate", "logHour"} <= set(stored)
    apps.dead_letters_app(topic, "dau", d["dead"], trigger=NOW, checkpoint=workdir + "/ck3").awaitTermination()
    assert [json.loads(r.value)["uid"] for r in spark.read.text(d["dead"]).collect()] == ["no device"]


def test_command_line_change_feed_to_gmv_and_sale_detail(spark, workdir):
    """cdc -> gmv / users / sale detail through the apps' own folders."""
    def entry(table, op, rows, database="shop", kind="ROWDATA"):
        return json.dumps({"entry_type": kind, "database": database, "table": table, "op": op, "rows": [
            {"after": [{"name": k, "value": v} for k, v in r.items()]} for r in rows]})
    order = {n: f"{n}!" for n in schemas.ORDER_INFO.names if n not in ("create_date", "create_hour")}
    order |= {"id": "1", "user_id": "7", "total_amount": "10.5", "create_time": "2024-01-01 05:00:00"}
    lines = [{"id": f"l{i}", "order_id": "1", "sku_id": "s", "sku_name": "red pen", "order_price": "2"} for i in (1, 2)]
    feed = [entry("order_info", "INSERT", [order]), entry("order_detail", "INSERT", lines),
            entry("order_info", "INSERT", [order | {"id": "2", "create_time": None}]),
            entry("order_info", "INSERT", [order | {"id": "3"}], database="other"),
            entry("user_info", "INSERT", [{"id": "7", "birthday": "2000-01-01", "gender": "F", "user_level": "1"}]),
            entry("user_info", "UPDATE", [{"id": "7", "birthday": "2000-01-01", "gender": "F", "user_level": "2"}]),
            entry("order_info", "DELETE", [order]), entry("x", "INSERT", [order], kind="TRANSACTIONEND"), "broken"]
    d = {k: os.path.join(workdir, k) for k in ("in", "routed", "gmv", "users", "sale")}
    _lines(d["in"], feed)

    def run(app, source, out, *more):
        apps.main([app, "--input", source, "--out", out, "--available-now", "--name", f"t_{app}",
                   "--checkpoint", os.path.join(workdir, f"ck_{app}"), *more])
    run("cdc", d["in"], d["routed"], "--database", "shop")
    assert [r.value for r in spark.read.text(jobs.dead_path(d["routed"])).collect()] == ["broken"]
    topic = {t: apps.topic_folder(d["routed"], f"TOPIC_{t}") for t in ("ORDER_INFO", "ORDER_DETAIL", "USER_INFO")}
    run("gmv", topic["ORDER_INFO"], d["gmv"])
    stored = sinks.read_table(spark, d["gmv"]).collect()
    assert [(r.id, r.total_amount, r.create_date) for r in stored] == [("1", 10.5, "2024-01-01")]
    assert set(schemas.ORDER_INFO.names) <= set(stored[0].asDict())
    assert stored[0].trade_body == "trade_body!" and stored[0].delivery_address == "delivery_address!"
    rejected = spark.read.text(jobs.dead_path(d["gmv"])).collect()
    assert [json.loads(r.value)["id"] for r in rejected] == ["2"]
    run("users", topic["USER_INFO"], d["users"])
    run("sale_detail", topic["ORDER_INFO"], d["sale"], "--detail-input", topic["ORDER_DETAIL"], "--users", d["users"])
    sale = spark.read.parquet(d["sale"]).withColumn(
        "age_now", F.floor(F.datediff(F.current_date(), F.lit("2000-01-01").cast("date")) / 365)).collect()
    assert sorted((r.order_detail_id, r.user_gender) for r in sale) == [("l1", "F"), ("l2", "F")]
    assert all(r.user_age == r.age_now for r in sale)


def test_command_line_refuses_missing_options(spark):
    for argv in (["sale_detail", "--input", "a", "--out", "b"], ["ingest", "--input", "a", "--out", "b"],
                 ["cdc", "--input", "a", "--out", "b", "--publish"]):
        with pytest.raises(SystemExit):
            apps.main(argv)


def test_sale_detail_keeps_rejects_of_both_topics(spark, workdir):
    d = {k: os.path.join(workdir, k) for k in ("o", "l", "u", "out", "ck")}
    write_batches(d["o"], [[{"id": "1", "create_time": "2024-01-01 00:00:00", "user_id": "9"}, '{"id": "bad order',
                            {"id": "no time"}]])
    write_batches(d["l"], [[{"id": "1-1", "order_id": "1"}, "bad line", {"id": "no order"}]])
    apps.main(["sale_detail", "--input", d["o"], "--detail-input", d["l"], "--users", d["u"], "--out", d["out"],
               "--checkpoint", d["ck"], "--name", "sd_rejects", "--as-of", "2024-01-01", "--available-now"])
    dead = {k: sorted(r.value for r in spark.read.text(f"{d['out']}__dead{k}").collect()) for k in ("", "_orders")}
    assert dead[""] == ["bad line", '{"id": "no order"}']
    assert dead["_orders"] == ['{"id": "bad order', '{"id": "no time"}']


def test_dau_sink_reads_a_day_once(spark, workdir, monkeypatch):
    """Later batches read only what was added to the day since."""
    asked = []
    own = sinks.read_days
    monkeypatch.setattr(sinks, "read_days", lambda *a, **k: asked.append(k.get("after_batch")) or own(*a, **k))
    batches = [[{"type": "startup", "mid": f"m{i % 3}", "uid": "1", "ts": 1704067200000 + i}] for i in range(5)]
    write_batches(os.path.join(workdir, "in"), batches)
    apps.dau_app(streams.text_files(spark, os.path.join(workdir, "in"), 1), os.path.join(workdir, "out"), name="dau_once",
                 trigger=NOW, checkpoint=os.path.join(workdir, "ck")).awaitTermination()
    assert sorted(r.mid for r in spark.read.parquet(os.path.join(workdir, "out")).collect()) == ["m0", "m1", "m2"]
    assert asked[0] is None and None not in asked[1:] and len(asked) == 5
