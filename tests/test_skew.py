"""Hot keys: one device / order holding a third of all rows.

Results must stay exact, aggregations must combine map-side, and a skewed
sort-merge join must be split by AQE (thresholds scaled down to test size).
"""

import contextlib

from pyspark.sql import functions as F

from shopflow import fixtures as fx
from shopflow.plans import alert as alert_plan
from shopflow.plans import dau as dau_plan
from shopflow.plans import sale
from shopflow.sources.tables import Tables
from tests.conftest import SF01


@contextlib.contextmanager
def conf(spark, **kv):
    keys = {k.replace("__", "."): v for k, v in kv.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_startup(spark):
    """Start-up logs where every third event belongs to device 'hot'."""
    s = fx.startup_logs(Tables(spark, SF01).events)
    return s.withColumn("mid", F.when(F.col("event_id") % 3 == 0, F.lit("hot"))
                        .otherwise(F.col("mid")))


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_device_dedup_exact_and_partial(spark):
    s = hot_startup(spark)
    got = {(r.mid, r.log_date): (r.ts, r.event_id) for r in dau_plan.dau_dedup(s).collect()}
    rows = dau_plan.with_dates(s).select("mid", "log_date", "ts", "event_id").collect()
    want = {}
    for r in rows:
        k = (r.mid, r.log_date)
        if k not in want or (r.ts, r.event_id) < want[k]:
            want[k] = (r.ts, r.event_id)
    assert got == want
    # partial (map-side) aggregation before the shuffle
    plan = dau_plan.dau_dedup(s)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_hot_device_alerts_match_unskewed_rule(spark):
    ev = fx.event_logs(Tables(spark, SF01).events)
    hot = ev.withColumn("mid", F.when(F.col("event_id") % 3 == 0, F.lit("hot"))
                        .otherwise(F.col("mid")))
    alerts = alert_plan.coupon_alerts(hot, "4 hours", "1 hour")
    acc, evs = {}, {}
    for r in alert_plan.alert_accounts(hot, alerts, "4 hours", "1 hour").collect():
        acc.setdefault((r.mid, r.window_start), []).append(r.uid)
    for r in alert_plan.alert_events(hot, alerts, "4 hours", "1 hour").collect():
        evs.setdefault((r.mid, r.window_start), []).append((r.ts, r.event_id, r.evid))
    got = {(r.mid, r.ts, tuple(sorted(acc[(r.mid, r.window_start)])),
            tuple(e for _, _, e in sorted(evs[(r.mid, r.window_start)])))
           for r in alerts.collect()}
    # brute force over the windows in Python (small fixture)
    rows = hot.select("mid", "uid", "evid", "itemid", "ts", "event_id").collect()
    hour, size = 3600000, 4
    groups = {}
    for r in rows:
        first = (r.ts // hour) * hour
        for k in range(size):
            ws = first - k * hour
            groups.setdefault((ws, r.mid), []).append(r)
    want = set()
    for (ws, mid), evs in groups.items():
        uids = {e.uid for e in evs if e.evid == "coupon"}
        if len(uids) >= 3 and not any(e.evid == "clickItem" for e in evs):
            ordered = [e.evid for e in sorted(evs, key=lambda e: (e.ts, e.event_id))]
            want.add((mid, ws + size * hour, tuple(sorted(uids)), tuple(ordered)))
    assert got == want
    assert any(m == "hot" for m, *_ in want)


def test_hot_order_join_is_split_by_aqe(spark):
    t = Tables(spark, SF01)
    lines = fx.order_lines_named(t.lineitem, t.part).withColumn(
        "order_id", F.when(F.col("id").substr(-1, 1).isin("0", "1", "2"), F.lit("7"))
        .otherwise(F.col("order_id")))
    orders = fx.order_info(t.orders)
    with conf(spark,
              spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
              spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
              spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
              spark__sql__adaptive__coalescePartitions__enabled="false"):
        wide = sale.sale_detail_wide(orders, lines).select("order_detail_id", "order_id")
        n = len(wide.collect())
        plan = plan_text(wide)
    assert n == lines.join(orders.select(F.col("id").alias("order_id")), "order_id").count()
    # the hot order's partition was split across tasks
    assert "SortMergeJoin(skew=true)" in plan
