"""What is stored and read back: panes, waiting halves, postings, bitmaps,
keyed buckets, differences, pages, change files."""

import datetime as dt
import gzip
import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopflow import fixtures as fx
from shopflow import schemas
from shopflow.catalog import QUERIES
from shopflow.operators import bitmaps, paging, panes, postings
from shopflow.plans import alert, dau, ingest, search
from shopflow.sources import changes, streams
from shopflow.sources.tables import Tables
from shopflow.streaming import apps, halves, jobs, revenue, sinks
from tests.conftest import SF001
from tests.test_streaming import NOW, ms, write_batches


def rows_of(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


# --- panes ---------------------------------------------------------------------

@pytest.mark.parametrize("size,slide", [("5 minutes", "5 seconds"), ("90 seconds", "60 seconds"), ("1 hour", "1 hour"),
                                        ("7 seconds", "3 seconds")])
def test_panes_equal_windows(spark, size, slide):
    rnd = random.Random(1)
    events = spark.createDataFrame(
        [(i, str(rnd.randint(0, 3)), str(rnd.randint(0, 9)), rnd.choice(["coupon"] * 5 + ["addCart", "clickItem"]), "1",
          ms("2024-01-01 00:00:00") + 250 * rnd.randint(0, 8000)) for i in range(250)],
        "event_id long, mid string, uid string, evid string, itemid string, ts long")
    want = alert.coupon_alerts(events, size, slide)
    got = alert.coupon_alerts_paned(events, size, slide)
    assert rows_of(got, *want.columns) == rows_of(want)
    a = alert.paned_members(events, got, size, slide).select("window_start", "mid", "event_id")
    b = alert.alert_events(events, want, size, slide).select("window_start", "mid", "event_id")
    assert rows_of(a) == rows_of(b)


def test_paned_plan_expands_no_events(spark):
    """The only explode over events' rows comes after their aggregation."""
    plan = alert.coupon_alerts_paned(fx.event_logs(Tables(spark, SF001).events))._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert "Expand" not in text.split("Aggregate")[-1] and "Generate" not in text.split("Aggregate")[-1]


def shuffle_records(df) -> int:
    """Rows written to the exchanges of an executed query."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_panes_are_not_copied_per_window(spark):
    """A pane is sent to its windows as a few steps, not once per window; an
    alert meets its events without being sent once per pane."""
    at = ms("2024-01-01 00:00:00")
    events = spark.createDataFrame(
        [(i, "d", str(i % 7), "coupon" if i % 3 else "addCart", "1", at + 5_000 * i) for i in range(400)]
        + [(400 + i, "c", str(i % 7), "coupon" if i % 2 else "clickItem", "1", at + 5_000 * i) for i in range(400)],
        "event_id long, mid string, uid string, evid string, itemid string, ts long")
    got = alert.coupon_alerts_paned(events, "30 minutes", "5 seconds")
    want = alert.coupon_alerts(events, "30 minutes", "5 seconds")
    assert rows_of(got, *want.columns) == rows_of(want) and got.count() > 360

    def shuffled(df):
        df = df.select("*")
        df.collect()
        return shuffle_records(df)
    assert shuffled(got) < 8 * 1600
    alerts = spark.createDataFrame(got.collect(), got.schema)
    assert shuffled(alert.paned_members(events, alerts, "30 minutes", "5 seconds")) < 2 * 800 + alerts.count() + 1


def test_paned_alert_stream_equals_batch(spark, workdir):
    events = [{"type": "event", "mid": f"m{i % 2}", "uid": f"u{i % 5}", "evid": "clickItem" if i % 37 == 0 else "coupon",
               "itemid": str(i), "ts": ms("2024-01-01 00:00:00") + 7000 * i} for i in range(90)]
    last = {"type": "event", "mid": "late", "uid": "u", "evid": "addCart", "ts": ms("2024-01-02 00:00:00")}
    write_batches(f"{workdir}/in", [events[:40], events[40:], [last], [last | {"ts": last["ts"] + 600_000}]])
    stream = jobs.paned_alert_stream(jobs.event_rows(streams.text_files(spark, f"{workdir}/in", 1)), "1 minute", "5 seconds")
    jobs.start(stream, "panes", sinks.table_sink(f"{workdir}/out"), trigger=NOW, checkpoint=f"{workdir}/ck").awaitTermination()
    got = {(r.window_start, r.mid): (len(r.uids), len(r.events)) for r in spark.read.parquet(f"{workdir}/out").collect()}
    batch = jobs.event_rows(spark.createDataFrame([(json.dumps(e),) for e in events], "value string"))
    want = {(r.window_start, r.mid): (r.n_accounts, r.n_events)
            for r in alert.coupon_alerts(batch, "1 minute", "5 seconds").collect()}
    assert got == want and want


def test_durations():
    assert panes.duration_ms("1 hour 30 minutes") == 5_400_000
    for bad in ("", "5", "five minutes", "5 parsecs"):
        with pytest.raises(ValueError):
            panes.duration_ms(bad)
    with pytest.raises(ValueError):
        panes.Panes.of("5 seconds", "1 minute")


# --- halves --------------------------------------------------------------------

def half(order_id, side, body, second):
    return (order_id, side, body, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second))


@pytest.mark.parametrize("kind", ["state", "outer"])
def test_halves_at_the_bound(spark, workdir, kind):
    """99, 100 and 101 seconds apart, the order first and the line first, over
    several micro-batches and a restart; what meets too late is repaired."""
    data, late = [], []
    for gap in (99, 100, 101):
        data += [(0, half(f"of{gap}", "order", "O", 0)), (gap, half(f"of{gap}", "line", "L", gap)),
                 (0, half(f"lf{gap}", "line", "L", 0)), (gap, half(f"lf{gap}", "order", "O", gap))]
    data += [(5, half("only_o", "order", "O", 5)), (6, half("only_l", "line", "L", 6)), (7, half("both", "order", "O", 7)),
             (8, half("both", "line", "L1", 8)), (9, half("both", "line", "L2", 9))]
    data.sort(key=lambda x: x[0])
    data += [(9999, half(None, "clock", None, 9999))]

    def run():
        raw = streams.parquet_files(spark, f"{workdir}/in", halves.HALF, 1)
        if kind == "state":
            joined = halves.halves_stream(raw, 100, buckets=3)
        else:
            joined = halves.outer_stream(raw.filter("side IN ('order', 'clock')"), raw.filter("side IN ('line', 'clock')"), 100)
        jobs.start(joined, f"h_{kind}", halves.halves_sink(f"{workdir}/out"), trigger=NOW,
                   checkpoint=f"{workdir}/ck").awaitTermination()
    for low, high in ((0, 50), (50, 100), (100, 101), (101, 9999), (9999, 10000)):
        part = [x for at, x in data if low <= at < high]
        spark.createDataFrame(part, halves.HALF).coalesce(1).write.mode("append").parquet(f"{workdir}/in")
        if high in (100, 10000):
            run()
    stored = rows_of(sinks.read_table(spark, f"{workdir}/out"), "order_id", "found", "order_body", "line_body")
    want = [(f"{s}{g}", "pair", "O", "L") for s in ("of", "lf") for g in (99, 100)]
    want += [("both", "pair", "O", "L1"), ("both", "pair", "O", "L2"), ("only_o", "order", "O", None), ("only_l", "line", None, "L")]
    late = [(f"{s}101", found, *bodies) for s in ("of", "lf") for found, *bodies in (("order", "O", None), ("line", None, "L"))]
    assert stored == sorted(want + late, key=str)
    fixed = rows_of(halves.repaired(spark, f"{workdir}/out"), "order_id", "found", "order_body", "line_body")
    assert fixed == sorted(want + [(f"{s}101", "late", "O", "L") for s in ("of", "lf")], key=str)


def test_meet_takes_each_line_once():
    frame = pd.DataFrame([("a", "order", "o1", 0, False), ("a", "order", "o2", 10, False), ("a", "line", "l1", 5, False),
                          ("a", "line", "l2", 500, False), ("b", "line", "l3", 5, False)],
                         columns=["order_id", "side", "body", "ms", "met"])
    pairs, rest = halves.meet(frame, 100)
    assert pairs.values.tolist() == [["a", "pair", "o1", "l1"]]
    alone, kept = halves.expire(rest, 111, 100)
    assert alone[["found", "order_body", "line_body"]].values.tolist() == [["order", "o2", None], ["line", None, "l3"]]
    assert kept["body"].tolist() == ["l2"]
    assert halves._unpacked(halves._packed(rest)).equals(rest.astype({"met": bool}).reset_index(drop=True))


def test_outer_stream_keeps_a_row_of_state_a_bucket(spark, workdir):
    """Every order meets every line of its id within the bound, also over two
    micro-batches; a bucket's halves are one row of state, not rows of their own."""
    first = [half(f"k{i}", side, f"{side}{i}", i) for i in range(40) for side in ("order", "line")]
    first += [half("k0", "order", "again", 3), half("alone", "line", "L", 5), half(None, "line", "lost", 5)]
    second = [half("k1", "line", "more", 39), half("k0", "order", "third", 40), half("k2", "line", "far", 150)]

    def run(rows):
        spark.createDataFrame(rows, halves.HALF).coalesce(1).write.mode("append").parquet(f"{workdir}/in")
        raw = streams.parquet_files(spark, f"{workdir}/in", halves.HALF)
        joined = halves.outer_stream(raw.filter("side IN ('order', 'clock')"), raw.filter("side IN ('line', 'clock')"),
                                     100, buckets=3)
        q = jobs.start(joined, "outer_state", halves.halves_sink(f"{workdir}/out"), trigger=NOW, checkpoint=f"{workdir}/ck")
        q.awaitTermination()
        return q.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert 0 < run(first) <= 3
    run(second)
    run([half(None, "clock", None, 9999)])
    stored = rows_of(sinks.read_table(spark, f"{workdir}/out"), "order_id", "found", "order_body", "line_body")
    want = [(f"k{i}", "pair", f"order{i}", f"line{i}") for i in range(40)]
    want += [("k0", "pair", "again", "line0"), ("k0", "pair", "third", "line0"), ("k1", "pair", "order1", "more"),
             ("k2", "line", None, "far"), ("alone", "line", None, "L"), (None, "line", None, "lost")]
    assert stored == sorted(want, key=str)


def test_repair_shuffles_what_is_stored_once(spark, workdir):
    """Every line and every lone order once; rows without an id stay as they are."""
    rows = [("a", "line", None, "L1"), ("a", "line", None, "L2"), ("a", "order", "O2", None), ("a", "order", "O1", None),
            ("b", "pair", "P", "L3"), ("b", "line", None, "L4"), ("c", "order", "O", None), ("c", "order", "O", None),
            ("d", "line", None, "L5"), (None, "line", None, "L6"), (None, "order", "O6", None)]
    sinks.write_batch(spark.createDataFrame(rows, halves.JOINED), 0, f"{workdir}/out", ["found"])
    fixed = halves.repaired(spark, f"{workdir}/out")
    assert rows_of(fixed) == sorted([
        ("a", "late", "O1", "L1"), ("a", "late", "O1", "L2"), ("b", "pair", "P", "L3"), ("b", "late", "P", "L4"),
        ("c", "order", "O", None), ("c", "order", "O", None), ("d", "line", None, "L5"), (None, "line", None, "L6"),
        (None, "order", "O6", None)], key=str)
    assert fixed._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1


def test_meet_all_is_the_join(monkeypatch):
    """Fresh pairs only, in pieces; a missing id meets nothing."""
    monkeypatch.setattr(halves, "PAIRS", 7)
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", "c", None]), rnd.choice(["order", "line"]), str(i), rnd.randrange(60), False) for i in range(120)]
    for held in (0, 50, 119, 120):
        frame = pd.DataFrame(rows, columns=["order_id", "side", "body", "ms", "met"])
        pieces = list(halves.meet_all(frame, held, 10))
        found = [(r.order_id, r.order_body, r.line_body) for p in pieces for r in p.itertuples()]
        want = [(o[0], o[2], d[2]) for o in rows for d in rows if o[1] == "order" and d[1] == "line" and o[0] == d[0] and o[0]
                and abs(o[3] - d[3]) <= 10 and max(int(o[2]), int(d[2])) >= held]
        assert sorted(found) == sorted(want)
        assert set(frame["body"][frame["met"]]) == {b for w in want for b in w[1:]}
        assert all(len(p) <= 7 + 60 for p in pieces)


def test_a_bucket_holds_tens_of_thousands_of_halves():
    assert halves.buckets_for(0) == halves.buckets_for(3_000_000) == halves.BUCKETS
    for live in (10 ** 7, 270_000_000):
        assert live / halves.buckets_for(live) <= halves.BUCKET_HALVES


# --- inverted index --------------------------------------------------------------

def test_lookup_equals_scan_and_reads_its_buckets(spark, workdir):
    words = ["red", "widget", "Blue", "gear", "très", "漢字", "x-1"]
    rnd = random.Random(2)
    docs = spark.createDataFrame([(f"2024-01-0{rnd.randint(1, 3)}", f"d{i}", " ".join(rnd.sample(words, rnd.randint(0, 4))))
                                  for i in range(200)] + [("2024-01-01", "none", None)], "dt string, id string, name string")
    for i in range(2):
        part = docs.filter(F.pmod(F.xxhash64("id"), F.lit(2)) == i)
        for _ in range(2):   # a retry replaces its own postings
            postings.write_postings(postings.posting_rows(part, "id", "name", "dt"), i, f"{workdir}/p")
    postings.compact(spark, f"{workdir}/p", f"{workdir}/q")
    for keyword in ("red", "RED widget", "blue, gear!", "x 1", "漢", "absent", "red absent", "", " ,"):
        want = rows_of(search.search(docs.withColumn("sku_name", F.col("name")), keyword), "dt", "id")
        for path in ("p", "q"):
            assert rows_of(postings.lookup(spark, f"{workdir}/{path}", keyword), "dt", "doc_id") == want
    one = postings.lookup(spark, f"{workdir}/p", "red widget", "2024-01-02")
    assert {r[0] for r in one.select("dt").distinct().collect()} == {"2024-01-02"}
    folders = {f.split(f"{postings.BUCKET_COL}=")[1].split("/")[0] for f in one.inputFiles()}
    assert len(folders) <= 2 and len(os.listdir(f"{workdir}/p")) > 5


# --- bitmaps ---------------------------------------------------------------------

def test_late_first_record_moves_a_new_device(spark, workdir):
    def batch(*rows):
        return spark.createDataFrame(rows, "mid string, log_date string")
    first = batch(("a", "2024-01-02"), ("b", "2024-01-02"), ("a", "2024-01-03"), (None, "2024-01-02"))
    late = batch(("a", "2024-01-01"), ("c", "2024-01-03"), ("b", "2024-01-02"))
    numbers = bitmaps.number(first, slots=2)
    bits = bitmaps.day_bits(first, numbers)
    assert rows_of(bitmaps.new_per_day(bits)) == [("2024-01-02", 2)]
    more = bitmaps.number(late, numbers, slots=2)
    assert rows_of(more, "mid") == [("c",)]
    both = numbers.unionByName(more)
    assert both.select("slot", "n").distinct().count() == 3
    bits = bits.unionByName(bitmaps.day_bits(late, both))
    assert rows_of(bitmaps.new_per_day(bits)) == [("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 1)]
    assert rows_of(bitmaps.totals(bits)) == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 2)]


def test_bitmaps_beyond_one_part(spark):
    """More devices in a slot than one bitmap holds."""
    rows = spark.range(70_000).select(F.col("id").cast("string").alias("mid"),
                                      F.when(F.col("id") < 40_000, "2024-01-01").otherwise("2024-01-02").alias("log_date"))
    bits = bitmaps.day_bits(rows, bitmaps.number(rows, slots=1))
    assert rows_of(bitmaps.new_per_day(bits)) == [("2024-01-01", 40_000), ("2024-01-02", 30_000)]


# --- keyed buckets -----------------------------------------------------------------

def test_lookup_reads_touched_buckets(spark, workdir):
    def version(v, keys):
        return spark.createDataFrame([(k, v) for k in keys], "id string, version long")
    path = f"{workdir}/t"
    sinks.write_keyed(version(1, [str(i) for i in range(500)]), 0, path, ["id"])
    sinks.compact_keyed(spark, path, ["id"], ["version"])
    sinks.write_keyed(version(2, ["7", "8"]), 1, path, ["id"])
    sinks.write_keyed(version(2, ["7", "8"]), 1, path, ["id"])   # a retry
    only = spark.createDataFrame([("7",), ("9",), ("absent",)], "id string")
    found = sinks.read_keyed(spark, path, ["id"], ["version"], only=only)
    assert rows_of(found, "id", "version") == [("7", 2), ("9", 1)]
    buckets = {f.split(f"{sinks.KEY_BUCKET}=")[1].split("/")[0] for f in found.inputFiles()}
    assert 1 <= len(buckets) <= 3
    assert sinks.read_keyed(spark, path, ["id"], ["version"]).count() == 500
    assert rows_of(sinks.read_keyed(spark, path, ["id"], ["version"], upto=0, only=only), "id", "version") == [("7", 1), ("9", 1)]
    # numbers and their text have one bucket
    both = spark.sql("SELECT 7L AS id").select(sinks.key_bucket(["id"]).alias("b")).first()
    assert both == spark.sql("SELECT '7' AS id").select(sinks.key_bucket(["id"]).alias("b")).first()


# --- revenue by differences ----------------------------------------------------------

def test_revenue_retracts_and_survives_a_retry(spark, workdir):
    sink = revenue.revenue_sink(f"{workdir}/o", f"{workdir}/d")

    def batch(*rows):
        return spark.createDataFrame([(i, d, h, a, v) for i, d, h, a, v in rows],
                                     "id string, create_date string, create_hour string, total_amount double, version long")
    day = "2024-01-01"
    sink(batch(("1", day, "10", 0.1, 1), ("2", day, "10", 0.2, 1), ("1", day, "10", 0.1, 1)), 0)
    sink(batch(("1", day, "11", 5.0, 2), ("3", day, "10", None, 1)), 1)
    sink(batch(("2", "2024-01-02", "00", 7.0, 3), ("1", day, "10", 9.9, 1)), 2)   # an old version comes last
    want = [(day, "10", 0.0), (day, "11", 5.0), ("2024-01-02", "00", 7.0)]
    assert rows_of(revenue.by_hour(sinks.read_table(spark, f"{workdir}/d"))) == want
    sink(batch(("2", "2024-01-02", "00", 7.0, 3), ("1", day, "10", 9.9, 1)), 2)   # batch 2 again
    assert rows_of(revenue.by_hour(sinks.read_table(spark, f"{workdir}/d"))) == want
    assert rows_of(revenue.day_by_hour(spark, f"{workdir}/d", "2024-01-02")) == want[2:]
    assert revenue.day_total(spark, f"{workdir}/d", day).first()[0] == 5.0
    assert revenue.day_total(spark, f"{workdir}/d", "2023-01-01").first()[0] is None


def test_postings_of_a_hot_token_go_to_several_tasks(spark, workdir):
    docs = spark.range(20_000).select(F.lit("2024-01-01").alias("dt"), F.sha2(F.col("id").cast("string"), 256).alias("id"),
                                      F.lit("hot").alias("name"))
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for key in keys:
        spark.conf.set(key, "100k")
    try:
        postings.write_postings(postings.posting_rows(docs.repartition(8), "id", "name", "dt"), 0, f"{workdir}/p")
    finally:
        for key in keys:
            spark.conf.unset(key)
    found = postings.lookup(spark, f"{workdir}/p", "hot")
    assert len(found.inputFiles()) > 1 and found.count() == 20_000


# --- pages -----------------------------------------------------------------------------

def test_pages_read_one_or_two_parts(spark, workdir):
    data = [(f"k{i:04d}", i) for i in range(1000)]
    random.Random(3).shuffle(data)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        paging.build(spark.createDataFrame(data, "k string, v long"), ["k"], f"{workdir}/p", part_rows=100)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    data.sort()
    assert spark.read.parquet(f"{workdir}/p/counts").count() > 5
    for page_no, size in ((1, 10), (2, 10), (37, 10), (100, 10), (101, 10), (3, 333), (1, 5000)):
        got = [tuple(r) for r in paging.page(spark, f"{workdir}/p", ["k"], page_no, size).collect()]
        assert got == data[(page_no - 1) * size:page_no * size]
        if size == 10:
            assert len(paging.parts_of(spark, f"{workdir}/p", page_no, size)) <= 2
    paging.build(spark.createDataFrame([], "k string, v long"), ["k"], f"{workdir}/empty")
    assert paging.page(spark, f"{workdir}/empty", ["k"], 1, 10).collect() == []
    with pytest.raises(ValueError):
        paging.page(spark, f"{workdir}/p", ["k"], 0, 10)


def test_short_parts_make_no_more_files_or_ranges(spark, workdir, monkeypatch):
    """Parts are stretches of a range's file: 100 of them need no 100 folders,
    tasks or samples; ranges are cut by their own number of rows."""
    data = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    paging.build(data, ["k"], f"{workdir}/one", part_rows=10)
    assert len([d for d in os.listdir(f"{workdir}/one/rows") if "=" in d]) == 1
    assert spark.read.parquet(f"{workdir}/one/counts").count() == 100
    monkeypatch.setattr(paging, "RANGE_ROWS", 250)
    paging.build(data, ["k"], f"{workdir}/more", part_rows=10)
    assert len([d for d in os.listdir(f"{workdir}/more/rows") if "=" in d]) == 4
    for path in ("one", "more"):
        for page_no, size in ((1, 7), (2, 20), (50, 20), (3, 300), (51, 20)):
            got = [r.k for r in paging.page(spark, f"{workdir}/{path}", ["k"], page_no, size).collect()]
            assert got == list(range(1000))[(page_no - 1) * size:page_no * size]


# --- change files ------------------------------------------------------------------------

def test_change_files_follow_across_a_restart(spark, workdir):
    def entry(i, database="shop", **more):
        return {"entry_type": "ROWDATA", "database": database, "table": "order_info", "op": "INSERT", "ts": i,
                "rows": [{"after": [{"name": "id", "value": str(i)}, {"name": "n", "value": None}]}]} | more
    files = [[entry(0), entry(1, "other"), "no json", ""], [entry(2), "[1]"], [entry(3, entry_type="TRANSACTIONBEGIN")], [entry(4)]]

    def run(batches, start):
        write_batches(f"{workdir}/in", batches, start)
        feed = changes.change_files(spark, f"{workdir}/in", "shop", fetch=1)
        q = apps.cdc_app(feed, f"{workdir}/out", name="feed", trigger=NOW, checkpoint=f"{workdir}/ck")
        q.awaitTermination()
        return q
    run(files[:2], 0)
    run(files[2:], 2)
    values = [json.loads(r.value)["id"] for r in spark.read.text(f"{workdir}/out").collect()]
    assert sorted(values) == ["0", "2", "4"]


def test_change_files_may_be_compressed(tmp_path):
    with gzip.open(tmp_path / "a.json.gz", "wt") as f:
        f.write("\n".join(json.dumps({"entry_type": "ROWDATA", "database": "d", "rows": []}) for _ in range(250)))
    reader = changes.ChangeReader({"path": str(tmp_path)}, schemas.CHANGE_ENTRY)
    part, = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [b.num_rows for b in reader.read(part)] == [100, 100, 50]


def test_topics_are_stored_compressed(spark, workdir):
    rows = spark.createDataFrame([("t", "a" * 1000)] * 100, "topic string, value string")
    jobs.topic_sink(f"{workdir}/out")(rows, 0)
    files = spark.read.text(f"{workdir}/out").inputFiles()
    assert all(f.endswith(".gz") for f in files)
    got = spark.read.text(f"{workdir}/out").select("topic", "value").collect()
    assert [tuple(r) for r in got] == [("t", "a" * 1000)] * 100


def test_change_fetches_are_bounded(tmp_path):
    (tmp_path / "a.json").write_text("\n".join(json.dumps({"entry_type": "ROWDATA", "database": "d", "rows": []}) for _ in range(250)))
    reader = changes.ChangeReader({"path": str(tmp_path)}, schemas.CHANGE_ENTRY)
    part, = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [b.num_rows for b in reader.read(part)] == [100, 100, 50]
