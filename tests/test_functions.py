"""Unit and property tests of the column functions and generic operators."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopflow.functions import json as fj
from shopflow.functions.numeric import (BAND_20_TO_30, BAND_30_PLUS, BAND_UNDER_20,
                                        age_band, age_years, remainder_pct, share_pct)
from shopflow.functions.text import mask_phone, matches_all_terms, tokens
from shopflow.functions.time import create_date, create_hour, log_date, log_hour, previous_day
from shopflow.operators.dedup import first_per_key, latest_per_key
from shopflow.operators.joins import full_outer_unique, hour_spine, today_vs_yesterday
from shopflow.operators.topk import page, top_terms
from shopflow import schemas


def one(spark, col, data=None, schema="x string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return [r[0] for r in df.select(col).collect()]


def test_log_date_hour_is_24h_utc(spark):
    # 2024-01-01 13:05:00 UTC: 24-hour clock, never the 12-hour "01"
    ms = 1704114300000
    df = spark.createDataFrame([(ms,)], "ts long")
    r = df.select(log_date(F.col("ts")).alias("d"), log_hour(F.col("ts")).alias("h")).first()
    assert (r.d, r.h) == ("2024-01-01", "13")


def test_create_date_hour_null_safe(spark):
    rows = spark.createDataFrame([("2020-08-18 07:31:02",), ("garbage",), (None,)], "t string")
    out = rows.select(create_date(F.col("t")).alias("d"), create_hour(F.col("t")).alias("h")).collect()
    assert (out[0].d, out[0].h) == ("2020-08-18", "07")
    assert out[1].h is None and out[2].d is None


def test_previous_day(spark):
    assert one(spark, previous_day(F.col("x")), [("2024-03-01",)]) == ["2024-02-29"]


def test_mask_phone(spark):
    got = one(spark, mask_phone(F.col("x")), [("13812345678",), ("139",), (None,)])
    assert got == ["1381********", "139********", None]


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="0123456789", min_size=0, max_size=15))
def test_mask_never_reveals_after_fourth(spark, tel):
    got = one(spark, mask_phone(F.col("x")), [(tel,)])[0]
    assert got == tel[:4] + "*" * 8


def test_keyword_match_all_terms(spark):
    data = [("Red Widget",), ("red plate",), ("widget, red!",), (None,)]
    got = one(spark, matches_all_terms(F.col("x"), "red widget"), data)
    assert got == [True, False, True, None]
    # an empty keyword matches nothing
    assert one(spark, matches_all_terms(F.col("x"), "  "), data)[:3] == [False, False, False]
    assert one(spark, tokens(F.col("x")), [("Hello,  World 42",)]) == [["hello", "world", "42"]]


def test_age_years_truncates(spark):
    df = spark.createDataFrame([("2000-01-01",), ("2004-01-02",), ("bad",), ("2030-01-01",)], "b string")
    got = [r[0] for r in df.select(age_years(F.col("b"), "2024-01-01")).collect()]
    # 8766 days -> 24; 7304 days -> 20 (365-day years); unparsable -> NULL;
    # future birthday truncates toward zero
    assert got == [24, 20, None, -6]   # -2192 days -> -6.005 -> -6


def test_share_and_bands(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 3)], "n long, t long")
    got = [r[0] for r in df.select(share_pct(F.col("n"), F.col("t"))).collect()]
    assert got == [33.3, 0.0, 66.7]
    r = spark.range(1).select(remainder_pct(F.lit(33.3), F.lit(33.3)).alias("r")).first().r
    assert r == 33.4
    bands = one(spark, age_band(F.col("x")), [(19,), (20,), (29,), (30,)], "x int")
    assert bands == [BAND_UNDER_20, BAND_20_TO_30, BAND_20_TO_30, BAND_30_PLUS]


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 500), st.integers(0, 500), st.integers(0, 500))
def test_band_shares_sum_to_100(spark, a, b, c):
    total = a + b + c
    df = spark.createDataFrame([(a, b, total)], "a long, b long, t long")
    r = df.select(share_pct(F.col("a"), F.col("t")).alias("x"),
                  share_pct(F.col("b"), F.col("t")).alias("y")).first()
    rest = spark.range(1).select(remainder_pct(F.lit(r.x), F.lit(r.y))).first()[0]
    assert abs(r.x + r.y + rest - 100.0) < 1e-9


def test_decode_dead_letters(spark):
    raw = spark.createDataFrame(
        [('{"mid":"1","uid":"7","ts":5,"itemid":42}',), ('{"mid":"2","ts":',)], "value string")
    d = fj.decode(raw, schemas.EVENT_LOG)
    good = fj.good_rows(d).collect()
    bad = fj.dead_letters(d).collect()
    assert len(good) == 1 and good[0].itemid == "42" and good[0].ts == 5
    assert len(bad) == 1 and bad[0][0].startswith('{"mid":"2"')


def test_stamp_and_route(spark):
    raw = spark.createDataFrame([('{"type":"startup","mid":"m","ts":1}',),
                                 ('{"type":"event","evid":"coupon"}',), ('{}',)], "value string")
    out = raw.select(fj.stamp_ts(F.col("value"), F.lit(99)).alias("v"),
                     fj.log_topic(F.col("value")).alias("t")).collect()
    assert json.loads(out[0].v) == {"type": "startup", "mid": "m", "ts": 99}
    assert json.loads(out[1].v)["ts"] == 99
    assert [r.t for r in out] == [fj.TOPIC_STARTUP, fj.TOPIC_EVENT, fj.TOPIC_EVENT]


def test_change_topic_rules(spark):
    rows = [("order_info", "INSERT"), ("order_info", "UPDATE"), ("order_detail", "INSERT"),
            ("user_info", "UPDATE"), ("user_info", "DELETE"), ("other", "INSERT")]
    df = spark.createDataFrame(rows, "t string, op string")
    got = [r[0] for r in df.select(fj.change_topic(F.col("t"), F.col("op"))).collect()]
    assert got == [fj.TOPIC_ORDER_INFO, None, fj.TOPIC_ORDER_DETAIL, fj.TOPIC_USER_INFO, None, None]


def test_first_and_latest_per_key(spark):
    df = spark.createDataFrame([("a", 30, 1, "x"), ("a", 10, 2, "y"), ("a", 20, 3, "z"),
                                ("b", 5, 4, "w"), ("b", 5, 1, "v")],
                               "k string, ts int, id int, p string")
    first = {r.k: r.p for r in first_per_key(df, ["k"], ["ts", "id"]).collect()}
    last = {r.k: r.p for r in latest_per_key(df, ["k"], ["ts", "id"]).collect()}
    assert first == {"a": "y", "b": "v"} and last == {"a": "x", "b": "w"}
    assert first_per_key(df, ["k"], ["ts", "id"]).columns == df.columns


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 50)), min_size=1, max_size=30))
def test_dedup_idempotent_and_order_invariant(spark, rows):
    data = [(k, ts, i) for i, (k, ts) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, ts int, id int")
    once = first_per_key(df, ["k"], ["ts", "id"])
    twice = first_per_key(once, ["k"], ["ts", "id"])
    shuffled = first_per_key(spark.createDataFrame(list(reversed(data)), df.schema), ["k"], ["ts", "id"])
    a, b, c = (sorted(x.collect()) for x in (once, twice, shuffled))
    assert a == b == c
    expect = {}
    for k, ts, i in data:
        if k not in expect or (ts, i) < expect[k]:
            expect[k] = (ts, i)
    assert {r.k: (r.ts, r.id) for r in a} == expect


def test_full_outer_unique(spark):
    one_ = spark.createDataFrame([(1, "o1"), (2, "o2")], "k int, o string")
    many = spark.createDataFrame([(1, "l1"), (1, "l2"), (3, "l3")], "k int, l string")
    got = sorted((r.k, r.o, r.l) for r in full_outer_unique(one_, many, ["k"]).collect())
    assert got == [(1, "o1", "l1"), (1, "o1", "l2"), (2, "o2", None), (3, None, "l3")]


def test_spine_and_today_vs_yesterday(spark):
    s = spark.createDataFrame([("2024-01-02", "05", 3), ("2024-01-01", "05", 2),
                               ("2024-01-01", "23", 1)], "d string, h string, v long")
    assert hour_spine(s.withColumnRenamed("d", "dt")).count() == 48
    rows = {(r.dt, r.hour): (r.today, r.yesterday)
            for r in today_vs_yesterday(s, "d", "h", "v").collect()}
    assert rows[("2024-01-02", "05")] == (3, 2)
    assert rows[("2024-01-02", "23")] == (0, 1)
    assert rows[("2024-01-01", "00")] == (0, 0)


def test_top_terms_and_page(spark):
    df = spark.createDataFrame([("d", a) for a in [20, 20, 30, 30, 40, None]], "dt string, age int")
    top = top_terms(df, "age", 2, ["dt"]).orderBy("rank").collect()
    assert [(r.age, r.doc_count) for r in top] == [(20, 2), (30, 2)]
    p = page(spark.range(25), ["id"], 3, 10).collect()
    assert [r.id for r in p] == [20, 21, 22, 23, 24]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(1, 999), min_size=1, max_size=4, unique=True), st.booleans())
def test_dau_cross_batch_split_invariance(spark, cuts, ts_ordered):
    """Any split of the start-up log into micro-batches yields the same
    device-days; a time-ordered split yields exactly the batch rows."""
    from shopflow import fixtures as fx
    from shopflow.plans import dau
    from shopflow.sources.tables import Tables
    from tests.conftest import SF001
    s = fx.startup_logs(Tables(spark, SF001).events)
    order = F.col("ts") if ts_ordered else F.col("uid")
    from pyspark.sql import Window
    # test-only numbering of a 1,000-row fixture to cut it into batches
    ranked = s.withColumn("_pos", F.row_number().over(Window.orderBy(order, "event_id")))
    bounds = [0] + sorted(cuts) + [10 ** 9]
    seen = spark.createDataFrame([], "mid string, log_date string")
    parts = []
    for lo, hi in zip(bounds, bounds[1:]):
        batch = ranked.filter((F.col("_pos") > lo) & (F.col("_pos") <= hi)).drop("_pos")
        fresh = dau.dau_cross_batch(batch, seen)
        rows = fresh.collect()
        parts.extend(rows)
        if rows:
            seen = seen.unionByName(spark.createDataFrame(
                [(r.mid, r.log_date) for r in rows], "mid string, log_date string"))
    whole = {(r.mid, r.log_date): (r.ts, r.event_id) for r in dau.dau_dedup(s).collect()}
    got = {(r.mid, r.log_date): (r.ts, r.event_id) for r in parts}
    assert len(parts) == len(got)            # no device-day counted twice
    assert set(got) == set(whole)
    if ts_ordered:
        assert got == whole


def test_realtime_hours_unknown_id_is_empty(spark):
    from shopflow import fixtures as fx
    from shopflow.plans import kpi
    from shopflow.sources.tables import Tables
    from tests.conftest import SF001
    t = Tables(spark, SF001)
    known = kpi.realtime_hours(fx.startup_logs(t.events), fx.purchase_orders(t.events), "dau")
    unknown = kpi.realtime_hours(fx.startup_logs(t.events), fx.purchase_orders(t.events), "nope")
    assert unknown.count() == 0 and unknown.schema == known.schema


def test_decode_quarantines_missing_required_fields(spark):
    raw = spark.createDataFrame([('{"mid":"1","ts":5}',), ('{"mid":"2"}',), ('{"ts":7}',)],
                                "value string")
    d = fj.decode(raw, schemas.STARTUP_LOG, required=("mid", "ts"))
    assert [r.mid for r in fj.good_rows(d).collect()] == ["1"]
    assert sorted(r[0] for r in fj.dead_letters(d).collect()) == ['{"mid":"2"}', '{"ts":7}']


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 400)), min_size=1, max_size=12),
       st.lists(st.tuples(st.integers(0, 4), st.integers(0, 400)), min_size=1, max_size=12),
       st.integers(0, 150))
def test_interval_join_matches_brute_force(spark, orders, lines, bound):
    from shopflow.operators.joins import interval_join
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    o = spark.createDataFrame([(k, i, t0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(orders)],
                              "k int, oid int, ot timestamp")
    d = spark.createDataFrame([(k, i, t0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(lines)],
                              "k int, lid int, lt timestamp")
    got = sorted((r.oid, r.lid) for r in interval_join(o, d, ["k"], "ot", "lt", bound).collect())
    want = sorted((i, j) for i, (ko, so) in enumerate(orders) for j, (kl, sl) in enumerate(lines)
                  if ko == kl and abs(sl - so) <= bound)
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.sets(st.integers(0, 6), max_size=5), st.lists(st.integers(0, 6), max_size=12))
def test_full_outer_unique_matches_native(spark, one_keys, many_keys):
    one_ = spark.createDataFrame([(k, f"o{k}") for k in sorted(one_keys)], "k int, o string")
    many = spark.createDataFrame([(k, f"l{i}") for i, k in enumerate(many_keys)], "k int, l string")
    mine = sorted((r.k, r.o, r.l) for r in full_outer_unique(one_, many, ["k"]).collect())
    native = sorted((r.k, r.o, r.l) for r in one_.join(many, "k", "full_outer").collect())
    assert mine == native


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.tuples(st.sampled_from(["2024-01-01", "2024-01-02", "2024-01-04"]),
                                 st.integers(0, 23)), st.integers(1, 50), max_size=15))
def test_today_vs_yesterday_matches_brute_force(spark, series):
    import datetime as dt
    rows = [(d, f"{h:02d}", v) for (d, h), v in series.items()]
    df = spark.createDataFrame(rows or [("2024-01-01", "00", 0)], "d string, h string, v long")
    if not rows:
        df = df.limit(0)
    got = {(r.dt, r.hour): (r.today, r.yesterday) for r in today_vs_yesterday(df, "d", "h", "v").collect()}
    days = {d for d, _, _ in rows}
    want = {}
    for d in days:
        prev = (dt.date.fromisoformat(d) - dt.timedelta(days=1)).isoformat()
        for h in range(24):
            hh = f"{h:02d}"
            want[(d, hh)] = (series.get((d, h), 0), series.get((prev, h), 0))
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 6)), max_size=40), st.integers(1, 4))
def test_top_terms_matches_brute_force(spark, rows, n):
    df = spark.createDataFrame(rows or [("a", 0)], "g string, t int")
    if not rows:
        df = df.limit(0)
    got = sorted((r.g, r.t, r.doc_count) for r in top_terms(df, "t", n, ["g"]).collect())
    want = []
    for g in {g for g, _ in rows}:
        counts = {}
        for gg, t in rows:
            if gg == g:
                counts[t] = counts.get(t, 0) + 1
        ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
        want += [(g, t, c) for t, c in ranked]
    assert got == sorted(want)


def test_ideographs_are_tokens(spark):
    from shopflow.functions.text import matches_all_terms
    df = spark.createDataFrame([("红色手机 Pro",), ("蓝色电话",)], "name string")
    hit = [r[0] for r in df.select(matches_all_terms(F.col("name"), "手机 pro")).collect()]
    assert hit == [True, False]
