"""Coupon-abuse alerts over sliding event-time windows.

Rule: within one window, one device has coupon events from at least three
distinct accounts and no item click. The alert document carries the sorted
account and item sets, the device's events of the window in time order, and
its id ``<mid>-<minute of window end>`` (one document per device and minute).

Batch form: ``coupon_alerts`` computes a distinct-account count, an event
count and a click flag per ``(window, device)`` -- all combine map-side, so a
device holding a third of all events is reduced per task before the shuffle.
The alert's members (accounts, items, ordered events) are separate row
outputs restricted to the alerting groups by a semi join; no group is ever
collected into one value. The streaming form (``streaming.jobs``) is one
incremental aggregation holding the sets in state (a stream allows no
distinct count), the document shape of the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.constants import ALERT_INDEX_PREFIX, CLICK, COUPON, MIN_ACCOUNTS  # noqa: F401
from shopflow.functions.time import to_event_time
from shopflow.operators.panes import Panes, in_stretches, running_sums

GROUP = ["window_start", "window_end", "mid"]


def windowed(events: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """STR2: each event once per sliding window that contains it."""
    ev = events.withColumn("event_time", to_event_time(F.col("ts")))
    w = F.window("event_time", size, slide or size)
    return (ev.withColumn("_w", w)
            .withColumn("window_start", F.col("_w.start"))
            .withColumn("window_end", F.col("_w.end"))
            .drop("_w"))


def _coupon(c: str):
    return F.when(F.col("evid") == COUPON, F.col(c))


def _alerting_groups(w: DataFrame, min_accounts: int) -> DataFrame:
    """Per (window, device): distinct coupon accounts, event count and click
    flag -- all partial aggregates -- kept when the alert rule holds."""
    stats = w.groupBy(*GROUP).agg(
        F.count_distinct(_coupon("uid")).alias("n_accounts"),
        F.count(F.lit(1)).alias("n_events"),
        F.max((F.col("evid") == CLICK).cast("int")).alias("clicked"))
    return (stats.filter((F.col("n_accounts") >= min_accounts)
                         & (F.coalesce(F.col("clicked"), F.lit(0)) == 0))
            .drop("clicked"))


def coupon_alerts(events: DataFrame, size: str = "5 minutes",
                  slide: str | None = "1 minute",
                  min_accounts: int = MIN_ACCOUNTS) -> DataFrame:
    """AGG7/FLT2-4: one row per alerting (window, device):
    ``window_start, window_end, mid, n_accounts, n_events, ts`` (``ts`` =
    window end in epoch ms, the deterministic alert time).

    The alert's account set, item set and ordered event list are returned as
    rows by ``alert_accounts``/``alert_items``/``alert_events`` -- never
    collected into one value, so a device holding a third of all events
    stays spread over tasks."""
    return (_alerting_groups(windowed(events, size, slide), min_accounts)
            .withColumn("ts", F.unix_millis(F.col("window_end"))))


def _members(events: DataFrame, alerts: DataFrame, size: str, slide: str | None) -> DataFrame:
    """Events of the alerting groups only (semi join on the group key)."""
    return windowed(events, size, slide).join(alerts.select(*GROUP), GROUP, "left_semi")


def alert_accounts(events: DataFrame, alerts: DataFrame, size: str,
                   slide: str | None = None) -> DataFrame:
    """Distinct coupon accounts of each alert: ``*group, uid`` rows."""
    m = _members(events, alerts, size, slide).filter(F.col("evid") == COUPON)
    return m.select(*GROUP, "uid").distinct()


def alert_items(events: DataFrame, alerts: DataFrame, size: str,
                slide: str | None = None) -> DataFrame:
    """Distinct coupon items of each alert: ``*group, itemid`` rows."""
    m = _members(events, alerts, size, slide).filter(
        (F.col("evid") == COUPON) & F.col("itemid").isNotNull())
    return m.select(*GROUP, "itemid").distinct()


def alert_events(events: DataFrame, alerts: DataFrame, size: str,
                 slide: str | None = None) -> DataFrame:
    """The events of each alert, with ``ts`` and ``event_id`` to order them by:
    ``*group, event_id, evid, ts`` rows (all events: alerting groups have
    no click)."""
    return _members(events, alerts, size, slide).select(*GROUP, "event_id", "evid", "ts")


def pane_cells(events: DataFrame, panes: Panes) -> DataFrame:
    """Per pane, device and coupon account (NULL: all other events) the number
    of events and whether one is an item click: the only pass over the events."""
    return (events.groupBy(panes.pane(F.col("ts")).alias("pane"), "mid", _coupon("uid").alias("account"))
            .agg(F.count(F.lit(1)).alias("n"), F.max((F.col("evid") == CLICK).cast("int")).alias("clicked")))


def coupon_alerts_paned(events: DataFrame, size: str = "5 minutes", slide: str = "5 seconds",
                        min_accounts: int = MIN_ACCOUNTS) -> DataFrame:
    """``coupon_alerts`` for slides far shorter than the window. Events are
    aggregated into panes once. Of the windows that begin in a stretch (one
    window long), those without a click are one run: after the stretch's last
    click, and ending before the next stretch's first one. Only stretches with
    such a run and enough accounts go on; each pane adds its events to the
    windows of the run that hold it, and its account to those that hold none of
    the account's earlier panes, as steps of running sums. So no event and no
    pane is copied per window, and a row is made for alerting windows only."""
    panes = Panes.of(size, slide)
    parts = in_stretches(pane_cells(events, panes), panes)
    pane, begin = F.col("pane"), F.col("stretch") * panes.per_window
    end = begin + panes.per_window
    clicked = F.when(F.col("clicked") == 1, pane)
    hopeful = (parts.groupBy("mid", "stretch").agg(
                   F.count_distinct("account").alias("a"), F.max(F.when(pane < end, clicked)).alias("click"),
                   F.min(F.when(pane >= end, clicked)).alias("next_click"))
               .filter(F.col("a") >= min_accounts)
               .select("mid", "stretch", F.greatest(begin, F.col("click") + 1).alias("low"),
                       F.least(end - 1, F.col("next_click") - panes.per_window).alias("high"))
               .filter(F.col("low") <= F.col("high")))
    first, last = F.greatest(pane - (panes.per_window - 1), "low"), F.least(pane, F.col("high"))
    held = parts.join(hopeful, ["mid", "stretch"]).withColumn("first", first).withColumn("last", last)
    # an account's rows here are as many as two windows have panes
    earlier = F.lag("pane").over(Window.partitionBy("mid", "stretch", "account").orderBy("pane"))
    new = F.greatest("first", earlier + 1)
    counts = F.col("account").isNotNull() & (F.col("new") <= F.col("last"))

    def step(at, n_accounts, n_events):
        return F.struct(at.alias("at"), n_accounts.cast("long").alias("n_accounts"), n_events.alias("n_events"))
    one, none = F.when(counts, 1).otherwise(0), F.lit(0).cast("long")
    steps = (held.filter(F.col("first") <= F.col("last")).withColumn("new", new)
             .select("mid", "stretch", F.explode(F.array(
                 step(F.col("first"), none, F.col("n")),
                 step(F.when(counts, F.col("new")).otherwise(F.col("first")), one, none),
                 step(F.col("last") + 1, -one, -F.col("n")))).alias("s"))
             .select("mid", "stretch", "s.*"))
    kept = (running_sums(steps, ["mid", "stretch"], ["n_accounts", "n_events"])
            .filter((F.col("n_accounts") >= min_accounts) & (F.col("n_events") > 0)))
    return (kept.withColumn("start", F.explode(panes.starts(F.col("at"), F.col("until"))))
            .select(panes.window_start(F.col("start")).alias("window_start"),
                    panes.window_end(F.col("start")).alias("window_end"), "mid", "n_accounts", "n_events")
            .withColumn("ts", F.unix_millis("window_end")))


def paned_members(events: DataFrame, alerts: DataFrame, size: str, slide: str) -> DataFrame:
    """The events of alerts, once per alert. An event meets the alerts that begin
    in its own stretch (one window long) and the one before: it is sent twice,
    an alert once, and at most one in two of the alerts it meets is not its own."""
    panes = Panes.of(size, slide)
    first = F.floor(F.unix_millis("window_start") / panes.length).cast("long")
    begun = alerts.select(*GROUP, first.alias("first"), F.floor(first / panes.per_window).cast("long").alias("stretch"))
    near = in_stretches(events.withColumn("pane", panes.pane(F.col("ts"))), panes)
    # a row becomes as many as a window has slides: tasks are not to be merged by the size of their input
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = near.repartition(tasks, "mid", "stretch")
    within = F.col("pane").between(F.col("first"), F.col("first") + (panes.per_window - 1))
    return near.join(begun, ["mid", "stretch"]).filter(within).drop("pane", "stretch", "first")


def alert_aggregates():
    """Streaming form of AGG7 (one incremental aggregation; a stream allows
    no distinct count and no second pass): the sets and the ordered event
    list as arrays, the document shape of the reference."""
    ordered = F.array_sort(F.collect_list(F.struct("ts", "event_id", "evid")))
    return [
        F.array_sort(F.collect_set(_coupon("uid"))).alias("uids"),
        F.array_sort(F.collect_set(_coupon("itemid"))).alias("itemIds"),
        F.transform(ordered, lambda e: e["evid"]).alias("events"),
    ]


def alert_docs(alerts: DataFrame) -> DataFrame:
    """PRJ7/PRJ8/STR3: document id ``mid-minute`` and daily index name; all
    other columns of ``alerts`` are kept."""
    minute = F.floor(F.col("ts") / 60000).cast("long")
    index = F.concat_ws("-", F.lit(ALERT_INDEX_PREFIX),
                        F.date_format(F.timestamp_millis(F.col("ts")), "yyyy-MM-dd"))
    rest = [c for c in alerts.columns if c not in ("window_start", "window_end")]
    return alerts.select(index.alias("index_name"),
                         F.concat_ws("-", F.col("mid"), minute.cast("string")).alias("doc_id"),
                         *rest)


def events_until_click(events: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """AGG8: per (window, device), the events in time order up to and
    including the first item click (all events when there is none).

    Returned as rows (``*group, event_id, evid, ts``), not as a collected list:
    the first click per group is an aggregate, the cut is a join + filter."""
    w = windowed(events, size, slide)
    first_click = (w.filter(F.col("evid") == CLICK).groupBy(*GROUP)
                   .agg(F.min(F.struct("ts", "event_id")).alias("fc")))
    joined = w.join(first_click, GROUP, "left")
    keep = F.col("fc").isNull() | (F.struct("ts", "event_id") <= F.col("fc"))
    return joined.filter(keep).select(*GROUP, "event_id", "evid", "ts")
