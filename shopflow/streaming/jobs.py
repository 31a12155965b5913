"""Structured Streaming forms of the pipelines.

Each job takes a streaming DataFrame (Kafka ``value`` strings or a file
stream with the same shape) and returns either a streaming DataFrame or a
``foreachBatch`` function. They reuse the batch functions of ``plans`` so a
micro-batch computes exactly what the batch query computes on the same rows.
Checkpoints go under the session's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow import schemas
from shopflow.functions.json import CORRUPT, dead_letters, decode, good_rows
from shopflow.functions.time import to_event_time
from shopflow.operators.joins import interval_join
from shopflow.plans import alert as alert_plan
from shopflow.plans import dau as dau_plan
from shopflow.plans import ingest as ingest_plan
from shopflow.plans import sale as sale_plan
from shopflow.session import checkpoint_root
from shopflow.sources.streams import publish
from shopflow.streaming import sinks

DAU_LATENESS = "1 day"
REQUIRED = ("mid", "ts")   # a log line without device or time is quarantined
#: the start-up record as stored (the day and hour are derived from ts)
STARTUP_FIELDS = ("mid", "uid", "appid", "area", "os", "ch", "type", "vs", "ts")
USER_TABLE = ("id string, login_name string, user_level string, birthday string, "
              "gender string, version long")


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), "streams", name)


def start(df: DataFrame, name: str, sink: Callable[[DataFrame, int], None],
          mode: str = "append", trigger: dict | None = None,
          checkpoint: str | None = None) -> StreamingQuery:
    """Start a query with a checkpoint (offsets + state survive restarts and
    lost executors). ``trigger`` defaults to the 5 s micro-batch interval. The
    sink gets batch ids that are unique across checkpoints."""
    location = checkpoint or checkpoint_for(df.sparkSession, name)

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(batch, sinks.run_batch(batch.sparkSession, location, batch_id))

    return (df.writeStream.outputMode(mode).queryName(name)
            .option("checkpointLocation", location)
            .trigger(**(trigger or {"processingTime": "5 seconds"}))
            .foreachBatch(run).start())


# --- decoding ----------------------------------------------------------------

def _line_id(value: Column) -> Column:
    """Deterministic tiebreak for rows without an id: hash of the raw line."""
    return F.xxhash64(value)


def startup_rows(raw: DataFrame) -> DataFrame:
    """SRC2 + PRJ1: decoded start-up logs with ``event_time``/``log_date``
    (lines without ``mid`` or ``ts`` go to the dead letters, see
    ``dead_letter_rows``), with all fields of the record."""
    d = good_rows(decode(raw.withColumn("event_id", _line_id(F.col("value"))),
                         schemas.STARTUP_LOG, keep=("event_id",), required=REQUIRED))
    d = d.select("event_id", *STARTUP_FIELDS)
    return dau_plan.with_dates(d).withColumn("event_time", to_event_time(F.col("ts")))


def event_rows(raw: DataFrame) -> DataFrame:
    d = good_rows(decode(raw.withColumn("event_id", _line_id(F.col("value"))),
                         schemas.EVENT_LOG, keep=("event_id",), required=REQUIRED))
    return (d.select("event_id", "mid", "uid", "type", "evid", "itemid", "ts")
            .withColumn("event_time", to_event_time(F.col("ts"))))


def dead_letter_rows(raw: DataFrame, schema, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Raw lines a decoder rejects (malformed, or without a required field),
    as ``value``."""
    return dead_letters(decode(raw, schema, required=required)).withColumnRenamed(CORRUPT, "value")


def observed(df: DataFrame, name: str) -> DataFrame:
    """AGG13: per-batch row count reported in the query progress
    (``observedMetrics[name]``), computed in the same pass -- no extra job."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


# --- DAU ---------------------------------------------------------------------

class SeenDays:
    """The device-days a DAU table holds, kept between micro-batches: a day is
    read once, then only the folders that later batches added to it. What is
    kept is cached on the executors (with spill to disk) and, if one is lost,
    read again from the table."""

    #: days that are kept, and pieces of one before it is read as a whole again
    DAYS, PIECES = 4, 64

    def __init__(self, path: str) -> None:
        self.path, self.days = path, {}

    def _read(self, spark: SparkSession, day: str, before: int, after: int | None) -> DataFrame:
        rows = sinks.read_days(spark, self.path, "log_date", [day], before_batch=before, after_batch=after,
                               empty_schema="mid string, log_date string")
        return rows.select("mid", "log_date", sinks.BATCH_COL).persist()

    def of(self, spark: SparkSession, day: str, before: int) -> DataFrame:
        """Stored ``mid, log_date`` of one day from batches before this one."""
        upto, pieces = self.days.pop(day, (None, []))
        if upto is None or len(pieces) >= self.PIECES or upto >= before:
            for piece in pieces:
                piece.unpersist()
            upto, pieces = None, []
        if upto is None or upto < before - 1:
            pieces.append(self._read(spark, day, before, upto))
        self.days[day] = before - 1, pieces
        while len(self.days) > self.DAYS:
            for piece in self.days.pop(next(iter(self.days)))[1]:
                piece.unpersist()
        out = pieces[0]
        for piece in pieces[1:]:
            out = out.unionByName(piece)
        return out.select("mid", "log_date")


def dau_batch_sink(out_path: str) -> Callable[[DataFrame, int], None]:
    """STR4/STR6/STR7 via the output table: each micro-batch keeps devices not
    yet stored for their own record date (anti join against batches before
    this one, so a retry does not filter itself out), de-duplicates within
    the batch (earliest row) and writes its partition. Input: decoded
    start-up rows (``startup_rows``). Of a day that earlier batches already
    read, only what they added since is read (``SeenDays``)."""
    stored = SeenDays(out_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("event_id", *STARTUP_FIELDS).persist()   # STR8
        try:
            # Only the day partitions this batch touches are listed and read.
            # The day list is bounded by the calendar (a 5 s batch spans one
            # or two days; a backfill at most its date range), so it is safe
            # to bring to the driver as a partition filter.
            days = sorted(r[0] for r in dau_plan.with_dates(rows).select("log_date").distinct().collect())
            seen = spark.createDataFrame([], "mid string, log_date string")
            for day in days:
                seen = seen.unionByName(stored.of(spark, day, batch_id))
            fresh = dau_plan.dau_cross_batch(rows, seen)
            sinks.write_batch(fresh, batch_id, out_path, ["log_date"])
        finally:
            rows.unpersist()
    return run


def dau_state_stream(startup: DataFrame, lateness: str = DAU_LATENESS) -> DataFrame:
    """STR4 in streaming state: earliest row per device and UTC day as an
    event-time aggregation (1-day tumbling window = ``log_date``).

    ``min(struct(ts, ...))`` keeps exactly the batch answer whatever the
    arrival order; the window's state is evicted once the watermark passes
    its end, and rows behind the watermark (of the previous micro-batch, as
    Spark filters late input) are dropped and counted
    (``numRowsDroppedByWatermark``). In append mode a device-day is emitted
    once its day is closed; in update mode each improvement is emitted.
    Readers of the written table take the earliest row per device-day
    (``operators.dedup.first_per_key(t, ["mid", "log_date"], ["ts",
    "event_id"])``), which is right in both modes and absorbs a late row that
    slips into an already emitted day in the one-batch gap."""
    rest = [c for c in STARTUP_FIELDS if c not in ("mid", "ts")]
    picked = (startup.withWatermark("event_time", lateness)
              .groupBy(F.window("event_time", "1 day").alias("day"), "mid")
              .agg(F.min(F.struct("ts", "event_id", *rest, "log_hour")).alias("p")))
    return picked.select(
        "p.event_id", "mid", *[f"p.{c}" for c in rest], "p.ts",
        F.date_format(F.col("day.start"), "yyyy-MM-dd").alias("log_date"), "p.log_hour")


# --- coupon alert ------------------------------------------------------------

def alert_stream(events: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
                 lateness: str = "1 minute",
                 min_accounts: int = alert_plan.MIN_ACCOUNTS) -> DataFrame:
    """STR2/AGG7/FLT3 as one incremental windowed aggregation (streams allow
    no distinct count, so the account set's size is used). State per device and
    window grows with the device's events in the window. Events that arrive
    more than ``lateness`` behind the newest one are left out and counted in
    the progress (``numRowsDroppedByWatermark``); a processing-time window,
    which has no late events, would instead put them into a later window. In append mode an
    alert is emitted once its window is closed by the watermark; in update
    mode as soon as it fires (never retracted, like the reference)."""
    coupon = F.col("evid") == alert_plan.COUPON
    agg = (events.withWatermark("event_time", lateness)
           .groupBy(F.window("event_time", size, slide).alias("w"), "mid")
           .agg(*alert_plan.alert_aggregates(),
                F.max((F.col("evid") == alert_plan.CLICK).cast("int")).alias("clicked"),
                F.size(F.collect_set(F.when(coupon, F.col("uid")))).alias("n_accounts")))
    return (agg.filter((F.col("n_accounts") >= min_accounts) & (F.col("clicked") == 0))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "mid", "uids", "itemIds", "events",
                    F.unix_millis(F.col("w.end")).alias("ts")))


def paned_alert_stream(events: DataFrame, size: str = "5 minutes", slide: str = "5 seconds",
                       lateness: str = "1 minute",
                       min_accounts: int = alert_plan.MIN_ACCOUNTS) -> DataFrame:
    """``alert_stream`` for slides far shorter than the window, in append mode:
    one aggregation turns events into panes (state per device and pane, evicted
    by the watermark), a second one over the panes' own windows merges closed
    panes into sliding windows. An event is copied never, a pane
    ``size / slide`` times."""
    coupon = F.col("evid") == alert_plan.COUPON
    panes = (events.withWatermark("event_time", lateness)
             .groupBy(F.window("event_time", slide).alias("pane"), "mid")
             .agg(F.collect_set(F.when(coupon, F.col("uid"))).alias("uids"),
                  F.collect_set(F.when(coupon, F.col("itemid"))).alias("items"),
                  F.collect_list(F.struct("ts", "event_id", "evid")).alias("members"),
                  F.max((F.col("evid") == alert_plan.CLICK).cast("int")).alias("clicked")))

    def merged(column: str) -> Column:
        return F.flatten(F.collect_list(column))
    windows = (panes.groupBy(F.window("pane", size, slide).alias("w"), "mid")
               .agg(F.array_sort(F.array_distinct(merged("uids"))).alias("uids"),
                    F.array_sort(F.array_distinct(merged("items"))).alias("itemIds"),
                    F.transform(F.array_sort(merged("members")), lambda e: e["evid"]).alias("events"),
                    F.max("clicked").alias("clicked")))
    return (windows.filter((F.size("uids") >= min_accounts) & (F.col("clicked") == 0))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "mid", "uids", "itemIds", "events", F.unix_millis("w.end").alias("ts")))


def alert_sink(out_path: str) -> Callable[[DataFrame, int], None]:
    """SNK2/STR3: alert documents appended per batch; readers take
    ``latest_view(keys=["doc_id"])``."""
    return sinks.table_sink(out_path, ["index_name"],
                            transform=lambda df, _id: alert_plan.alert_docs(df))


# --- sale detail -------------------------------------------------------------

def sale_detail_stream(orders: DataFrame, lines: DataFrame, bound_seconds: int = 100) -> DataFrame:
    """JN4/STR5/STR9: stream-stream join where either half may arrive up to
    ``bound_seconds`` after the other. Inputs carry ``order_time`` and
    ``line_time``; both sides are watermarked by the bound, so join state is
    evicted once a row can no longer match (the TTL of the cached halves)."""
    delay = f"{bound_seconds} seconds"
    o = sale_plan.order_side(orders, ("order_time",)).withWatermark("order_time", delay)
    d = sale_plan.line_side(lines, ("line_time",)).withWatermark("line_time", delay)
    return interval_join(o, d, ["order_id"], "order_time", "line_time", bound_seconds)


def sale_detail_sink(users_path: str, out_path: str,
                     as_of: str | None = None) -> Callable[[DataFrame, int], None]:
    """JN7: per micro-batch, left join the *current* latest user rows (re-read
    each batch so new users are seen), then upsert by line id into the
    day-partitioned table. Ages are as of the batch's date unless ``as_of`` is
    given."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        wide = batch.drop("order_time", "line_time").persist()
        try:
            # versions of this batch's users only (newest compaction + later batches)
            ids = wide.select(F.col("user_id").alias("id")).distinct()
            users = (sinks.read_keyed(spark, users_path, ["id"], ["version"],
                                      empty_schema=USER_TABLE, only=ids)
                     .drop(sinks.BATCH_COL, sinks.KEY_BUCKET, "version"))
            day = F.current_date() if as_of is None else as_of
            sinks.write_batch(sale_plan.enrich(wide, users, day), batch_id, out_path, ["dt"])
        finally:
            wide.unpersist()
    return run


# --- ingest --------------------------------------------------------------------

def dead_path(out_path: str) -> str:
    return out_path.rstrip("/") + "__dead"


def topic_sink(routed_path: str, kafka_servers: str | None = None) -> Callable[[DataFrame, int], None]:
    """SNK6: write ``topic, value`` rows to their topics -- the message itself
    as a text line (gzip) below ``<routed>/topic=<name>``, which ``text_files``
    reads like the topic, or Kafka if servers are given."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if kafka_servers:
            publish(batch, kafka_servers)
        else:
            sinks.write_batch(batch.select("topic", "value"), batch_id, routed_path, ["topic"], fmt="text",
                              compression="gzip")
    return run


def ingest_sink(archive_path: str, routed_path: str, stamp: Column | None = None,
                kafka_servers: str | None = None) -> Callable[[DataFrame, int], None]:
    """PRJ10 + SNK7 + FLT7/SNK6: stamp every raw line with server time, archive
    it by day (text), and write it to its topic. A line that is no JSON object
    is kept as it came, below ``<archive>__dead``.

    The stamp defaults to the message's broker ``arrival`` time, which a
    replayed batch reproduces exactly (same offsets, same timestamps), so a
    retry rewrites the same ``dt``/``batch_id`` partitions. Only sources
    without an arrival time fall back to the batch's current time."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if stamp is not None:
            ms = stamp
        elif "arrival" in batch.columns:
            ms = F.unix_millis(F.col("arrival"))
        else:
            ms = F.unix_millis(F.current_timestamp())
        base = batch.withColumn("raw", F.col("value"))
        day = F.date_format(F.timestamp_millis(ms.cast("long")), "yyyy-MM-dd")
        stamped = ingest_plan.stamp_logs(base, ms).withColumn("dt", day).select("value", "raw", "dt").persist()
        try:
            good, bad = stamped.filter(F.col("value").isNotNull()), stamped.filter(F.col("value").isNull())
            sinks.write_batch(good.select("value", "dt"), batch_id, archive_path, ["dt"], fmt="text")
            sinks.write_batch(bad.select(F.coalesce("raw", F.lit("")).alias("value"), "dt"), batch_id,
                              dead_path(archive_path), ["dt"], fmt="text")
            topic_sink(routed_path, kafka_servers)(ingest_plan.route_logs(good), batch_id)
        finally:
            stamped.unpersist()
    return run


def cdc_stream(entries: DataFrame, database: str | None = None) -> DataFrame:
    """SRC3/FLT5/FLT6/PRJ9 on a stream of change entries -> routed rows."""
    return ingest_plan.route_changes(ingest_plan.flatten_changes(entries, database))
