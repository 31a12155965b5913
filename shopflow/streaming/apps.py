"""Runnable streaming apps: source -> decode -> job -> idempotent sink.

Each ``*_app`` starts one checkpointed query and returns it. Sources are
streaming DataFrames with a ``value`` JSON column (``sources.streams``:
Kafka topic or file stream). Change-feed topics carry every column as a JSON
string (the after-image of ``plans.ingest.flatten_changes``), so numbers are
decoded as strings and cast null-safely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shopflow import schemas
from shopflow.functions.json import decode, good_rows
from shopflow.plans import gmv as gmv_plan
from shopflow.streaming import jobs, revenue, sinks


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# wire schemas of the change-feed topics (every value is a JSON string)
ORDER_WIRE = _strings(*[n for n in schemas.ORDER_INFO.names if n not in ("create_date", "create_hour")])
DETAIL_WIRE = _strings(*schemas.ORDER_DETAIL.names)
USER_WIRE = _strings(*schemas.USER_INFO.names)
# fields without which a message goes to the dead letters
ORDER_REQUIRED = ("id", "create_time")
DETAIL_REQUIRED = ("id", "order_id")
USER_REQUIRED = ("id",)
CHANGE_REQUIRED = ("entry_type", "table", "op")


def _arrival(raw: DataFrame) -> F.Column:
    """Arrival time of a message: the broker timestamp when present."""
    return F.col("arrival") if "arrival" in raw.columns else F.current_timestamp()


def decode_orders(raw: DataFrame, order_time: F.Column | None = None) -> DataFrame:
    """Order topic -> order records; amount string -> double (NULL if bad).
    ``order_time`` (the clock of the join's lateness bound) is the arrival
    time unless given -- the reference's cache TTL is wall-clock too."""
    d = good_rows(decode(raw, ORDER_WIRE, keep=tuple(c for c in ("arrival",) if c in raw.columns),
                         required=ORDER_REQUIRED))
    return (d.withColumn("total_amount", F.col("total_amount").try_cast("double"))
            .withColumn("order_time", order_time if order_time is not None else _arrival(raw)))


def decode_details(raw: DataFrame, line_time: F.Column | None = None) -> DataFrame:
    """Order-line topic -> line records with ``line_time`` (arrival time
    unless given)."""
    d = good_rows(decode(raw, DETAIL_WIRE, keep=tuple(c for c in ("arrival",) if c in raw.columns),
                         required=DETAIL_REQUIRED))
    return d.withColumn("line_time", line_time if line_time is not None else _arrival(raw))


def decode_users(raw: DataFrame) -> DataFrame:
    """User topic -> user versions; ``version`` = arrival order (epoch ms)."""
    d = good_rows(decode(raw, USER_WIRE, keep=tuple(c for c in ("arrival",) if c in raw.columns),
                         required=USER_REQUIRED))
    return d.withColumn("version", F.unix_millis(_arrival(raw)))


def decode_changes(raw: DataFrame) -> DataFrame:
    """Change entries as JSON lines -> entry records."""
    return good_rows(decode(raw, schemas.CHANGE_ENTRY, required=CHANGE_REQUIRED))


#: what each app's decoder rejects: (schema, required fields); ingest keeps
#: its own rejects
REJECTS = {
    "dau": (schemas.STARTUP_LOG, jobs.REQUIRED),
    "first_seen": (schemas.STARTUP_LOG, jobs.REQUIRED),
    "alert": (schemas.EVENT_LOG, jobs.REQUIRED),
    "gmv": (ORDER_WIRE, ORDER_REQUIRED),
    "revenue": (ORDER_WIRE, ORDER_REQUIRED),
    "users": (USER_WIRE, USER_REQUIRED),
    "sale_detail": (DETAIL_WIRE, DETAIL_REQUIRED),
    "sale_detail_orders": (ORDER_WIRE, ORDER_REQUIRED),
    "cdc": (schemas.CHANGE_ENTRY, CHANGE_REQUIRED),
}


def dead_letters_app(raw: DataFrame, app: str, dead_path: str, name: str | None = None,
                     trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """The lines of an app's source that its decoder rejects, as they came. The
    sale-detail app has two sources: ``sale_detail`` stands for its lines,
    ``sale_detail_orders`` for its orders."""
    rejected = jobs.dead_letter_rows(raw, *REJECTS[app])
    return jobs.start(rejected, name or f"{app}_dead", sinks.table_sink(dead_path, fmt="text"),
                      trigger=trigger, checkpoint=checkpoint)


def dau_app(raw: DataFrame, out_path: str, name: str = "dau",
            trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Start-up topic -> per-day first start-up per device (table sink)."""
    rows = jobs.observed(jobs.startup_rows(raw), f"{name}_rows")
    return jobs.start(rows, name, jobs.dau_batch_sink(out_path), trigger=trigger,
                      checkpoint=checkpoint)


def first_seen_app(raw: DataFrame, out_path: str, name: str = "first_seen",
                   trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Start-up topic -> devices by the hour of their earliest start-up
    (``<out>/devices``) and what each batch changes per hour (``<out>/deltas``);
    ``plans.serve`` reads one day of the changes for new devices."""
    return jobs.start(jobs.startup_rows(raw), name,
                      revenue.first_seen_sink(f"{out_path}/devices", f"{out_path}/deltas"),
                      trigger=trigger, checkpoint=checkpoint)


def gmv_app(raw: DataFrame, out_path: str, name: str = "gmv",
            trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Order topic -> cleaned orders (all fields, date/hour derived, phone
    masked, ``version`` = arrival), partitioned by ``create_date``; GMV queries read this table
    (``plans.gmv.gmv_total`` / ``gmv_by_hour`` with ``date=``)."""
    orders = (gmv_plan.clean_orders(decode_orders(raw))
              .withColumn("version", F.unix_millis("order_time")).drop("order_time", "arrival"))
    return jobs.start(orders, name, sinks.table_sink(out_path, ["create_date"]),
                      trigger=trigger, checkpoint=checkpoint)


def revenue_app(raw: DataFrame, out_path: str, name: str = "revenue",
                trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Order topic -> hourly revenue kept up by differences (``<out>/deltas``,
    read by ``revenue.day_by_hour``) and the orders' versions (``<out>/orders``)."""
    orders = (gmv_plan.clean_orders(decode_orders(raw))
              .withColumn("version", F.unix_millis("order_time")).drop("order_time", "arrival"))
    return jobs.start(orders, name, revenue.revenue_sink(f"{out_path}/orders", f"{out_path}/deltas"),
                      trigger=trigger, checkpoint=checkpoint)


def user_app(raw: DataFrame, out_path: str, name: str = "users",
             trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """User topic -> user versions table, laid out by key bucket; readers take
    the latest per id (``sinks.read_keyed(..., ["id"], ["version"])``), lookups
    read the buckets of their ids only."""
    return jobs.start(decode_users(raw).drop("arrival"), name, sinks.keyed_sink(out_path, ["id"]),
                      trigger=trigger, checkpoint=checkpoint)


def alert_app(raw: DataFrame, out_path: str, size: str = "5 minutes", slide: str = "1 minute",
              lateness: str = "1 minute", mode: str = "append", name: str = "alert",
              trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Event topic -> coupon alert documents (``mode='update'`` emits an
    alert as soon as it fires, like the reference)."""
    alerts = jobs.alert_stream(jobs.event_rows(raw), size, slide, lateness)
    return jobs.start(alerts, name, jobs.alert_sink(out_path), mode=mode,
                      trigger=trigger, checkpoint=checkpoint)


def sale_detail_app(order_raw: DataFrame, detail_raw: DataFrame, users_path: str,
                    out_path: str, as_of: str | None = None, bound_seconds: int = 100,
                    name: str = "sale_detail", trigger: dict | None = None,
                    checkpoint: str | None = None) -> StreamingQuery:
    """Order + order-line topics -> enriched sale-detail table (day
    partitions, upsert by line id through ``latest_view``). Ages advance with
    the date unless ``as_of`` fixes one."""
    orders = decode_orders(order_raw).drop("arrival")
    lines = decode_details(detail_raw).drop("arrival")
    joined = jobs.sale_detail_stream(orders, lines, bound_seconds)
    return jobs.start(joined, name, jobs.sale_detail_sink(users_path, out_path, as_of),
                      trigger=trigger, checkpoint=checkpoint)


def ingest_app(raw: DataFrame, archive_path: str, routed_path: str, name: str = "ingest",
               trigger: dict | None = None, checkpoint: str | None = None,
               kafka_servers: str | None = None) -> StreamingQuery:
    """Raw client logs -> stamped daily archive + per-topic routing (files, or
    Kafka if servers are given)."""
    cols = ["value"] + [c for c in ("arrival",) if c in raw.columns]
    return jobs.start(raw.select(*cols), name,
                      jobs.ingest_sink(archive_path, routed_path, kafka_servers=kafka_servers),
                      trigger=trigger, checkpoint=checkpoint)


def cdc_app(entries: DataFrame, out_path: str, name: str = "cdc",
            trigger: dict | None = None, checkpoint: str | None = None,
            database: str | None = None, kafka_servers: str | None = None) -> StreamingQuery:
    """Change entries (of one database, if given) -> routed after-images."""
    routed = jobs.cdc_stream(entries, database).select("topic", "value")
    return jobs.start(routed, name, jobs.topic_sink(out_path, kafka_servers),
                      trigger=trigger, checkpoint=checkpoint)


def topic_folder(routed_path: str, topic: str) -> str:
    """Where the file form of a topic lies below a router's output."""
    return f"{routed_path.rstrip('/')}/topic={topic}"


__all__ = ["decode_orders", "decode_details", "decode_users", "decode_changes", "dau_app", "first_seen_app", "gmv_app",
           "revenue_app", "user_app", "alert_app", "sale_detail_app", "ingest_app", "cdc_app", "dead_letters_app",
           "topic_folder"]


# --- command line (spark-submit entry point) ---------------------------------

def _source(spark, args, topic_arg: str = "topic", path_arg: str = "input"):
    from shopflow.sources import streams
    topic, path = getattr(args, topic_arg, None), getattr(args, path_arg, None)
    if topic:
        return streams.kafka_topic(spark, args.kafka_servers, topic,
                                   per_trigger=args.max_per_trigger)
    return streams.text_files(spark, path, per_trigger=args.max_files)


def main(argv: list[str] | None = None) -> list[StreamingQuery]:
    """``spark-submit --py-files shopflow.zip shopflow/streaming/apps.py <app>
    ...`` -- one app per call, source = Kafka topic (``--kafka-servers
    --topic``) or a folder of JSON-lines files (``--input``); checkpoints
    under spark.checkpoint.dir."""
    import argparse

    from pyspark.sql import SparkSession

    ap = argparse.ArgumentParser(prog="shopflow.streaming.apps")
    ap.add_argument("app", choices=["dau", "first_seen", "gmv", "revenue", "users", "alert", "sale_detail", "ingest", "cdc"])
    ap.add_argument("--kafka-servers")
    ap.add_argument("--topic")
    ap.add_argument("--input")
    ap.add_argument("--detail-topic")
    ap.add_argument("--detail-input")
    ap.add_argument("--users")
    ap.add_argument("--out", required=True)
    ap.add_argument("--routed")
    ap.add_argument("--publish", action="store_true", help="route to Kafka instead of files")
    ap.add_argument("--database", help="cdc: keep this database's changes only")
    ap.add_argument("--as-of", help="sale_detail: fixed date of ages (default: the batch's date)")
    ap.add_argument("--name", help="query name (default: the app)")
    ap.add_argument("--checkpoint", help="folder; every input of an app needs its own")
    ap.add_argument("--dead", help="folder of rejected lines (default: <out>__dead)")
    ap.add_argument("--max-per-trigger", type=int)
    ap.add_argument("--max-files", type=int)
    ap.add_argument("--available-now", action="store_true")
    args = ap.parse_args(argv)
    for app, option in (("sale_detail", "users"), ("ingest", "routed")):
        if args.app == app and not getattr(args, option):
            ap.error(f"{app} needs --{option}")
    if args.publish and not args.kafka_servers:
        ap.error("--publish needs --kafka-servers")
    spark = SparkSession.builder.appName(f"shopflow-{args.app}").getOrCreate()
    trigger = {"availableNow": True} if args.available_now else None
    raw = _source(spark, args)
    name = args.name or args.app
    how = {"name": name, "trigger": trigger, "checkpoint": args.checkpoint}
    servers = args.kafka_servers if args.publish else None
    rejecting = [(raw, args.app)]
    if args.app == "dau":
        q = dau_app(raw, args.out, **how)
    elif args.app == "first_seen":
        q = first_seen_app(raw, args.out, **how)
    elif args.app == "gmv":
        q = gmv_app(raw, args.out, **how)
    elif args.app == "revenue":
        q = revenue_app(raw, args.out, **how)
    elif args.app == "users":
        q = user_app(raw, args.out, **how)
    elif args.app == "alert":
        q = alert_app(raw, args.out, **how)
    elif args.app == "ingest":
        q = ingest_app(raw, args.out, args.routed, kafka_servers=servers, **how)
    elif args.app == "cdc":
        q = cdc_app(decode_changes(raw), args.out, database=args.database, kafka_servers=servers, **how)
    else:
        lines = _source(spark, args, "detail_topic", "detail_input")
        q = sale_detail_app(raw, lines, args.users, args.out, args.as_of, **how)
        rejecting = [(lines, "sale_detail"), (raw, "sale_detail_orders")]
    running = [q]
    dead = (args.dead or jobs.dead_path(args.out)).rstrip("/")
    for source, app in rejecting:
        if app in REJECTS:
            own = "_orders" if app == "sale_detail_orders" else ""   # one folder a topic
            running.append(dead_letters_app(
                source, app, dead + own, f"{name}_dead{own}", trigger,
                args.checkpoint and f"{args.checkpoint.rstrip('/')}_dead{own}"))
    if args.available_now:
        for query in running:
            query.awaitTermination()
    return running


if __name__ == "__main__":
    main()[0].awaitTermination()
