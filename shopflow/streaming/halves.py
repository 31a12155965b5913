"""Order/line join whose halves wait in keyed state.

An order and its lines arrive on two topics, in any order and up to a bound
apart. The state holds orders (always, as more lines may come) and the lines
that came before theirs. A line that finds its order is put out at once and not
kept. Event-time timeouts expire what is older than the bound: what never met
its other half is then put out as a half of its own, so every incoming row
leaves once, joined or alone.

Both topics run through one ``applyInPandasWithState`` operator, checkpointed
and restored on another executor when one is lost. Its keys are buckets of order
ids, not single ids: a state call a key costs milliseconds, a bucket's live
halves (one Arrow table) are joined and expired column-wise. ``buckets`` is
chosen so that a bucket's live halves stay in the tens of thousands
(``buckets_for``; a task holds one bucket's halves at a time, so its memory does
not grow with the topics); an order's own lines are bounded by the order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shopflow.streaming import sinks

PAIR, LATE, ORDER_ONLY, LINE_ONLY = "pair", "late", "order", "line"
CLOCK = "clock"   # a message that only moves the watermark on
BUCKETS = 64
#: halves that a bucket is meant to hold at most
BUCKET_HALVES = 50_000
#: candidate pairs that are looked at together
PAIRS = 500_000
#: found rows that leave Python as one: it holds 10,000 such before they are sent
TOGETHER = 64

#: the common shape of both topics' messages in the operator
HALF = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("side", T.StringType()),
    T.StructField("body", T.StringType()), T.StructField("at", T.TimestampType())])
JOINED = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("found", T.StringType()),
    T.StructField("order_body", T.StringType()), T.StructField("line_body", T.StringType())])
_HELD = pa.schema([("order_id", pa.string()), ("side", pa.string()), ("body", pa.string()), ("ms", pa.int64()),
                   ("met", pa.bool_())])
_OUT = list(JOINED.names)
_LISTS = T.StructType([T.StructField(c, T.ArrayType(T.StringType())) for c in _OUT])


def buckets_for(live: int) -> int:
    """Buckets for so many halves that may be live, or come in one micro-batch,
    at once. A checkpoint's queries keep one number."""
    return max(BUCKETS, math.ceil(live / BUCKET_HALVES))


def meet(halves: pd.DataFrame, bound: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The pairs among ``halves`` (order_id, side, body, ms, met) and what stays:
    orders, marked once they met a line, and lines without one. A line takes the
    earliest order of its id within the bound, which is inclusive."""
    is_order = halves["side"] == ORDER_ONLY
    orders = halves[is_order].sort_values(["ms", "body"], kind="stable").reset_index(drop=True)
    lines = halves[~is_order].reset_index(drop=True)
    both = (lines.reset_index().rename(columns={"index": "line"})
            .merge(orders.reset_index().rename(columns={"index": "order"}), on="order_id", suffixes=("", "_o")))
    both = both[(both["ms"] - both["ms_o"]).abs() <= bound].sort_values("order", kind="stable").drop_duplicates("line")
    orders.loc[both["order"].unique(), "met"] = True
    pairs = pd.DataFrame({"order_id": both["order_id"], "found": PAIR, "order_body": both["body_o"],
                          "line_body": both["body"]})
    return pairs, pd.concat([orders, lines.drop(index=both["line"])], ignore_index=True)


def _near(orders: np.ndarray, lines: np.ndarray, ids: np.ndarray, ms: np.ndarray,
          bound: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the ``orders`` and ``lines`` of one id within the bound,
    found about ``PAIRS`` candidates at a time. A missing id (-1) meets nothing."""
    orders, lines = orders[np.argsort(ids[orders], kind="stable")], lines[ids[lines] >= 0]
    first = np.searchsorted(ids[orders], ids[lines], "left")
    n = np.searchsorted(ids[orders], ids[lines], "right") - first
    lines, first, n = lines[n > 0], first[n > 0], n[n > 0]
    cuts = np.flatnonzero(np.diff(np.cumsum(n) // PAIRS)) + 1
    for low, high in pairwise([0, *cuts, len(lines)]):
        count, line = n[low:high], np.repeat(lines[low:high], n[low:high])
        order = orders[np.arange(len(line)) + np.repeat(first[low:high] - (np.cumsum(count) - count), count)]
        near = np.abs(ms[order] - ms[line]) <= bound
        yield order[near], line[near]


def meet_all(halves: pd.DataFrame, held: int, bound: int) -> Iterator[pd.DataFrame]:
    """Every pair within the bound that has at least one half that is not among
    the first ``held``; halves that met are marked in place, and all stay."""
    if held == len(halves):
        return
    is_order, fresh = (halves["side"] == ORDER_ONLY).to_numpy(dtype=bool), np.arange(len(halves)) >= held
    ids, ms = pd.factorize(halves["order_id"])[0], halves["ms"].to_numpy()
    names, bodies = halves["order_id"].to_numpy(), halves["body"].to_numpy()
    met = halves["met"].to_numpy(dtype=bool, copy=True)
    for orders, lines in ((is_order & fresh, ~is_order), (is_order & ~fresh, ~is_order & fresh)):
        for order, line in _near(np.flatnonzero(orders), np.flatnonzero(lines), ids, ms, bound):
            met[order] = met[line] = True
            if len(order):
                yield pd.DataFrame({"order_id": names[order], "found": PAIR, "order_body": bodies[order],
                                    "line_body": bodies[line]})
    halves["met"] = met


def expire(halves: pd.DataFrame, watermark: int, bound: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Of halves that no later row can meet those that met nothing, and what is
    still open."""
    gone = halves["ms"] + bound < watermark
    lone = halves[gone & ~halves["met"].astype(bool)]
    is_order = lone["side"] == ORDER_ONLY
    out = pd.DataFrame({"order_id": lone["order_id"], "found": lone["side"],
                        "order_body": lone["body"].where(is_order, None), "line_body": lone["body"].where(~is_order, None)})
    return out, halves[~gone]


def _packed(halves: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(halves[_HELD.names], schema=_HELD, preserve_index=False)
    with pa.ipc.new_stream(sink, _HELD, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(held: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(held).read_all().to_pandas()


def _together(out: pd.DataFrame) -> pd.DataFrame:
    """Found rows as lists of ``TOGETHER``, which cost a fraction of as many
    rows on the way out of Python."""
    return pd.DataFrame({c: [v[i:i + TOGETHER] for i in range(0, len(v), TOGETHER)]
                         for c, v in ((c, out[c].to_numpy(dtype=object)) for c in _OUT)})


def _stepper(bound: int, every: bool = False):
    """One bucket's step; with ``every``, each pair is put out (``meet_all``)
    instead of a line's first (``meet``)."""
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [_unpacked(bytes(state.get[0]))] if state.exists else []
        held = sum(map(len, parts))
        if not state.hasTimedOut:
            for frame in frames:
                frame = frame[frame["side"] != CLOCK]
                parts.append(frame[["order_id", "side", "body", "ms"]].assign(met=False))
        parts = [p for p in parts if len(p)]
        if not parts:
            if state.exists:
                state.remove()
            return
        rest = pd.concat(parts, ignore_index=True)
        if every:
            for pairs in meet_all(rest, held, bound):
                yield _together(pairs)
            pairs = rest[:0]
        else:
            pairs, rest = meet(rest, bound)
        alone, rest = expire(rest, state.getCurrentWatermarkMs(), bound)
        if len(rest):
            state.update((_packed(rest),))
            state.setTimeoutTimestamp(int(rest["ms"].min()) + bound + 1)
        elif state.exists:
            state.remove()
        for out in (pairs, alone):
            if len(out):
                yield _together(out)
    return step


def half(df: DataFrame, side: str, order_id: str, at: str, body: list[str]) -> DataFrame:
    """Decoded rows of one topic as halves; ``body`` columns travel as JSON."""
    return df.select(F.col(order_id).cast("string").alias("order_id"), F.lit(side).alias("side"),
                     F.to_json(F.struct(*body)).alias("body"), F.col(at).cast("timestamp").alias("at"))


def _joined(timed: DataFrame, bound_seconds: int, buckets: int, every: bool) -> DataFrame:
    dealt = (timed.withColumn("ms", F.unix_millis("at"))
             .withColumn("bucket", F.pmod(F.xxhash64("order_id"), F.lit(buckets))))
    return dealt.groupBy("bucket").applyInPandasWithState(
        _stepper(bound_seconds * 1000, every), _LISTS, "held binary", "append",
        GroupStateTimeout.EventTimeTimeout).select(F.inline(F.arrays_zip(*_OUT)))


def halves_stream(halves: DataFrame, bound_seconds: int, delay: str = "1 second",
                  buckets: int = BUCKETS) -> DataFrame:
    """Stream of both topics' halves (``half``, united) -> ``order_id, found,
    order_body, line_body``. Rows that arrive more than ``delay`` behind the
    newest are late and counted in the progress."""
    return _joined(halves.withWatermark("at", delay), bound_seconds, buckets, every=False)


def outer_stream(orders: DataFrame, lines: DataFrame, bound_seconds: int, delay: str = "1 second",
                 buckets: int = BUCKETS) -> DataFrame:
    """The full outer join of two streams of halves, one a topic, each with a
    watermark of its own (the slower one counts): the rows of Spark's own
    stream-stream join, but with a bucket's halves as one row of state instead
    of four rows a half. It joins every order within the bound, so with re-sent
    orders a line comes out more than once (``halves_stream`` takes one); what
    can no longer meet is put out alone, if it met nothing."""
    # a clock message has no body
    both = [half.select("order_id", F.when(F.col("body").isNull(), CLOCK).otherwise(side).alias("side"), "body", "at")
            .withWatermark("at", delay) for half, side in ((orders, ORDER_ONLY), (lines, LINE_ONLY))]
    return _joined(both[0].unionByName(both[1]), bound_seconds, buckets, every=True)


def halves_sink(out_path: str):
    """Every found row, partitioned by what was found."""
    return sinks.table_sink(out_path, ["found"])


def repaired(spark: SparkSession, out_path: str) -> DataFrame:
    """All stored rows after the repair step: a line alone whose order is
    stored, however late, is joined with it (``found`` = ``late``); an order
    alone that lines now belong to is no row of its own any more."""
    stored = sinks.read_table(spark, out_path, empty_schema=_ddl()).select(*_OUT)
    is_line, own = F.col("found") == LINE_ONLY, Window.partitionBy("order_id")
    # one shuffle by order; rows without an id belong to no order
    known = F.when(F.col("order_id").isNotNull(), F.min(F.when(~is_line, F.col("order_body"))).over(own))
    tried = F.coalesce(F.col("order_id").isNotNull() & F.max(is_line).over(own), F.lit(False))
    met = stored.withColumn("known", known).withColumn("tried", tried)
    return met.filter((F.col("found") != ORDER_ONLY) | ~F.col("tried")).select(
        "order_id", F.when(is_line & F.col("known").isNotNull(), LATE).otherwise(F.col("found")).alias("found"),
        F.when(is_line, F.col("known")).otherwise(F.col("order_body")).alias("order_body"), "line_body")


def _ddl() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in JOINED.fields)


def field(body: str, name: str, kind: str = "string") -> Column:
    return F.get_json_object(body, f"$.{name}").cast(kind).alias(name)
