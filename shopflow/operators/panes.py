"""Sliding windows from panes.

A window of ``size`` that slides by ``slide`` contains every event
``size / slide`` times. Here an event is counted once, in the pane (the greatest
common length of both) it falls into. A pane belongs to one run of windows, so
what it adds to their sums is two steps: up where the run begins, down behind its
end. Running sums over the steps are the windows' sums, and rows are made only
for windows that the caller keeps. A caller whose windows must pass a bound that
two adjoining stretches of ``size`` pass as well (a least count, for example)
leaves out all stretches that cannot reach it before that.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNITS_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def duration_ms(text: str) -> int:
    """``"5 minutes"`` -> milliseconds; also several parts in a row."""
    parts = text.lower().split()
    if not parts or len(parts) % 2:
        raise ValueError(f"no duration: {text!r}")
    total = 0
    for n, unit in zip(parts[::2], parts[1::2]):
        unit = unit.removesuffix("s")
        if unit not in _UNITS_MS:
            raise ValueError(f"no duration: {text!r}")
        total += int(n) * _UNITS_MS[unit]
    return total


@dataclass(frozen=True)
class Panes:
    """Lengths in milliseconds; windows start at multiples of ``slide``."""
    size: int
    slide: int

    @classmethod
    def of(cls, size: str, slide: str | None = None) -> Panes:
        made = cls(duration_ms(size), duration_ms(slide or size))
        if made.slide <= 0 or made.size < made.slide:
            raise ValueError("a window is at least as long as its slide")
        return made

    @property
    def length(self) -> int:
        return math.gcd(self.size, self.slide)

    @property
    def per_window(self) -> int:
        return self.size // self.length

    @property
    def step(self) -> int:
        return self.slide // self.length

    def pane(self, ts_ms: Column) -> Column:
        """Number of the pane a time falls into."""
        return F.floor(ts_ms / self.length).cast("long")

    def starts(self, first: Column, last: Column) -> Column:
        """First panes of the windows that begin between two panes, as an array."""
        a, b = F.ceil(first / self.step).cast("long"), F.floor(last / self.step).cast("long")
        made = F.transform(F.sequence(a, b), lambda x: x * self.step)
        return F.when(a <= b, made).otherwise(F.array().cast("array<bigint>"))

    def window_start(self, start: Column) -> Column:
        return F.timestamp_millis(start * self.length)

    def window_end(self, start: Column) -> Column:
        return F.timestamp_millis(start * self.length + self.size)


def in_stretches(cells: DataFrame, panes: Panes, pane: str = "pane") -> DataFrame:
    """Every pane row twice, as a part of both pairs of stretches (``stretch``
    and the next one, each one window long) that it belongs to: any window lies
    within the pair that begins with its own stretch."""
    own = F.floor(F.col(pane) / panes.per_window).cast("long")
    return cells.withColumn("stretch", F.explode(F.array(own - 1, own)))


def running_sums(steps: DataFrame, keys: Sequence[str], sums: Sequence[str], at: str = "at") -> DataFrame:
    """Steps (changes of ``sums`` from pane ``at`` on) as stretches of equal sums,
    ``at`` up to ``until``; the last step, after which nothing is left, has no
    ``until``. Steps of one pane are added up map-side before they are sorted."""
    once = steps.groupBy(*keys, at).agg(*[F.sum(c).alias(c) for c in sums])
    order = Window.partitionBy(*keys).orderBy(at)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return once.select(*keys, at, *[F.sum(c).over(upto).alias(c) for c in sums],
                       (F.lead(at).over(order) - 1).alias("until"))
