"""Mergeable sets of devices as bitmaps.

Every device gets a dense number within its hash slot, once and for all. A day
then is a few bitmaps of 32,768 bits (4 KB), one per slot and bitmap bucket, and
sets are merged by OR: re-delivered rows change nothing, a late row sets its bit
in the day it belongs to. New devices of a day are the bits of that day that no
earlier day has: the growth of the running OR. All with Spark's bitmap
functions; a slot's window holds one 4 KB row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: hash slots that number their devices apart from each other; about 30,000
#: devices a slot fill one bitmap
SLOTS = 64
KEY = ["slot", "part"]


def number(devices: DataFrame, known: DataFrame | None = None, slots: int = SLOTS) -> DataFrame:
    """``mid, slot, n``: numbers (from 1, without holes within a slot) of those
    ``devices`` that ``known`` does not number. Slots, not devices, are sorted:
    a slot holds its share of all devices."""
    slot = F.pmod(F.xxhash64("mid"), F.lit(slots)).cast("int")
    new = devices.select("mid").filter(F.col("mid").isNotNull()).distinct().withColumn("slot", slot)
    order = F.row_number().over(Window.partitionBy("slot").orderBy("mid")).cast("long")
    if known is None:
        return new.withColumn("n", order)
    new = new.join(known.select("mid"), "mid", "left_anti")
    top = known.groupBy("slot").agg(F.max("n").alias("top"))
    return (new.withColumn("i", order).join(top, "slot", "left")
            .select("mid", "slot", (F.coalesce("top", F.lit(0)) + F.col("i")).alias("n")))


def day_bits(rows: DataFrame, numbers: DataFrame, day: str = "log_date") -> DataFrame:
    """Device-day rows (``mid``, day) -> ``day, slot, part, bits``."""
    seen = rows.select("mid", day).distinct().join(numbers, "mid")
    return (seen.groupBy(day, "slot", F.bitmap_bucket_number("n").alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")))


def merged(bits: DataFrame, day: str = "log_date") -> DataFrame:
    """One bitmap per day, slot and part of any number of batches."""
    return bits.groupBy(day, *KEY).agg(F.bitmap_or_agg("bits").alias("bits"))


def totals(bits: DataFrame, day: str = "log_date") -> DataFrame:
    """AGG3: devices per day."""
    return merged(bits, day).groupBy(day).agg(F.sum(F.bitmap_count("bits")).alias("dau"))


def new_per_day(bits: DataFrame, day: str = "log_date") -> DataFrame:
    """AGG14: devices per day that are on no earlier day; days without a new one
    have no row."""
    until = Window.partitionBy(*KEY).orderBy(day)
    upto = until.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grown = (merged(bits, day)
             .withColumn("known", F.bitmap_count(F.bitmap_or_agg("bits").over(upto)))
             .withColumn("new", F.col("known") - F.coalesce(F.lag("known").over(until), F.lit(0))))
    return (grown.groupBy(day).agg(F.sum("new").alias("new_mid")).filter(F.col("new_mid") > 0))
