"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

1. Every row gets the SHA-256 of its normalised text (runs of ASCII white
   space become one space; null counts as empty).
2. ``freqItems`` -- Spark's Misra-Gries summary, at most ``1 / support``
   counters per partial aggregate -- proposes the frequent digests.
3. An exact count verifies the proposals. At most ``1 / support`` digests can
   hold a share of ``support`` each, so the verified winners (digest, row that
   stays, size) are a broadcast of proven size. Rows of these digests, however
   many, are decided map-side and never meet in one task.
4. The remaining digests, each under ``support`` of the rows, use an ordinary
   partial aggregate and a join that adaptive execution can split.

Defined cases: a null text equals an empty one; a null id comes after all other ids; of repeated
rows (same id, same text) exactly one stays; an empty table gives an empty
result; other columns are ignored by ``mark`` and carried by ``keep_first``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import cut

SUPPORT = 0.001
#: bits of the filter of repeated digests: 8 MB, in bitmaps of 4 KB
SLOTS = 1 << 26


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the white-space-normalised UTF-8 text. Only
    runs that are not already a single space are replaced."""
    not_one_space = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), not_one_space, " ").cast("binary"), 256)


def heavy_candidates(digests: DataFrame, support: float) -> DataFrame:
    """Digests that the Misra-Gries summary proposes, at most ``1 / support``."""
    found = digests.select("text_sha256").freqItems(["text_sha256"], support)
    return found.select(F.explode("text_sha256_freqItems").alias("text_sha256"))


def winners(digests: DataFrame, support: float) -> DataFrame:
    """(text_sha256, first, group_size) of the digests that truly hold at
    least ``support`` of all rows."""
    proposed = F.broadcast(heavy_candidates(digests, support))
    counted = groups(digests.join(proposed, "text_sha256"))
    return counted.filter(F.col("group_size") >= support * digests.count())


def groups(digests: DataFrame) -> DataFrame:
    return digests.groupBy("text_sha256").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("group_size"))


def mark(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = cut(docs.select("doc_id", text_digest(F.col("text")).alias("text_sha256"))
                  .withColumn("place", F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id",
                                                F.monotonically_increasing_id().alias("row"))))
    heavy = cut(winners(digests, support))
    light = digests.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    decided = (digests.join(F.broadcast(heavy), "text_sha256")
               .unionByName(light.join(groups(light), "text_sha256")))
    return decided.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                          (F.col("place.row") == F.col("first.row")).alias("kept"), "text_sha256")


def with_bits(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """``rows`` with ``hit``: true for every row whose text_sha256 is among
    ``digests``, and for few others. The digests are folded into ``SLOTS`` bits,
    so the broadcast table of bitmaps is bounded whatever their number."""
    slot = F.pmod(F.xxhash64("text_sha256"), F.lit(SLOTS)) + 1
    part, bit = F.bitmap_bucket_number(slot), F.bitmap_bit_position(slot)
    bits = digests.groupBy(part.alias("part")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    octet = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return (rows.withColumn("part", part).withColumn("bit", bit.cast("int"))
            .join(F.broadcast(bits), "part", "left")
            .withColumn("hit", F.coalesce(octet.bitwiseAND(F.expr("shiftleft(1, bit % 8)")) > 0, F.lit(False)))
            .drop("part", "bit", "bits"))


def keep_first(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows that stay, with all their columns. Heavy digests lose their
    copies map-side; rows whose digest a bitmap of all repeated digests lacks
    stay map-side; only the others' texts are shuffled, by a partial aggregate
    that keeps the first row of each digest."""
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("kept_row"),
                       text_digest(F.col("text")).alias("text_sha256"))
    place = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id")
    digests = cut(docs.select("doc_id", text_digest(F.col("text")).alias("text_sha256"))
                  .withColumn("place", place))
    heavy = cut(winners(digests, support))
    repeated = groups(digests).filter("group_size > 1").select("text_sha256")
    seen = with_bits(rows, repeated).join(
        F.broadcast(heavy.select("text_sha256", "first", F.lit(True).alias("heavy"))), "text_sha256", "left")
    unique = seen.filter("heavy is null and not hit").select("kept_row.*")
    open_ = seen.filter(F.when(F.col("heavy"), F.col("kept_row.doc_id").eqNullSafe(F.col("first.doc_id")))
                        .otherwise(F.col("hit")))
    first = F.min_by("kept_row", F.struct(F.col("kept_row.doc_id").isNull(), F.col("kept_row.doc_id")))
    kept = open_.groupBy("text_sha256").agg(first.alias("kept_row")).select("kept_row.*")
    return unique.unionByName(kept).select(*columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
