"""URL rules and an exact block list held as a Bloom filter cascade.

``parse`` splits urls; ``rule_of`` finds the longest fitting rule. Urls that
no rule fits are judged by the block list: level 0 is a Bloom filter of the
listed keys, level 1 one of the unlisted keys that pass level 0, level 2 one
of the listed keys that pass level 1, and so on until nothing passes wrongly.
All keys of the corpus take part, so for them the answer is exact: a key's
side is told by the first level that rejects it. Judging a page is a
map-only pass with the filters broadcast.

The filters' size grows with the list. It is computed before anything is
collected. Beyond ``max_bytes`` the keys are dealt into ranges, one cascade
each, so that no broadcast is larger; a range's cascade judges the pages of its
range only, in a pass of its own over the urls.

The block list is a condition on host and path, or a table (host, path) of any
size that the caller gives. Filters hold 64-bit keys of urls. Where a listed
and an unlisted url of the corpus share a key -- found when the keys are grouped
-- the unlisted urls are told apart by their text, so that no url is blocked
for another one's sake.

Defined cases: null urls and urls without ``://`` have host and path empty;
the empty url is never listed; an empty list blocks nothing; rows of a list that
repeat or lack a host count once or not at all, a null path is empty; repeated
urls are judged alike; other columns, also such as are named host, path, key or
listed, are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.llm import bloom
from shopflow.llm.bloom import Bloom
from shopflow.llm.common import cut, pieces, python_ready

#: fixed values: (verdict, host, path) of the rules
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: fixed values: first host labels of the block list's sites
LISTED_LABELS = ["adult-x", "free-bets", "spam-farm"]
MAX_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise(F.lit(""))
    raw = F.regexp_extract("rest", r"^[^/?#]*", 0)
    after = F.substring(F.col("rest"), F.length(raw) + 1, F.length("rest"))
    return (pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
            .select("page_id", F.translate(raw, UPPER, LOWER).alias("host"),
                    F.regexp_extract(after, r"^[^?#]*", 0).alias("path")))


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) \
            & F.startswith("path", F.lit(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def tested(keys: DataFrame, level: Bloom) -> DataFrame:
    """The keys that the level accepts."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.passes(batch.column(0).to_numpy())))
    return keys.select("key").mapInArrow(run, "key long")


def first_size(inside: int, outside: int) -> tuple[int, int]:
    """Bits and hashes of the first level."""
    return bloom.sized(inside, min(0.5, max(inside, 1) / (math.sqrt(2) * max(outside, 1))))


def sides(universe: DataFrame) -> tuple[int, int]:
    """Numbers of listed and of other keys."""
    n = {r["listed"]: r["count"] for r in universe.groupBy("listed").count().collect()}
    return n.get(True, 0), n.get(False, 0)


def build(universe: DataFrame) -> list[Bloom]:
    """Levels for a table (key long, listed boolean) of distinct keys."""
    python_ready(universe.sparkSession)
    inside, outside = sides(universe)
    if not inside:
        return []
    bits, hashes = first_size(inside, outside)
    levels: list[Bloom] = []
    has, rest = universe.filter("listed").select("key"), universe.filter("not listed").select("key")
    while True:
        levels.append(bloom.build(has, bits, hashes, len(levels)))
        passed = cut(tested(rest, levels[-1]))
        count = passed.count()
        if not count:
            return levels
        has, rest = passed, has
        bits, hashes = bloom.sized(count, 0.5)


def member(keys: np.ndarray, levels: list[Bloom]) -> np.ndarray:
    """Whether each key of the universe is listed."""
    listed = np.zeros(len(keys), bool)
    open_ = np.arange(len(keys))
    for number, level in enumerate(levels):
        ok = level.passes(keys[open_])
        listed[open_[~ok]] = number % 2 == 1
        open_ = open_[ok]
    listed[open_] = len(levels) % 2 == 1
    return listed


def listed_pages(pages: DataFrame, levels: list[Bloom]) -> DataFrame:
    """``pages`` (with a column key) with the column listed, without a join."""
    shared = pages.sparkSession.sparkContext.broadcast(levels)
    fields = T.StructType([*pages.schema.fields, T.StructField("listed", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = member(batch.column("key").to_numpy(), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], [*batch.schema.names, "listed"])
    return pages.mapInArrow(run, fields)


def ranges(universe: DataFrame, max_bytes: int) -> int:
    """How many ranges of keys keep each one's cascade below ``max_bytes``."""
    inside, outside = sides(universe)
    if not inside:
        return 1
    # later levels hold less than twice the first one's bits
    return pieces(3 * first_size(inside, outside)[0] / 8, max(max_bytes, 1))


def in_range(df: DataFrame, number: int, n: int) -> DataFrame:
    return df if n == 1 else df.filter(F.pmod("key", F.lit(n)) == number)


def url_key() -> Column:
    return F.xxhash64(F.concat("host", "path"))


def marked(parsed: DataFrame, listed: Column | DataFrame, key: Column) -> DataFrame:
    """host, path, key, listed of the corpus's urls: rows as they stand for a
    condition, distinct ones for a list."""
    own = parsed.select("host", "path")
    if isinstance(listed, Column):
        return own.select("host", "path", key.alias("key"), F.coalesce(listed, F.lit(False)).alias("listed"))
    given = listed.select("host", F.coalesce("path", F.lit("")).alias("path")).filter("host <> ''")
    both = (own.withColumn("in_corpus", F.lit(True)).withColumn("listed", F.lit(False))
            .unionByName(given.withColumn("in_corpus", F.lit(False)).withColumn("listed", F.lit(True))))
    urls = both.groupBy("host", "path").agg(F.bool_or("in_corpus").alias("in_corpus"),
                                            F.bool_or("listed").alias("listed"))
    return urls.filter("in_corpus").select("host", "path", key.alias("key"), "listed")


def judge(pages: DataFrame, listed: Column | DataFrame, rules=RULES, max_bytes: int = MAX_BYTES,
          key: Column | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. ``listed`` is the
    block list: a condition on host and path, or a table (host, path). ``key``
    is the urls' 64-bit key, an expression on host and path."""
    key = url_key() if key is None else key
    parsed = parse(pages).withColumn("key", key)
    urls = marked(parsed, listed, key)
    universe = cut(urls.groupBy("key").agg(F.bool_or("listed").alias("listed"), F.bool_and("listed").alias("pure")))
    n = ranges(universe, max_bytes)
    known = reduce(DataFrame.unionByName, [
        listed_pages(in_range(parsed, i, n), build(in_range(universe.select("key", "listed"), i, n)))
        for i in range(n)])
    shared = universe.filter("listed and not pure").select("key")
    if shared.take(1):  # keys that a listed and an unlisted url have in common
        spared = (urls.filter("not listed").join(shared, "key", "left_semi")
                  .select("host", "path", F.lit(True).alias("spared")).distinct())
        known = known.join(spared, ["host", "path"], "left").withColumn("listed", F.expr("listed and spared is null"))
    rule, verdict = rule_of(rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return known.select("page_id", "host", "path", rule.alias("rule"),
                        F.coalesce(verdict, own).alias("verdict"))


def label_listed(labels=LISTED_LABELS) -> Column:
    return F.substring_index("host", ".", 1).isin(list(labels))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, label_listed())


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
v AS (SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM u),
p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM v),
rules(what, rhost, rpath) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
  SELECT host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
         max_by(what, length(rhost || rpath)) AS what
  FROM (SELECT DISTINCT host, path FROM p) k JOIN rules r
    ON (k.host = r.rhost OR ends_with(k.host, '.' || r.rhost)) AND starts_with(k.path, r.rpath)
  GROUP BY host, path)
SELECT p.page_id, p.host, p.path, best.rule,
       coalesce(best.what, CASE WHEN split_part(p.host, '.', 1) IN ('adult-x', 'free-bets', 'spam-farm')
                                THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path
"""
