"""Sharding, URL filter and exact deduplication."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopflow.llm import exact_dedup, queries, sharding, url_filter
from tests.conftest import SF001, SF01
from tests.llm import cases
from tests.oracle import compare, duck


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    ok, message = compare(queries.QUERIES[name](spark, SF01), queries.ORACLE_SQL[name], duck(SF01))
    assert ok, message


def plain_fill(shards, slots):
    """The table by the definition: each shard's whole permutation, in turns."""
    def number(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    order = {s: [(number(f"offset:{s}") + i * (number(f"skip:{s}") % (slots - 1) + 1)) % slots for i in range(slots)]
             for s in shards}
    owner = {}
    while len(owner) < slots:
        for s in shards:
            free = [x for x in order[s] if x not in owner]
            if free:
                owner[free[0]] = s
    return [owner[i] for i in range(slots)]


def test_sharding_table():
    names = ["a", "b", "c"]
    assert [names[i] for i in sharding.fill(names, 31)] == plain_fill(names, 31)
    loads = Counter(sharding.fill([f"s{i}" for i in range(64)])).values()
    assert max(loads) - min(loads) <= 1
    assert sharding.fill(["only"], 2) == [0, 0]
    for bad in ((names, 30), ([], 31), (["a", "a"], 31)):
        with pytest.raises(ValueError):
            sharding.fill(*bad)


def test_sharding_moves_little():
    before = [f"s{i}" for i in range(20)]
    one, two = sharding.fill(before, 4099), sharding.fill(before[:-1], 4099)
    moved = sum(before[a] != before[b] for a, b in zip(one, two) if a != 19)
    assert moved < 0.15 * 4099


def test_sharding_query_matches_brute_force(spark):
    got = queries.QUERIES["op1_sharding"](spark, SF001).collect()
    owner = sharding.fill(queries.SHARDS)
    for r in got:
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r.slot, r.shard) == (slot, queries.SHARDS[owner[slot]])
    assert len(got) == 200


def test_sharding_edges(spark, workdir):
    docs = cases.frame(spark).select("doc_id", "text", F.lit(None).cast("string").alias("kept"))
    placed = sharding.place(docs, "doc_id", ["x", "y"], 101)
    assert placed.count() == len(cases.rows())
    assert {r.slot for r in placed.filter("doc_id is null").collect()} == {0}
    assert sharding.place(docs.limit(0), "doc_id", ["x"], 101).count() == 0
    sharding.write(placed, f"{workdir}/shards", 3)
    back = spark.read.parquet(f"{workdir}/shards")
    assert back.count() == placed.count()


def plain_judge(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(raw):]).group()
        host = "".join(c.lower() if c.isascii() else c for c in raw)
    best = None
    for what, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, what)
    listed = host.split(".")[0] in url_filter.LISTED_LABELS
    return (host, path, best and best[0], best[1] if best else "block" if listed else "allow")


URLS = [None, "", "no scheme", "http://", "http://Example.ORG", "https://a.example.org/es/1", "http://example.org/en/12?x#y",
        "http://x.org/", "http://com/fr/", "http://notcom/fr/", "http://a.com/de/?q", "ftp://free-bets.example.net/x",
        "http://adult-x.example.com/en/1", "http://spam-farm.example.org", "x://ÄB.com/fr/a", "a://b://c/d", "http://h?x=/de/"]


def test_url_filter_edges(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS)], "page_id long, url string")
    for most in (url_filter.MAX_BYTES, 8):  # one cascade, and one a range of keys
        got = {r.page_id: tuple(r)[1:] for r in
               url_filter.judge(pages, url_filter.label_listed(), max_bytes=most).collect()}
        assert got == {i: plain_judge(u) for i, u in enumerate(URLS + URLS)}
    assert url_filter.judge(pages.limit(0), url_filter.label_listed()).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, F.lit(False), rules=[]).collect()} == {"allow"}


def test_url_list_of_the_caller(spark):
    urls = [f"http://h{i % 40}.net/p{i}" for i in range(400)] + [None, "http://x.org/a", "http://x.net"]
    pages = spark.createDataFrame([(i, u, "own", i, True) for i, u in enumerate(urls + urls[:50])],
                                  "page_id long, url string, host string, key long, listed boolean")
    bad = [(f"h{i % 40}.net", f"/p{i}") for i in range(0, 400, 7)]
    rows = [*bad, *bad[:9], ("x.org", "/a"), ("x.net", None), ("", "/p"), (None, "/p1"), ("elsewhere.net", "/")]
    listed = spark.createDataFrame(rows, "host string, path string")
    want = {}
    for i, u in enumerate(urls + urls[:50]):
        host, path = plain_judge(u)[:2]
        want[i] = "allow" if host == "x.org" or not host else \
            "block" if (host, path) in bad or host == "x.net" else "allow"
    few = F.length("host") * 100 + F.length("path")  # keys that many urls share
    for most, key in ((url_filter.MAX_BYTES, None), (40, None), (40, few)):
        got = url_filter.judge(pages, listed, max_bytes=most, key=key).collect()
        assert len(got) == len(want) and {r.page_id: r.verdict for r in got} == want
    assert {r.verdict for r in url_filter.judge(pages, listed.limit(0), rules=[]).collect()} == {"allow"}


def test_ranges_bound_every_cascade(spark):
    universe = spark.range(60_000).select(F.xxhash64("id").alias("key"), (F.col("id") % 3 == 0).alias("listed")).cache()
    most = 5_000
    n = url_filter.ranges(universe, most)
    assert n > 3
    for i in range(n):
        own = url_filter.in_range(universe, i, n)
        levels = url_filter.build(own)
        assert sum(level.words.nbytes for level in levels) < 1.2 * most
        assert url_filter.listed_pages(own.withColumnRenamed("listed", "truth"), levels).filter("listed <> truth").count() == 0


def test_cascade_is_exact_for_every_key(spark):
    universe = spark.range(20_000).select(F.xxhash64("id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    levels = url_filter.build(universe)
    assert len(levels) > 2
    got = url_filter.listed_pages(universe.withColumnRenamed("listed", "truth"), levels)
    assert got.filter("listed <> truth").count() == 0


def plain_mark(data):
    groups = {}
    for at, r in enumerate(data):
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
        groups.setdefault(hashlib.sha256(text.encode()).hexdigest(), []).append((r[0] is None, r[0] or 0, at, r))
    return groups


@pytest.mark.parametrize("support", [0.001, 0.2])
def test_exact_dedup_edges(spark, support):
    data = cases.rows()
    docs = cases.frame(spark, clash=True)
    got = exact_dedup.mark(docs, support).collect()
    groups = plain_mark(data)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(
        (m[3][0], min(g)[3][0], len(g), digest) for digest, g in groups.items() for m in g)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(list(groups))
    stays = exact_dedup.keep_first(docs, support)
    assert stays.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in stays.collect()) == Counter(
        (min(g)[3][0], min(g)[3][1]) for g in groups.values())
    assert exact_dedup.mark(docs.limit(0)).count() == 0
    assert exact_dedup.keep_first(docs.limit(0)).count() == 0


def test_heavy_digests_are_decided_map_side(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot")
                                    .otherwise(F.col("id").cast("string")).alias("text"))
    digests = docs.select("doc_id", exact_dedup.text_digest(F.col("text")).alias("text_sha256"),
                          F.struct("doc_id").alias("place"))
    assert [r.group_size for r in exact_dedup.winners(digests, 0.05).collect()] == [1000]
    got = exact_dedup.mark(docs).filter("kept").count()
    assert got == 2001
    again = docs.unionByName(docs.filter("doc_id % 3 = 1"))  # the same ids once more
    copies = again.unionByName(docs.filter("doc_id % 5 = 2").withColumn("doc_id", F.col("doc_id") + 5000))
    assert sorted(r.doc_id for r in exact_dedup.keep_first(copies).collect()) == \
        sorted([0] + [d for d in range(3000) if d % 3])


def test_bits_mark_every_digest_and_few_others(spark):
    rows = spark.range(5000).select("id", exact_dedup.text_digest(F.col("id").cast("string")).alias("text_sha256"))
    got = exact_dedup.with_bits(rows, rows.filter("id % 9 = 4").select("text_sha256"))
    assert got.columns == ["id", "text_sha256", "hit"]
    assert got.filter("hit").count() == got.filter("id % 9 = 4").count() == got.filter("hit and id % 9 = 4").count()


def test_sharding_with_clashing_columns(spark):
    """Own columns named like the result's are replaced, whatever else there is."""
    names = [f"s{i}" for i in range(4)]
    rows = spark.createDataFrame([(1, "x", "y", "z"), (None, "x", None, "z")], "id long, slot string, shard string, slot_ string")
    got = sharding.place(rows, "id", names)
    assert sorted(got.columns) == ["id", "shard", "slot", "slot_"]
    plain = {r["id"]: (r["slot"], r["shard"]) for r in sharding.place(rows.select("id"), "id", names).collect()}
    assert {r["id"]: (r["slot"], r["shard"]) for r in got.collect()} == plain
    assert {r["slot_"] for r in got.collect()} == {"z"}
    by_slot = sharding.place(rows, "slot", names)
    assert by_slot.select("shard").distinct().count() == 1
