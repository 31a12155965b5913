"""MinHash near-deduplication by one-permutation hashing.

1. A document's set is its distinct word shingles (64-bit hashes). Documents
   with equal sets form a class, represented by its smallest id; everything
   below works on representatives.
2. One permutation, ``BINS`` bins: a bin's value is the smallest hash that
   falls into it; an empty bin borrows from the first non-empty bin in its own
   random order (optimal densification). Bins are banded; rows and bands
   follow from the threshold so that a pair at the threshold shares no band
   with probability under ``MISSED``.
3. Star-shaped edges: in each band bucket only (smallest id, member) is a
   candidate, so candidates are fewer than bucket rows whatever a bucket's
   size. Candidates are confirmed on the full sets.
4. A star can miss a link between two members that are both unlike the centre.
   Such a link matters only if its ends are in different components. Documents of
   buckets that still hold two or more components are therefore compared
   exactly: they are grouped by the buckets they share, groups are dealt into
   tiles of bounded size, and a tile counts all intersections of its two
   blocks by matrix products over strips of documents, emitting only confirmed
   links between components.
5. Components of all confirmed links (alternating stars over edge tables).

Sets are sent only for documents that share a bucket, copies are aggregated
before shuffling, and joins put the many on the side that adaptive execution
can split.

Defined cases: documents without words have an empty set and are linked with
nothing; shorter ones than a shingle have their whole sequence as one; a row
without id is linked with nothing, has no component and stays; rows that
repeat an id share its component; other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm import bloom
from shopflow.llm.common import cut, python_ready, sliced

BINS = 512
MISSED = 1e-6
#: shingles in one block of the exact comparison
BLOCK_SHINGLES = 100_000
#: documents on a side of one matrix of counts
STRIP = 1024
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
        0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]


class Words(dict):
    """Word -> 64-bit hash; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, size: int, words: Words) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    own = (text or "").encode().translate(_LOWER).split()  # ASCII white space
    if not own:
        return np.zeros(0, np.uint64)
    if len(own) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(own), seed=len(own))], np.uint64)
    codes = np.fromiter(map(words.__getitem__, own), np.uint64, len(own))
    n = len(codes) - size + 1
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * np.uint64(_MIX[0]) + codes[i:i + n]
    total ^= total >> np.uint64(32)
    total *= np.uint64(_MIX[1])
    total ^= total >> np.uint64(29)
    return np.unique(total)


def set_key(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def banding(threshold: float, missed: float = MISSED, bins: int = BINS) -> tuple[int, int]:
    """(rows, bands): as many rows a band as allow a pair at the threshold to
    share no band with probability of ``missed`` at most."""
    for rows in range(min(10, bins), 0, -1):
        bands = math.ceil(math.log(missed) / math.log1p(-threshold ** rows)) if threshold < 1 else 1
        if bands * rows <= min(bins, 260):
            return rows, bands
    return 1, bins


class Signer:
    def __init__(self, rows: int, bands: int) -> None:
        self.rows, self.bands = rows, bands
        random = np.random.default_rng(7)
        self.order = np.argsort(random.random((BINS, BINS)), axis=1)
        self.shift = np.uint64(64 - int(math.log2(BINS)))

    def signature(self, own: np.ndarray) -> np.ndarray:
        bins = (own >> self.shift).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))  # sorted: the smallest of its bin
        out = np.zeros(BINS, np.uint64)
        filled = np.zeros(BINS, bool)
        out[bins[first]], filled[bins[first]] = own[first], True
        empty = np.flatnonzero(~filled[:self.rows * self.bands])
        if len(empty):
            order = self.order[empty]
            donor = order[np.arange(len(empty)), np.argmax(filled[order], axis=1)]
            out[empty] = out[donor]
        return out

    def buckets(self, own: np.ndarray) -> np.ndarray:
        """One 64-bit key a band; the band's number is part of it."""
        used = self.signature(own)[:self.rows * self.bands].reshape(self.bands, self.rows)
        keys = np.arange(1, self.bands + 1, dtype=np.uint64) * np.uint64(_MIX[2])
        for row in range(self.rows):
            keys = (keys ^ used[:, row]) * np.uint64(_MIX[0])
            keys ^= keys >> np.uint64(31)
        return keys.view(np.int64)


def signed(docs: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, set_key (null for empty sets), buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, signer = Words(), Signer(rows, bands)
        for batch in sliced(batches):
            n, keys, buckets = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text, size, words)
                n.append(len(own))
                keys.append(set_key(own) if len(own) else None)
                buckets.append(signer.buckets(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(buckets, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_key", "buckets"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, buckets array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """doc_id and shingles (binary, sorted 64-bit hashes) of the wanted
    (doc_id, set_key). A bounded filter keeps other documents from being
    hashed and sent; the join is exact."""
    near = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    shared = docs.sparkSession.sparkContext.broadcast(bloom.covering(wanted.select("doc_id"), wanted.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in sliced(batches):
            batch = batch.filter(pa.array(shared.value.passes(batch.column(0).to_numpy())))
            sets = [shingles(t, size, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([set_key(s) for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "set_key", "shingles"])
    made = near.mapInArrow(run, "doc_id long, set_key binary, shingles binary")
    exact = made.join(wanted, ["doc_id", "set_key"], "left_semi")
    return exact.dropDuplicates(["doc_id", "set_key"]).select("doc_id", "shingles")


def common(a: bytes, b: bytes) -> tuple[int, int]:
    """Sizes of intersection and union of two packed sets."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.sort(np.concatenate([x, y]), kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared, len(x) + len(y) - shared


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) with 100 * intersection >= percent * union."""
    left = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    right = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                shared, union = common(x.as_py(), y.as_py())
                ok.append(100 * shared >= percent * union)
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    # sets differ in size by less than the threshold, or the pair is no link
    pairs = (edges.join(left, "b").join(right, "a")
             .filter((100 * F.least(F.length("set_a"), F.length("set_b"))
                      >= percent * F.greatest(F.length("set_a"), F.length("set_b"))))
             .select("a", "b", "set_a", "set_b"))
    return pairs.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node it reaches) of the edges (a, b), by
    alternating large and small stars until the edges no longer change. Each
    step is partial aggregates and joins over the edge table."""
    def same(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    # kept with b < a
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .filter("a <> b").distinct())
    mark = same(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        large = (both.join(low.select("a", F.least("a", "low").alias("low")), "a")
                 .filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("low").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")) \
            .select("e.*").filter("a <> b").distinct()
        after = cut(small)
        new = same(after)
        now = after
        if new == mark:
            break
        mark = new
    # now every edge points from a node to its component
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def labelled(rows: DataFrame, column: str, found: DataFrame) -> DataFrame:
    """``rows`` with the component of the node in ``column``."""
    return (rows.join(found.withColumnRenamed("node", column), column, "left")
            .withColumn("component", F.coalesce("component", column)))


def tiles(members: DataFrame, sets: DataFrame, percent: int,
          block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links (a, b) between different components among ``members`` (doc_id,
    cluster, component), which are compared within clusters. A cluster is dealt
    into blocks of about ``block_shingles``; every pair of blocks is a tile."""
    rows = members.join(sets, "doc_id")
    blocks = F.ceil(F.sum(F.length("shingles") / 8) / block_shingles).cast("int")
    dealt = (rows.join(rows.groupBy("cluster").agg(blocks.alias("n_blocks")), "cluster")
             .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("n_blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
             .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "doc_id", "component", "shingles"))

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = key[1].as_py(), key[2].as_py()
        table = pa.Table.from_batches(batches)
        ids, comps = table["doc_id"].to_numpy(), table["component"].to_numpy()
        sets_ = [np.frombuffer(x.as_py(), np.uint64) for x in table["shingles"]]
        block = table["block"].to_numpy()
        for a, b in strips(sets_, comps, np.flatnonzero(block == i), np.flatnonzero(block == j), percent):
            a, b = ids[a], ids[b]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()),
                                              pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])
    return dealt.groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long")


def linked(sets_: list[np.ndarray], comps: np.ndarray, left: np.ndarray, right: np.ndarray,
           percent: int, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Indices of linked pairs of different components, one of ``left`` and
    one of ``right``."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)), *strips(sets_, comps, left, right, percent, columns)]
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def strips(sets_: list[np.ndarray], comps: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int,
           columns: int = 4096, side: int = STRIP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of ``linked``, from ``side`` documents against ``side`` at a
    time, so that memory does not grow with the number of documents.
    Intersections are counted exactly by products of 0/1 matrices, ``columns``
    shingles at a time; shingles that the two sides do not share take no part."""
    if not len(left) or not len(right):
        return
    size = np.array([len(s) for s in sets_])
    code = np.unique(np.concatenate(sets_), return_inverse=True)[1]
    start = np.cumsum(size) - size

    def entries(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shingle, place in ``own``) of the documents, by shingle."""
        codes = np.concatenate([code[start[d]:start[d] + size[d]] for d in own])
        order = np.argsort(codes, kind="stable")
        return codes[order], np.repeat(np.arange(len(own)), size[own])[order]
    parts = [right[at:at + side] for at in range(0, len(right), side)]
    ready = [entries(two) for two in parts]
    for at in range(0, len(left), side):
        one = left[at:at + side]
        own = entries(one)
        for two, other in zip(parts, ready):
            shared = np.intersect1d(own[0], other[0])
            counts = np.zeros((len(one), len(two)), np.float32)
            for first in range(0, len(shared), columns):
                some = shared[first:first + columns]
                counts += ones(*own, some, len(one)) @ ones(*other, some, len(two)).T
            counts = counts.astype(np.int64)
            union = size[one][:, None] + size[two][None, :] - counts
            hit = (100 * counts >= percent * union) & (comps[one][:, None] != comps[two][None, :])
            x, y = np.nonzero(hit)
            if len(x):
                yield one[x], two[y]


def ones(codes: np.ndarray, rows: np.ndarray, some: np.ndarray, n: int) -> np.ndarray:
    """0/1 matrix: which of ``n`` documents hold which of the shingles ``some`` (sorted)."""
    a, b = np.searchsorted(codes, some[0]), np.searchsorted(codes, some[-1], "right")
    place = np.searchsorted(some, codes[a:b])
    held = some[place] == codes[a:b]
    matrix = np.zeros((n, len(some)), np.float32)
    matrix[rows[a:b][held], place[held]] = 1
    return matrix


def classify(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id, kept. Linked: 100 * intersection >= percent * union."""
    python_ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    base = cut(signed(docs, size, *banding(percent / 100)))
    known = base.filter(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    first = known.groupBy("set_key").agg(F.min(F.struct("doc_id", "buckets")).alias("first"))
    classes = cut(first.select("set_key", F.col("first.doc_id").alias("rep"), "first.buckets"))
    rows = classes.select("rep", "set_key", F.explode("buckets").alias("bucket"))
    centres = rows.groupBy("bucket").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    crowded = cut(rows.join(centres.drop("n"), "bucket"))
    sets = cut(sets_of(docs, crowded.select(F.col("rep").alias("doc_id"), "set_key").distinct(), size))
    stars = crowded.filter("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    links = cut(confirmed(stars, sets, percent))
    # an id that stands in several classes joins them
    repeated = (known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
                .join(known.select("doc_id", "set_key"), "doc_id").join(classes.select("set_key", "rep"), "set_key")
                .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    links = cut(links.unionByName(repeated))
    found = components(links)
    more = cut(missed_by_stars(crowded, found, sets, percent))
    if more.take(1):
        found = components(links.unionByName(more))
    whole = base.drop("buckets").join(classes.select("set_key", "rep"), "set_key", "left")
    whole = whole.withColumn("rep", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")))
    out = labelled(whole, "rep", found)
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def missed_by_stars(crowded: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components within buckets, compared exactly."""
    rows = cut(labelled(crowded.select("bucket", "centre", "rep"), "rep", found))
    open_ = (rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .filter("low <> high").select("bucket"))
    rows = cut(rows.join(open_, "bucket"))
    clusters = components(rows.select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct())
    members = labelled(rows.select("rep", F.col("component").alias("own")).distinct(), "rep", clusters)
    return tiles(members.select(F.col("rep").alias("doc_id"), F.col("component").alias("cluster"),
                                F.col("own").alias("component")), sets, percent)


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all columns, that stay: one document of each
    component. Only rows that a bounded filter suspects are joined."""
    marked = cut(classify(docs, size, percent))
    gone = marked.filter("not kept").select("doc_id").distinct()
    n = gone.count()
    if not n:
        return docs
    doc_id = F.col("doc_id").cast("long")
    suspect = F.coalesce(bloom.may_hold(gone, F.coalesce(doc_id, F.lit(0).cast("long")), n), F.lit(False)) \
        & doc_id.isNotNull()
    return docs.filter(~suspect).unionByName(docs.filter(suspect).join(gone, "doc_id", "left_anti").select(*docs.columns))
