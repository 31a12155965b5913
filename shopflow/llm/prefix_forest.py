"""Approximate nearest neighbours by inner product: a forest of hash prefixes.

A tree gives every vector a string of 64 bits, the sides of 64 orthogonal
planes it lies on, and keeps the strings sorted, so the vectors that share a
prefix with a query are one range of the sorted array. A query descends in all
trees to its longest prefixes and ascends from there, in all trees at once, one
bit a step, until the ranges of all trees together hold enough vectors. All
vectors of these ranges are candidates and are compared exactly, in double
precision.

*Inner products.* Planes separate directions, so vectors get one more
coordinate that fills all up to the longest vector's length (queries get 0);
then the nearest direction is the largest inner product.

*How many are enough* is measured, not given: at most ``SAMPLE`` queries are
compared with all vectors, and the smallest number of candidates is taken with
which the forest finds ``RECALL`` of their true neighbours. Vectors without any
structure thus get deep scans, clustered ones short ones.

*Distribution.* Vectors of equal value are one class, indexed once (a result
needs at most ``k`` + 1 of a class, those with the smallest ids). A tree is cut
by prefix into buckets of about ``BUCKET`` vectors; a bucket that a lump of near
vectors overfills is dealt into chunks by id. Every bucket or chunk is one
sorted array in one task; a query goes to those that its range touches, and
streams past. How many vectors lie below each prefix is known from one table of
at most ``TREES`` x 2 ** ``DEPTH`` counts, whatever the corpus; a query whose
range at that depth still holds more than its share descends further within the
bucket. No range is cut off.

Defined cases: rows whose id or vector is null, or whose vector is empty, zero
or holds null or non-finite components, take no part; neither do vectors of
another length than most. Repeated rows count once. A query never finds a row of
its own id. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.common import cut, pieces, python_ready

K = 20
TREES, BITS = 16, 64
#: vectors in a bucket, about, and in a chunk of an overfull one at most
BUCKET = 4096
#: prefixes are counted down to this many bits at most (16 x 65,536 counts)
DEPTH = 16
#: queries compared with all vectors, and the share of neighbours to be found
SAMPLE, RECALL = 200, 0.95
SEED = 13


# --- vectors and strings ------------------------------------------------------

def classes(vectors: DataFrame, is_query: Column, k: int = K) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (``rep``, ``vec``, ``members``: the k + 1 smallest ids,
    ``asked``: whether a query has it) and the queries (``query_id``, ``rep``).
    ``vectors``: ``vec_id, vec``."""
    vec = F.col("vec")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0))
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("vec") == (size["n"] if size else 0)).select("vec_id", "vec").distinct()
    first = Window.partitionBy("vec").orderBy("vec_id")
    own = (rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
           .groupBy("vec").agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("members")))
    asking = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "vec")
    own = own.join(asking.select("vec").distinct().withColumn("asked", F.lit(True)), "vec", "left")
    own = cut(own.select("rep", "vec", "members", F.coalesce("asked", F.lit(False)).alias("asked")))
    return own, asking.join(own.select("vec", "rep"), "vec").select("query_id", "rep")


def planes(dim: int) -> np.ndarray:
    """TREES x (dim + 1) x BITS, orthogonal within a tree as far as there are
    dimensions."""
    rng = np.random.default_rng(SEED)
    out = np.empty((TREES, dim + 1, BITS))
    for t in range(TREES):
        for at in range(0, BITS, dim + 1):
            part = np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0]
            out[t, :, at:at + dim + 1] = part[:, :BITS - at]
    return out


def strings(vectors: np.ndarray, extra: np.ndarray, tree_planes: np.ndarray) -> np.ndarray:
    """The bit strings (n x TREES numbers of 64 bits) of vectors that got one
    more coordinate."""
    full = np.column_stack([vectors, extra])
    value = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
    return np.stack([((full @ p > 0) * value).sum(axis=1, dtype=np.uint64) for p in tree_planes], axis=1)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def hashed(own: DataFrame, dim: int, longest: float) -> DataFrame:
    """``rep, vec, asked`` with ``own_bits`` (its strings as an indexed vector)
    and ``query_bits`` (as a query; null if none asks)."""
    shared = own.sparkSession.sparkContext.broadcast(planes(dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column("vec"))
            square = (vectors ** 2).sum(axis=1)
            stored = strings(vectors, np.sqrt(np.maximum(longest ** 2 - square, 0)), shared.value)
            asking = strings(vectors, np.zeros(len(vectors)), shared.value)
            asked = batch.column("asked").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("vec"), pa.array([x.tobytes() for x in stored], pa.binary()),
                 pa.array([x.tobytes() if a else None for x, a in zip(asking, asked)], pa.binary())],
                ["rep", "vec", "own_bits", "query_bits"])
    kind = own.schema["vec"].dataType.simpleString()
    return own.select("rep", "vec", "asked").mapInArrow(
        run, f"rep bigint, vec {kind}, own_bits binary, query_bits binary")


def unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, TREES)


# --- how far to ascend ----------------------------------------------------------

class Counts:
    """How many vectors lie below every prefix of at most ``depth`` bits."""

    def __init__(self, table: np.ndarray) -> None:
        self.depth = int(table.shape[1]).bit_length() - 1
        self.below = np.concatenate([np.zeros((TREES, 1), np.int64), np.cumsum(table, axis=1)], axis=1)

    def ranges(self, bits: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 prefix of full depth below each string's prefix
        of ``level`` bits."""
        at = (bits >> np.uint64(BITS - level)).astype(np.int64) if level else np.zeros(bits.shape, np.int64)
        return at << (self.depth - level), (at + 1) << (self.depth - level)

    def sizes(self, bits: np.ndarray, level: int) -> np.ndarray:
        low, high = self.ranges(bits, level)
        trees = np.arange(TREES)
        return self.below[trees, high] - self.below[trees, low]

    def levels(self, bits: np.ndarray, enough: int) -> np.ndarray:
        """The level at which each query's ascent ends (0: all vectors)."""
        out = np.zeros(len(bits), np.int64)
        for level in range(1, self.depth + 1):
            out[self.sizes(bits, level).sum(axis=1) >= enough] = level
        return out


def counted(table: DataFrame, depth: int) -> Counts:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(TREES << depth, np.int64)
        for batch in batches:
            at = (unpacked(batch.column("own_bits")) >> np.uint64(BITS - depth)).astype(np.int64)
            found += np.bincount((at + (np.arange(TREES) << depth)).ravel(), minlength=len(found))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some], pa.int64())], ["at", "n"])
    rows = table.select("own_bits").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(TREES << depth, np.int64)
    for at, n in rows.collect():   # at most TREES << DEPTH rows
        out[at] = n
    return Counts(out.reshape(TREES, -1))


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest numbers of every row."""
    k = min(k, scores.shape[1])
    columns = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return np.repeat(np.arange(len(scores)), k), columns.ravel()


def calibrated(table: DataFrame, counts: Counts, k: int) -> int:
    """The smallest number of candidates (of a ladder of eight steps to a doubling)
    that finds RECALL of the sample's true neighbours."""
    sample = (table.filter("query_bits IS NOT NULL").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE)
              .select("rep", "vec", "query_bits").collect())
    if not sample:
        return 1
    reps = np.array([r["rep"] for r in sample])
    bits = np.frombuffer(b"".join(r["query_bits"] for r in sample), np.uint64).reshape(-1, TREES)
    shared = table.sparkSession.sparkContext.broadcast((reps, np.array([r["vec"] for r in sample], np.float64), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reps, vectors, bits = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("rep").to_numpy()
            scores = vectors @ matrix(batch.column("vec")).T
            scores[reps[:, None] == own[None]] = -np.inf
            row, column = best(scores, k)
            differ = (unpacked(batch.column("own_bits"))[column] ^ bits[row]).astype(np.float64)
            # shared bits of the longest prefix in any tree
            depth = BITS - np.frexp(differ.min(axis=1))[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), pa.array(own[column], pa.int64()), pa.array(scores[row, column]),
                 pa.array(depth.astype(np.int64))], ["row", "rep", "score", "depth"])
    near = table.select("rep", "vec", "own_bits").mapInArrow(run, "row bigint, rep bigint, score double, depth bigint")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "rep")
    near = (near.filter(F.col("score") > float("-inf")).withColumn("place", F.row_number().over(order))
            .filter(F.col("place") <= k).select("row", "depth").collect())
    if not near:
        return 1
    row, depth = np.array(near).T
    most = int(counts.below[:, -1].sum())
    ladder = [int(2 ** (i / 8)) for i in range(8 * most.bit_length())] + [most]
    for enough in ladder:
        if np.mean(depth >= counts.levels(bits, enough)[row]) >= RECALL:
            return enough
    return most


# --- search -------------------------------------------------------------------

def routed(table: DataFrame, counts: Counts, enough: int, cut_at: int) -> DataFrame:
    """``place`` (tree, bucket and chunk), ``kind`` (0 vector, 1 query),
    ``bits`` in that tree, ``level`` of a query, ``rep, vec``."""
    prefixes = np.arange(1 << cut_at) << (counts.depth - cut_at)
    step = 1 << (counts.depth - cut_at)
    chunks = np.maximum(1, -(-(counts.below[:, prefixes + step] - counts.below[:, prefixes]) // (2 * BUCKET)))
    first = np.concatenate([[0], np.cumsum(chunks.ravel())])
    shared = table.sparkSession.sparkContext.broadcast((counts, chunks.ravel(), first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, chunks, first = shared.value

        def rows(batch: pa.RecordBatch, row, place, kind: int, bits, level) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(place, pa.int64()), pa.array(np.full(len(row), kind), pa.int32()),
                 pa.array(bits.view(np.int64)), pa.array(level, pa.int32()),
                 batch.column("rep").take(pa.array(row)), batch.column("vec").take(pa.array(row))],
                ["place", "kind", "bits", "level", "rep", "vec"])
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                bits, n = unpacked(batch.column("own_bits")), batch.num_rows
                bucket = (bits >> np.uint64(BITS - cut_at)).astype(np.int64) + (np.arange(TREES) << cut_at) \
                    if cut_at else np.tile(np.arange(TREES), (n, 1))
                own = batch.column("rep").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                chunk = (own >> np.uint64(33)).astype(np.int64)[:, None] % chunks[bucket]
                yield rows(batch, np.repeat(np.arange(n), TREES), (first[bucket] + chunk).ravel(), 0, bits.ravel(),
                           np.zeros(n * TREES, np.int32))
                asks = np.flatnonzero([x is not None for x in batch.column("query_bits").to_pylist()])
                if not len(asks):
                    continue
                bits = unpacked(batch.column("query_bits").take(pa.array(asks)))
                level = counts.levels(bits, enough)
                for t in range(TREES):
                    at = (bits[:, t] >> np.uint64(1)) >> np.uint64(BITS - 1 - cut_at)
                    up = np.maximum(cut_at - level, 0)
                    low = ((at.astype(np.int64) >> up) << up) + (t << cut_at)
                    a, b = first[low], first[low + (1 << up)]
                    row = np.repeat(np.arange(len(asks)), b - a)
                    for piece in np.array_split(np.arange(len(row)), pieces(len(row), 2000)):
                        r = row[piece]
                        inside = piece - (np.cumsum(b - a) - (b - a))[r]
                        yield rows(batch, asks[r], a[r] + inside, 1, np.ascontiguousarray(bits[r, t]),
                                   level[r].astype(np.int32))
    kind = table.schema["vec"].dataType.simpleString()
    return table.select("rep", "vec", "own_bits", "query_bits").mapInArrow(
        run, f"place bigint, kind int, bits bigint, level int, rep bigint, vec {kind}")


class Bucket:
    """One sorted array of strings with its vectors."""

    def __init__(self, bits: list[np.ndarray], reps: list[np.ndarray], vectors: list[np.ndarray]) -> None:
        bits = np.concatenate(bits)
        order = np.argsort(bits, kind="stable")
        self.bits, self.reps = bits[order], np.concatenate(reps)[order]
        self.vectors = np.concatenate(vectors)[order]

    def range(self, bits: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each query the range that shares ``level`` bits with it."""
        free = (np.uint64(1) << (BITS - np.maximum(level, 1)).astype(np.uint64)) - np.uint64(1)
        free[level == 0] = np.uint64(2 ** 64 - 1)
        return (np.searchsorted(self.bits, bits & ~free, "left"), np.searchsorted(self.bits, bits | free, "right"))

    def descended(self, bits: np.ndarray, level: np.ndarray, depth: int, share: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranges; those at the deepest counted level go on down to the longest
        prefix that still holds ``share`` vectors."""
        low, high = self.range(bits, level)
        open_, at = (level == depth) & (high - low > share), level.copy()
        while open_.any():
            at[open_] += 1
            open_ &= at < BITS
            a, b = self.range(bits, np.minimum(at, BITS - 1))
            open_ &= b - a >= share
            low, high = np.where(open_, a, low), np.where(open_, b, high)
        return low, high


def compared(batches: Iterator[pa.RecordBatch], depth: int, share: int, k: int) -> Iterator[pa.RecordBatch]:
    """Streams sorted places (vectors, then queries): the k + 1 best of every
    query's range in a place."""
    place, parts, bucket = None, ([], [], []), None
    for batch in batches:
        places, kinds = (batch.column(c).to_numpy() for c in ("place", "kind"))
        ends = np.flatnonzero((np.diff(places) != 0) | (np.diff(kinds) != 0)) + 1
        for start, end in zip([0, *ends], [*ends, len(places)]):
            if start == end:
                continue
            run = batch.slice(start, end - start)
            bits = run.column("bits").to_numpy().view(np.uint64)
            reps, vectors = run.column("rep").to_numpy(), matrix(run.column("vec"))
            if places[start] != place:
                place, parts, bucket = places[start], ([], [], []), None
            if kinds[start] == 0:
                for held, new in zip(parts, (bits, reps, vectors)):
                    held.append(new)
                continue
            if not parts[0]:
                continue
            bucket = bucket or Bucket(*parts)
            low, high = bucket.descended(bits, run.column("level").to_numpy().astype(np.int64), depth, share)
            order = np.lexsort((high, low))
            cuts = np.flatnonzero((np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)) + 1
            for group in np.split(order, cuts):
                a, b = low[group[0]], high[group[0]]
                for some in np.array_split(group, pieces(len(group), 256)):
                    if a == b:
                        continue
                    scores = vectors[some] @ bucket.vectors[a:b].T
                    row, column = best(scores, k + 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reps[some][row], pa.int64()), pa.array(bucket.reps[a:b][column], pa.int64()),
                         pa.array(scores[row, column])], ["asker", "rep", "score"])


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: of every row that ``is_query`` (a
    condition on ``vec_id``) holds for, the k nearest that the forest finds.
    ``vectors``: ``vec_id`` (whole numbers) and ``vec`` (arrays of numbers)."""
    spark = vectors.sparkSession
    python_ready(spark)
    vectors = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "vec")
    own, queries = classes(vectors, is_query, k)
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    n, dim, longest = own.agg(F.count("rep"), F.max(F.size("vec")), F.sqrt(F.max(square))).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    table = cut(hashed(own, dim, longest))
    depth = min(DEPTH, max(4, math.ceil(math.log2(n / 64))))
    counts = counted(table, depth)
    enough = calibrated(table, counts, k)
    cut_at = min(depth, max(0, round(math.log2(n / BUCKET))))
    share = pieces(enough, TREES)
    places = routed(table, counts, enough, cut_at)
    kind = table.schema["vec"].dataType.simpleString()
    found = (places.repartition("place").sortWithinPartitions("place", "kind")
             .mapInArrow(lambda b: compared(b, depth, share, k), "asker bigint, rep bigint, score double"))
    near = found.groupBy("asker", "rep").agg(F.max("score").alias("score"))
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "rep")
    near = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    # classes to rows: of each asking class its k + 1 nearest rows, of each query the k that are not its own
    rows = near.join(own.select("rep", "members"), "rep").select("asker", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id")
    rows = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    lists = rows.groupBy("asker").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (queries.join(lists, queries["rep"] == lists["asker"])
            .select("query_id", F.posexplode(others).alias("rank", "x"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", "x.score"))
