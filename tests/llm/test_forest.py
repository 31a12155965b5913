"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopflow.llm import prefix_forest as P
from shopflow.llm import queries
from tests.conftest import SF01


def plain(ids, vectors, asked, k):
    """query -> [(vec_id, score)], all compared."""
    out = {}
    for i in asked:
        scores = vectors @ vectors[ids.index(i)]
        order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-scores[j], ids[j]))[:k]
        out[i] = [(ids[j], scores[j]) for j in order]
    return out


def near(spark, rows, k=P.K, clash=False, step=20):
    frame = spark.createDataFrame(rows, "vec_id long, vec array<float>").repartition(3)
    if clash:
        frame = frame.select("*", *[F.lit("own").alias(c) for c in ("rep", "members", "asked", "place", "score", "rank")])
    found = {}
    for r in P.search(frame, F.col("vec_id") % step == 0, k).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [x[1:] for x in sorted(v)] for q, v in found.items()}


def recall(got, want):
    pairs = [(len({x for x, _ in got.get(q, [])} & {x for x, _ in v}), len(v)) for q, v in want.items()]
    return sum(a for a, _ in pairs) / sum(b for _, b in pairs)


def test_query_recall(spark):
    table = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = [r[0] for r in table], np.array([r[1] for r in table], np.float64)
    want = plain(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    got = {}
    for r in queries.QUERIES["op13_prefix_forest"](spark, SF01).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, 21))
        order = [(-s, v) for _, v, s in found]
        assert order == sorted(order)
        for _, v, s in found:
            assert s == pytest.approx(float(vectors[ids.index(q)] @ vectors[ids.index(v)]), abs=1e-12)
    assert recall({q: [x[1:] for x in v] for q, v in got.items()}, want) >= 0.9


@pytest.mark.parametrize("kind", ["clusters", "lengths"])
def test_recall_of_other_vectors(spark, kind):
    """Dense clusters; vectors of very different lengths (largest inner product
    is not the least angle)."""
    rng = np.random.default_rng(7)
    if kind == "clusters":
        vectors = rng.normal(size=(40, 16))[rng.integers(0, 40, 1500)] + 0.05 * rng.normal(size=(1500, 16))
    else:
        vectors = rng.normal(size=(1500, 16)) * rng.uniform(0.2, 3, size=(1500, 1))
    vectors = vectors.astype(np.float32).astype(np.float64)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    want = plain(list(range(1500)), vectors, range(0, 1500, 20), 20)
    assert recall(near(spark, rows), want) >= 0.9


def test_copies_and_ties(spark):
    """A third of all rows is one vector: the smallest ids come first, also for
    queries that are among the copies."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(240, 8)).astype(np.float32).astype(np.float64)
    vectors[:80] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = near(spark, rows + rows[:5], clash=True)
    assert [v for v, _ in got[0]] == list(range(1, 21))
    assert [v for v, _ in got[20]] == list(range(0, 20))
    assert recall(got, plain(list(range(240)), vectors, range(0, 240, 20), 20)) >= 0.9


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [-1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 1.0, 1.0]), (None, [9.0, 9.0]), (20, None), (40, [0.0, -0.0]), (1, [2.0, 1.0])]
    assert near(spark, rows) == {0: [(1, 2.0), (2, -1.0)]}
    assert near(spark, rows, k=1) == {0: [(1, 2.0)]}
    assert near(spark, [(0, [1.0])]) == {}
    assert near(spark, []) == {} and near(spark, [(0, None)]) == {}
    assert near(spark, [(1, [1.0]), (2, [2.0])]) == {}


def test_ranges_are_prefix_ranges():
    rng = np.random.default_rng(9)
    bits = rng.integers(0, 2 ** 64, 500, dtype=np.uint64)
    bits[:200] &= np.uint64(0xFFF)   # a lump
    bucket = P.Bucket([bits], [np.arange(500)], [np.zeros((500, 1))])
    asked = np.concatenate([bits[:50], rng.integers(0, 2 ** 64, 50, dtype=np.uint64)])
    for level in (0, 1, 7, 52, 64):
        low, high = bucket.range(asked, np.full(100, level))
        for q, a, b in zip(asked.tolist(), low, high):
            assert b - a == sum(x >> (64 - level) == q >> (64 - level) for x in bits.tolist())
    low, high = bucket.descended(asked, np.full(100, 4), 4, 10)
    assert (high - low)[:50].min() >= 10 and (high - low)[:50].max() < 200
