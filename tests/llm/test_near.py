"""Near-deduplication against brute force over all pairs."""

import random
import re
import tracemalloc

import numpy as np
import pytest

from shopflow.llm import near_dedup as N
from shopflow.llm import queries
from tests.conftest import SF001
from tests.llm import cases

UPPER = {c: c + 32 for c in range(65, 91)}


def plain(docs, size, percent):
    """doc_id -> (n_shingles, component) of distinct ids."""
    sets = {}
    for d, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
        sets[d] = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def edited(text, edits, rnd):
    words = text.split()
    for _ in range(edits):
        at = rnd.randrange(len(words))
        words[at] = rnd.choice(["Zed", "zee", words[at] + "x"])
    return " ".join(words)


def families():
    """Bases with many copies on both sides of the threshold, and chains."""
    rnd = random.Random(8)
    data, d = [], 0
    for base in range(4):
        text = cases.words(base, 150)
        for _ in range(40):
            data.append((d, edited(text, rnd.randint(0, 9), rnd)))
            d += 1
    text = cases.words(77, 120)
    for _ in range(25):
        text = edited(text, 2, rnd)
        data.append((d, text.upper() if d % 2 else text))
        d += 1
    data += [(1000 + i, cases.words(i, 5 + i)) for i in range(30)] + [(2000, None), (2001, ""), (2002, "a b"), (2003, "A  b")]
    data += [(3000 + i, data[3][1]) for i in range(80)]  # a third are one text
    return data


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80), (1, 100)])
def test_matches_brute_force(spark, size, percent):
    data = families()
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.classify(docs, size, percent).collect()}
    want = plain(data, size, percent)
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}


def test_tiles_find_what_stars_miss(spark, monkeypatch):
    """Small tiles and no star links at all still give every link."""
    data = families()[:60]
    words = N.Words()
    sets = spark.createDataFrame([(d, bytearray(N.shingles(t, 3, words).tobytes())) for d, t in data],
                                 "doc_id long, shingles binary")
    members = spark.createDataFrame([(d, 0, d) for d, _ in data], "doc_id long, cluster long, component long")
    links = {(r.a, r.b) for r in N.tiles(members, sets, 85, 1500).collect()}
    own = dict(data)
    want = set()
    for a in own:
        for b in own:
            if a < b and plain([(a, own[a]), (b, own[b])], 3, 85)[b][1] == a:
                want.add((a, b))
    assert links == want and want


def test_many_short_documents_in_a_block(spark):
    """Every link, over several strips, without an array of documents x documents."""
    rnd = np.random.default_rng(4)
    sets = [np.unique(rnd.integers(0, 60, 6).astype(np.uint64)) for _ in range(250)]
    comps, every = rnd.integers(0, 40, 250), np.arange(250)
    want = {(a, b) for a in range(250) for b in range(250) if comps[a] != comps[b]
            and 100 * len(np.intersect1d(sets[a], sets[b])) >= 40 * len(np.union1d(sets[a], sets[b]))}
    for left, right in ((every, every), (every[:90], every[90:])):
        got = [(a, b) for x, y in N.strips(sets, comps, left, right, 40, columns=7, side=32)
               for a, b in zip(x.tolist(), y.tolist())]
        assert len(got) == len(set(got)) and want
        assert set(got) == {(a, b) for a, b in want if a in set(left.tolist()) and b in set(right.tolist())}
    # 6,000 texts round one hot phrase: less memory than one array of 6,000 x 6,000 numbers
    sets = [np.array([1, 2, 3, 10 + 2 * i, 11 + 2 * i], np.uint64) for i in range(6000)]
    sets[5999] = sets[0]
    tracemalloc.start()
    try:
        a, b = N.linked(sets, np.arange(6000), np.arange(6000), np.arange(6000), 80)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert set(zip(a.tolist(), b.tolist())) == {(0, 5999), (5999, 0)}
    assert peak < 6000 * 6000 * 4


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op10_near_dedup"](spark, SF001).collect()}
    assert got == plain(docs, 3, 85)


def test_edges(spark):
    data = cases.rows()
    docs = cases.frame(spark, clash=True)
    got = N.classify(docs, 3, 85).collect()
    assert len(got) == len(data)
    want = plain([(r[0], r[1]) for r in data if r[0] is not None], 3, 85)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
    left = N.keep_one(docs, 3, 85)
    assert left.columns == docs.columns
    kept = [r.doc_id for r in left.collect()]
    assert kept.count(None) == 2 and {d for d in kept if d is not None} == {c for _, c in want.values()}
    assert N.classify(docs.limit(0)).count() == 0 and N.keep_one(docs.limit(0)).count() == 0


def test_an_id_in_two_classes_joins_them(spark):
    a, b = cases.words(1, 40), cases.words(2, 40)
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (4, cases.words(3, 40))], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in N.classify(docs).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_banding_and_densification():
    for threshold in (0.5, 0.8, 0.85, 0.95):
        rows, bands = N.banding(threshold)
        assert rows * bands <= N.BINS and (1 - threshold ** rows) ** bands <= N.MISSED
    signer = N.Signer(8, 32)
    one = signer.signature(np.array([5], np.uint64))
    assert set(one[:256].tolist()) == {5}
    rnd = np.random.default_rng(0)
    own = np.unique(rnd.integers(0, 2 ** 63, 400).astype(np.uint64) * np.uint64(2))
    far = np.unique(np.concatenate([own[:380], rnd.integers(0, 2 ** 63, 20).astype(np.uint64)]))
    same = (signer.signature(own)[:256] == signer.signature(far)[:256]).mean()
    assert abs(same - 380 / 420) < 0.08


def test_components_of_a_hub(spark):
    edges = [(n, 5) for n in range(6, 3000)] + [(5, 2), (2, 1), (4000, 2999), (7000, 8000)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in N.components(frame).collect()}
    assert found == {n: 1 for n in [2, *range(5, 3000), 4000]} | {8000: 7000}


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(500, 600)]
    got = {r.node: r.component for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    assert all(got.get(x, x) == find(x) for x in up)
