"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from shopflow.llm import ranked_search as R
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(docs, items, limit=10):
    """item -> [(doc_id, score)] by the definition; docs and items are lists of
    (id, text)."""
    held = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    held = [(d, len(w), Counter(w)) for d, w in held if w]
    n_docs, total = len(held), sum(n for _, n, _ in held)
    df = Counter(w for _, _, c in held for w in c)
    out = {}
    for item, text in items:
        asked, scored = Counter(TERM.findall((text or "").translate(LOWER))), []
        for d, n, c in held:
            m = 25 + (75 * n * n_docs) // total
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m)) for w, times in asked.items() if w in c)
            if score > 0:
                scored.append((d, score))
        out[item] = sorted(scored, key=lambda x: (-x[1], math.inf if x[0] is None else x[0]))[:limit]
    return out


def texts(seed, n):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 4))) for _ in range(150)]
    base = [[rnd.choice(words) for _ in range(30)] for _ in range(8)]
    return [" ".join(rnd.choice(base)[:rnd.randint(5, 30)] + [rnd.choice(words) for _ in range(rnd.randint(0, 20))])
            for _ in range(n)]


@pytest.mark.parametrize("block", [1, 4, 32])
def test_blocks_are_skipped_without_losing_any(monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK", block)
    monkeypatch.setattr(R, "FIRST", 2 * block)
    docs, items = list(enumerate(texts(1, 400))), list(enumerate(texts(2, 25)))
    want = plain(docs, items)
    vocabulary = sorted({w for _, t in items for w in R.terms(t)})
    numbers = {t: i for i, t in enumerate(vocabulary)}
    counted = []
    for d, t in docs:
        found = Counter(numbers[w] for w in R.terms(t) if w in numbers)
        own = np.array(sorted(found), np.int32)
        counted.append((d, len(R.terms(t)), own.tobytes(), np.array([found[x] for x in own.tolist()], np.int32).tobytes()))
    holding = np.zeros(len(vocabulary), np.int64)
    for _, _, own, _ in counted:
        holding[np.frombuffer(own, np.int32)] += 1
    weight = R.weights(len(docs), holding)
    sketch = np.random.default_rng(0).normal(size=(len(vocabulary), 4)).astype(np.float32)
    total = sum(c[1] for c in counted)
    shards = [R.Shard(R._shard(counted[a:a + 150], len(docs), total, weight, sketch), len(vocabulary))
              for a in range(0, 400, 150)]
    met = skipped = 0
    for (item, _), (own, worth) in zip(items, R._queries([R.terms(t) for _, t in items], numbers, weight)):
        best = R.Best(10)
        for shard in shards:
            a, b = R.visit(shard, own, worth, best)
            met, skipped = met + a, skipped + b
        assert list(zip(best.ids.tolist(), best.scores.tolist())) == want[item]
    assert 0 < skipped < met


def test_summaries_bound_their_blocks():
    rnd = np.random.default_rng(5)
    worth = rnd.integers(0, 1_000_000, (40, 30))
    dense = (-(-worth // R.STEP)).astype(np.uint8)
    blocks = [np.arange(0, 13), np.arange(13, 40)]
    for block, summary in zip(blocks, R._summaries(dense, blocks)):
        assert (summary.astype(int) * R.STEP >= worth[block].max(axis=0)).all()


def rows(spark, docs, items, clash=False):
    frame = cases.frame(spark, docs, clash)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = {}
    for r in R.search(frame, asked).collect():
        found.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return {i: [x[1:] for x in sorted(v)] for i, v in found.items()}, found


def test_edges(spark):
    docs = cases.rows()
    items = [(1, cases.words(2, 60)), (2, "A b C tail"), (3, None), (4, " ., "), (5, "none_of-these0"), (6, "É é 漢字"),
             (7, cases.words(1, 20_000)), (7, cases.words(1, 20_000)), (None, "one words")]
    want = {i: v for i, v in plain([(r[0], r[1]) for r in docs], dict(items).items()).items() if v}
    for clash in (False, True):
        got, found = rows(spark, docs, items, clash)
        assert got == want
        assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in found.values())
    assert rows(spark, [], items)[0] == {} and rows(spark, docs, [])[0] == {}


def test_items_in_batches(spark, monkeypatch):
    monkeypatch.setattr(R, "MOST_TERMS", 60)
    docs = [(i, t, None, None, None) for i, t in enumerate(texts(3, 120))]
    items = list(enumerate(texts(4, 6)))
    assert len(list(R._batches(spark.createDataFrame(items, "item_id long, text string")))) > 1
    assert rows(spark, docs, items)[0] == plain([(d[0], d[1]) for d in docs], items)
