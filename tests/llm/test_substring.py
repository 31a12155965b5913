"""Substring deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from shopflow.llm import queries
from shopflow.llm import substring_dedup as S
from tests.conftest import SF001
from tests.llm import cases


def plain(docs, window):
    """(doc_id, n_words, n_removed, text) by the definition."""
    seen, out = set(), []
    for d, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        out.append((d, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def check(spark, data, window, chunk_bytes, schema="doc_id long, text string"):
    got = S.remove_repeats(spark.createDataFrame(data, schema), window, chunk_bytes).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == Counter(plain(data, window))
    assert all(sum(x["end"] - x["first"] for x in r.removed) == r.n_removed for r in got)


@pytest.mark.parametrize("chunk_bytes", [300, 2000, 1 << 20])
def test_few_words_repeat_everywhere(spark, chunk_bytes):
    rnd = random.Random(chunk_bytes)
    data = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 40)))) for i in range(60)]
    data += [(100, "a " * 70), (101, "a " * 50 + "b " + "a " * 50), (102, "a b " * 40)]
    check(spark, data, 8, chunk_bytes)


@pytest.mark.parametrize("chunk_bytes", [1500, 1 << 20])
def test_passages_shared_by_many(spark, chunk_bytes):
    rnd = random.Random(4)
    passages = [cases.words(k, rnd.randint(19, 60)) for k in range(6)]
    data = []
    for i in range(80):
        parts = [cases.words(1000 + i, rnd.randint(0, 30)), rnd.choice(passages), cases.words(2000 + i, rnd.randint(0, 30))]
        if i % 3 == 0:
            parts.append(passages[0])  # a third of all rows
        data.append((i, " ".join(parts)))
    check(spark, data, 20, chunk_bytes)


def test_edges(spark):
    data = [(r[0], r[1]) for r in cases.rows()]
    check(spark, data, 20, 50_000)
    clash = S.remove_repeats(cases.frame(spark, clash=True), 20, 50_000)
    assert clash.count() == len(data)
    assert S.remove_repeats(cases.frame(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        S.remove_repeats(cases.frame(spark), 7)


def test_rows_without_id_are_spread(spark):
    """400 rows without an id lie in many chunks; their order is that of
    Spark's hash of the text, then of the text."""
    rnd = random.Random(9)
    passages = [cases.words(k, 30) for k in range(5)]
    texts = [" ".join([cases.words(i, rnd.randint(0, 20)), rnd.choice(passages), cases.words(i + 500, 3)])
             for i in range(400)]
    texts += texts[:3]
    frame = spark.createDataFrame([(None, t) for t in texts] + [(7, texts[9]), (8, None)], "doc_id long, text string")
    hashes = {r.text: r.h for r in frame.selectExpr("text", "xxhash64(text) as h").collect()}
    assert all(S.text_order(None, t) == hashes[t] for t in texts)
    got = S.remove_repeats(frame, 20, 5000).collect()
    rank = {t: i for i, t in enumerate(sorted(set(texts), key=lambda t: (hashes[t], t)))}
    in_order = sorted(texts, key=rank.get)
    want = plain([(0, texts[9])] + [(i + 1, t) for i, t in enumerate(in_order)], 20)
    ids = [7] + [None] * len(texts)
    assert Counter((r.doc_id, r.n_removed, r.text) for r in got) == Counter(
        [(8, 0, "")] + [(d, w[2], w[3]) for d, w in zip(ids, want)])


def test_more_partitions_than_usual(spark):
    """Far more chunks than shuffle partitions, and fewer buckets than chunks."""
    data = [(i, cases.words(i % 90, 60)) for i in range(200)]
    check(spark, data, 20, 600)


def test_equal_key_of_other_words_is_no_repeat():
    one, two = np.array([3, 5], np.uint64), np.array([3, 5, 9], np.uint64)
    zero = [np.zeros(2, np.int64), np.zeros(3, np.int64)]
    found = S.earlier_elsewhere([one, two], [np.array([1, 1], np.uint64), np.array([2, 1, 1], np.uint64)],
                                [np.array([4, 4]), np.array([5, 3, 5])], zero)
    assert [x.tolist() for x in found] == [[5], []]


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = {d: (n, gone, hashlib.sha256(text.encode()).hexdigest()) for d, n, gone, text in plain(docs, 20)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in queries.QUERIES["op2_substring_dedup"](spark, SF001).collect()}
    assert got == want


def test_packing():
    rnd = np.random.default_rng(2)
    for n, high in ((0, 10), (5, 2 ** 63), (4000, 2 ** 46), (300, 2 ** 20)):
        values = np.sort(rnd.integers(0, high, n).astype(np.uint64))
        assert (S.unpacked(S.packed(values)) == values).all()
