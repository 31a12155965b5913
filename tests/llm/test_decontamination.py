"""Pigeonhole edit matching against the plain recurrence."""

import random

import pytest

from pyspark.sql import functions as F

from shopflow.llm import decontamination as D
from shopflow.llm import queries
from tests.conftest import SF001
from tests.llm import cases


def closest(item: str, text: str) -> int:
    """Smallest edit distance of ``item`` to any passage of ``text``."""
    column = list(range(len(item) + 1))
    best = column[-1]
    for c in text:
        new = [0]
        for i in range(1, len(item) + 1):
            new.append(min(column[i] + 1, new[i - 1] + 1, column[i - 1] + (item[i - 1] != c)))
        column = new
        best = min(best, column[-1])
    return best


def test_myers_equals_the_recurrence():
    rnd = random.Random(5)
    for _ in range(300):
        item = "".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 40)))
        text = "".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 120)))
        if rnd.random() < 0.6:
            near = list(item)
            for _ in range(rnd.randint(0, 4)):
                near[rnd.randrange(len(near))] = rnd.choice("abc")
            text = text[:50] + "".join(near) + text[50:]
        budget = rnd.randint(0, 8)
        got = D.Pattern(1, item, budget).best(text)
        want = closest(item, text)
        assert (got[0] if got else None) == (want if want <= budget and want < len(item) else None)


def damaged(text: str, edits: int, rnd: random.Random) -> str:
    out = list(text)
    for _ in range(edits):
        at = rnd.randrange(len(out))
        out[at:at + 1] = rnd.choice([[], ["z"], [out[at], "z"]])
    return "".join(out)


def fixture():
    rnd = random.Random(9)
    items = [(i, cases.words(500 + i, rnd.randint(8, 40)).capitalize() + ".") for i in range(12)]
    items += [(50, None), (51, ""), (52, "short"), (53, items[0][1])]
    docs = []
    for d in range(40):
        text = cases.words(d, 60)
        if d % 2:
            item = items[d % 12][1]
            text += " " + damaged(item, rnd.randint(0, int(len(item) * 0.12)), rnd) + "\n" + cases.words(d + 900, 30)
        docs.append((d, text))
    return docs, items


def expected(docs, items):
    out = set()
    for d, text in docs:
        for i, item in items:
            own, whole = D.normalised(item), D.normalised(text)
            if len(own) >= D.LEAST:
                distance = closest(own, whole)
                if distance <= int(len(own) * D.ERRORS):
                    out.add((d, i, distance))
    return out


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 400])
def test_leaks_match_brute_force(spark, block_bytes):
    docs, items = fixture()
    rows = spark.createDataFrame([(d, t, "own") for d, t in docs], "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in D.leaks(rows, benchmark, block_bytes=block_bytes).collect()}
    want = expected(docs, items)
    assert got == want and any(x[2] for x in want)
    left = D.clean(rows, benchmark, block_bytes=block_bytes)
    assert left.columns == rows.columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {x[0] for x in want}


def test_short_items_match_whole_words(spark):
    items = [(1, "What is 2+2?"), (2, "法国的首都是哪里？"), (3, "Yes or no"), (4, "..."), (5, "Où?")]
    docs = [(1, "what is 2 2"), (2, "So: WHAT is (2 + 2)!"), (3, "what is 2 23 or somewhat is 2 2"), (4, "法国的首都是哪里？"),
            (5, "问题：法国的首都是哪里？答案"), (6, "yes or not, yes or no"), (7, "yes or now"), (8, "..."), (9, None),
            (10, "what is 2 3"), (11, "oùx où"), (12, "yes or nó")]
    want = {(1, 1, 0, 11), (2, 1, 0, 14), (4, 2, 0, 9), (5, 2, 0, 12), (6, 3, 0, 20), (11, 5, 0, 6)}
    # item 5 keeps its accent, its question mark does not count
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert {tuple(r) for r in D.leaks(rows, benchmark).collect()} == want
    assert {r.doc_id for r in D.clean(rows, benchmark).collect()} == {3, 7, 8, 9, 10, 12}


def test_query_finds_planted_passages(spark):
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op5_decontamination"](spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF001}/benchmark.parquet").collect()
    planted = {(d.doc_id, i.item_id) for d in docs for i in items
               if d.text and D.normalised(i.text) in D.normalised(d.text)}
    assert planted and planted <= got


def test_edges(spark):
    docs = cases.frame(spark, clash=True)
    benchmark = spark.createDataFrame([(1, cases.words(2, 60)), (2, cases.words(2, 60)), (3, None)],
                                      "item_id long, text string")
    got = D.leaks(docs, benchmark).collect()
    assert sorted((r.doc_id or -1, r.item_id) for r in got) == sorted(
        (d, i) for d in (5, 6, 7, 5, 5, -1) for i in (1, 2))
    assert D.clean(docs, benchmark).count() == len(cases.rows()) - 6
    assert D.leaks(docs.limit(0), benchmark).count() == 0
    assert D.clean(docs, benchmark.limit(0)).count() == len(cases.rows())


def test_short_items_within_their_budget():
    """13 to 19 characters allow one edit, between word borders; fewer none."""
    own = D.Matcher([(1, "machine learning"), (2, "tiny item")])
    found = {t: [(i, d) for i, d, _ in own.matches(t)] for t in (
        "The machine learning way", "the machinne-learning way", "machine learnin", "machine lexrnixg", "machinelearning",
        "unmachine learnings", "a tiny item", "a tinny item")}
    assert list(found.values()) == [[(1, 0)], [(1, 1)], [(1, 1)], [], [(1, 1)], [], [(2, 0)], []]


def test_item_ids_of_any_kind(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven")], "doc_id long, text string")
    for kind, key in (("smallint", 7), ("decimal(5,0)", 7), ("string", "x")):
        items = spark.createDataFrame([(str(key), "two three four five six")], "item_id string, text string") \
            .withColumn("item_id", F.col("item_id").cast(kind))
        got = D.leaks(docs, items).collect()
        assert [(r["doc_id"], str(r["item_id"]), r["distance"]) for r in got] == [(1, str(key), 0)]
