"""Language identification and toxicity: held-out accuracy and edges."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopflow.llm import language_id, queries, toxicity
from tests.conftest import SF001, SF01
from tests.llm import cases


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_language_accuracy(spark):
    got = queries.QUERIES["op8_language_id"](spark, SF01).toPandas()
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs)
    assert (both.held_out == both.doc_id.map(held_out)).all()
    own = both[both.held_out]
    assert (own.lang == own.lang_pred).mean() > 0.97
    assert both.score.between(0, 1).all()


def test_mixture_selects_languages():
    model = language_id.Model(["x", "y", "z"], np.zeros((language_id.BUCKETS, 3), np.float32))
    fit = np.full((300, 3), 1e-4)
    fit[:200, 0], fit[200:, 1] = 1, 1
    chosen, share = model.select(fit)
    assert chosen == [0, 1]
    assert np.allclose(share, [2 / 3, 1 / 3], atol=1e-3)
    # a word or two of another language is not worth a parameter
    fit[:, 1], fit[:, 0] = 0.5, 1
    assert model.select(fit)[0] == [0]


def test_language_edges(spark):
    docs = cases.frame(spark, clash=True)
    model = language_id.train(docs)
    got = {(r.doc_id, r.lang_pred, round(r.score, 6)) for r in language_id.predict(docs, model).collect()}
    by_id = {}
    for d, lang, s in got:
        by_id.setdefault(d, set()).add((lang, s))
    texts = {r[0]: r[1] for r in cases.rows() if r[0] is not None}
    for d, found in by_id.items():
        if d is None:
            continue
        (lang, s), = found
        has_letter = any(c.isalpha() for c in texts[d] or "")
        assert (lang == "und") == (not has_letter)
        assert 0 <= s <= 1
    assert language_id.predict(docs.limit(0), model).count() == 0
    nothing = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}


def test_small_word_tables_change_nothing(spark):
    docs = cases.frame(spark)
    model = language_id.train(docs)
    texts = [r[1] for r in cases.rows()]
    whole = model.predict(texts)
    small = language_id.Model(model.names, model.logs)
    small.most = 10
    assert [x for x, _ in small.predict(texts)] == [x for x, _ in whole]


@pytest.fixture(scope="module")
def letters():
    from collections import Counter
    text = cases.words(1, 2000).split() + ["idiot", "loser", "moron", "stupid", "scum"] * 50 + ["the", "reading"] * 200
    return toxicity.smoothed(toxicity.trigrams(Counter(text)).reshape((toxicity.LETTERS,) * 3).astype(float))


def test_trigram_counts():
    from collections import Counter
    counts = toxicity.trigrams(Counter({"ab": 2, "é": 1})).reshape((toxicity.LETTERS,) * 3)
    assert counts[0, 0, 1] == 2 and counts[0, 1, 2] == 2 and counts[1, 2, 0] == 2
    e = toxicity.letter("é")
    assert counts[0, 0, e] == 1 and counts[0, e, 0] == 1 and counts.sum() == 8


@pytest.mark.parametrize("hidden,word", [("1d10t", "idiot"), ("l0s3r", "loser"), ("looooser", "loser"), ("m0r0nnn", "moron"),
                                         ("5tup1d", "stupid"), ("$cum", "scum"), ("m.o.r.o.n", "moron"), ("M-0-R-0-N", "moron")])
def test_restores(letters, hidden, word):
    assert toxicity.suspicious(hidden)
    assert toxicity.restore(toxicity.core(hidden), letters) == word


def test_spacing(letters):
    assert toxicity.spaced_runs("see i d 1 0 t now".split()) == ["id10t"]
    assert toxicity.restore("id10t", letters, True) == "idiot"
    for plain in ("word", "word%%%", "THE!!", "a$$$", "2024", "don't"):
        assert not toxicity.suspicious(plain)


def test_hidden_words_score_like_plain_ones(spark):
    rnd = np.random.default_rng(1)
    data, labels = [], []
    for i in range(600):
        toxic = int(rnd.random() < 0.3)
        text = cases.words(1000 + i, 30) + (" you idiot moron" if toxic else "")
        data.append((i, text, "en", "s", 1))
        labels.append((i, toxic))
    data += [(5001, cases.words(1, 20) + " 1d10t m0r0n", None, None, 1), (5002, "m o r o n i d i o t", None, None, 1),
             (5003, cases.words(9, 30), None, None, 1)]
    docs = spark.createDataFrame(data, cases.SCHEMA)
    marks = spark.createDataFrame([*labels, labels[0], (7, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.language_model(docs)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model, toxicity.fit(docs, marks, model)).collect()}
    assert scores[5001] >= 0.3 and scores[5002] >= 0.3 and scores[5003] < 0.3
    toxic = dict(labels)
    assert all((scores[i] >= 0.3) == bool(toxic[i]) for i in toxic if held_out(i))
    assert set(r.doc_id for r in toxicity.keep_clean(docs, marks).collect()) == {d for d, s in scores.items() if s < 0.3}


def test_toxicity_query_on_held_out_rows(spark):
    got = queries.QUERIES["op4_toxicity"](spark, SF01).toPandas()
    labels = spark.read.parquet(f"{SF01}/labels.parquet").toPandas().merge(got, on="doc_id")
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert ((got.score >= 0.3).astype(int) == got.predicted).all()
    own = labels[labels.held_out]
    assert own[own.toxic == 1].score.mean() > own[own.toxic == 0].score.mean() + 0.3


def test_toxicity_edges(spark):
    docs = cases.frame(spark, clash=True)
    marks = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    model = toxicity.language_model(docs)
    classifier = toxicity.fit(docs, marks, model)
    got = toxicity.score(docs, model, classifier)
    assert got.count() == len(cases.rows())
    assert got.filter(F.col("score").isNull() | ~F.col("score").between(0, 1)).count() == 0
    empty = docs.limit(0)
    model = toxicity.language_model(empty)
    assert {r.score for r in toxicity.score(docs, model, toxicity.fit(docs, marks.limit(0), model)).collect()} == {0.0}
    assert toxicity.score(empty, model, classifier).count() == 0
    assert toxicity.keep_clean(docs, marks.limit(0)).columns == docs.columns


def test_viterbi_equals_all_readings():
    """The likeliest of all readings of short lattices, by trying each."""
    import itertools

    rnd = random.Random(21)
    words = Counter({"idiot": 40, "clown": 30, "loser": 20, "little": 10, "hello": 9, "trash": 8, "bag": 5})
    model = toxicity.smoothed(toxicity.trigrams(words).astype(float).reshape((toxicity.LETTERS,) * 3))

    def score(choice):
        total, a, b = 0.0, 0, 0
        for letters, cost in choice:
            total -= cost
            for c in letters:
                if c == " ":
                    if b == 0:
                        return None
                    total, a, b = total + float(model[a, b, 0]), 0, 0
                else:
                    z = toxicity.letter(c)
                    total, a, b = total + float(model[a, b, z]), b, z
        return total + float(model[a, b, 0])
    texts = ["1d10t", "!diot", "c|own", "l0os3r", "heello", "tr@sh", "69", "li77le", "a..b", "|11", "ß1ø"]
    texts += ["".join(rnd.choice("ail01|!t7so.x") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    for text in texts:
        for breaks in (False, True):
            if breaks and len(text) > 5:
                continue
            found = []
            for choice in itertools.product(*toxicity.lattice(text, breaks)):
                total = score(choice)
                if total is not None:
                    found.append((total, "".join(x for x, _ in choice)))
            best = max(t for t, _ in found)
            got = toxicity.restore(text, model, breaks)
            assert got in {x for t, x in found if t >= best - 1e-4}, (text, breaks)


def test_numerals_are_no_letters(spark):
    train = [(i, t, lang, None, None) for i, (t, lang) in enumerate([("the house is red", "en"), ("das haus ist rot", "de")] * 8)]
    model = language_id.train(cases.frame(spark, train))
    asked = [(100 + i, t, None, None, None) for i, t in enumerate(["²", "½ ¾", "Ⅷ", "123 ²³", "①", "house²"])]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in
           language_id.predict(cases.frame(spark, asked).select("doc_id", "text"), model).collect()}
    assert [got[100 + i] for i in range(5)] == [("und", 0.0)] * 5 and got[105][0] == "en"


def test_language_query_equals_plain_loops(spark):
    """op8's own rows against EM and backward selection written as loops."""
    import math

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.train(docs)
    n = len(model.names)

    def em(fit):
        share = [1 / len(fit[0])] * len(fit[0])
        for _ in range(language_id.ROUNDS):
            new = [0.0] * len(share)
            for row in fit:
                total = sum(f * s for f, s in zip(row, share))
                for i, (f, s) in enumerate(zip(row, share)):
                    new[i] += f * s / total / len(fit)
            moved, share = max(abs(a - b) for a, b in zip(new, share)), new
            if moved < 1e-4:
                break
        return share, sum(math.log(max(sum(f * s for f, s in zip(row, share)), 1e-300)) for row in fit)

    def plain(text):
        fit = []
        for word in (text or "").split():
            bucket, _ = language_id.grams([word])
            if len(bucket):
                logs = [sum(float(model.logs[b, i]) for b in bucket) for i in range(n)]
                fit.append([max(math.exp(x - max(logs)), 1e-30) for x in logs])
        if not fit:
            return "und", 0.0
        share, _ = em(fit)
        chosen = [i for i in range(n) if share[i] * len(fit) >= 0.5] or [max(range(n), key=lambda i: share[i])]
        share, likelihood = em([[row[i] for i in chosen] for row in fit])
        while len(chosen) > 1:
            weakest = min(range(len(chosen)), key=lambda i: share[i])
            rest = chosen[:weakest] + chosen[weakest + 1:]
            fewer, lower = em([[row[i] for i in rest] for row in fit])
            if likelihood - lower >= 0.5 * math.log(max(2, len(fit))):
                break
            chosen, share, likelihood = rest, fewer, lower
        best = max(range(len(chosen)), key=lambda i: (share[i], -i))
        return model.names[chosen[best]], share[best]
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_language_id"](spark, SF001).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        lang, score = plain(r["text"])
        assert got[r["doc_id"]]["lang_pred"] == lang
        assert got[r["doc_id"]]["score"] == pytest.approx(min(1.0, score), abs=1e-3)
