"""The corpus pipeline against brute force, stage by stage."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from shopflow.llm import decontamination, toxicity
from tests.conftest import SF001
from tests.llm import cases
from tests.llm.test_exact import plain_mark
from tests.llm.test_near import edited, plain


def corpus(spark, workdir):
    rnd = random.Random(3)
    items = [(i, cases.words(700 + i, 30)) for i in range(5)]
    data, labels = [], []
    for d in range(400):
        text = cases.words(d % 350, 80)  # the last 50 are copies
        if d % 10 == 3:
            text = edited(cases.words(d - 1, 80), 1, rnd)  # near copies of the one before
        if d % 25 == 7:
            text += " " + items[d % 5][1]
        if d % 8 == 5:
            text += " you idiot moron"
        data.append((d, text, "en", "s", len(text)))
        labels.append((d, 0, int(d % 8 == 5)))
    data += [(900, None, None, None, None), (901, "", None, None, 0), (902, cases.words(2, 80) + " 1d10t m0r0n", "en", "s", 1)]
    spark.createDataFrame(data, cases.SCHEMA).write.parquet(f"{workdir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{workdir}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{workdir}/labels.parquet")
    return data, items


def test_every_stage_takes_effect(spark, workdir):
    data, items = corpus(spark, workdir)
    docs = spark.read.parquet(f"{workdir}/documents.parquet")
    kept = [r for r in data if not (r[1] or "").endswith(("idiot moron", "1d10t m0r0n"))]
    stages = iter(corpus_pipeline.STAGES)

    def step():
        name, stage = next(stages)
        out = stage(spark, docs, workdir)
        path = f"{workdir}/{name}"
        out.write.parquet(path)
        return spark.read.parquet(path)

    def ids():
        return sorted(r.doc_id for r in docs.select("doc_id").collect())
    docs = step()
    assert ids() == sorted(r[0] for r in kept) and docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    docs = step()
    firsts = {min(g)[3][0] for g in plain_mark(kept).values()}
    kept = [r for r in kept if r[0] in firsts]
    assert ids() == sorted(firsts)
    docs = step()
    own = plain([(r[0], r[1]) for r in kept], 5, 80)
    kept = [r for r in kept if own[r[0]][1] == r[0]]
    assert ids() == sorted(r[0] for r in kept) and len(kept) < len(own)
    docs = step()
    clean = [r for r in kept if not any(decontamination.normalised(t) in decontamination.normalised(r[1]) for _, t in items)]
    assert ids() == sorted(r[0] for r in clean) and len(clean) < len(kept)
    docs = step()
    assert docs.filter(F.col("n_tokens") < 0).count() == 0 and ids() == sorted(r[0] for r in clean)
    run = {tuple(r) for r in corpus_pipeline.run(spark, workdir).collect()}
    assert run == {tuple(r) for r in docs.collect()}


def test_run_on_the_tables(spark):
    out = entry.queries()["pipeline"](spark, SF001)
    n = out.count()
    assert 100 < n < 200 and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert toxicity.THRESHOLD == 0.3 and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"


def test_names_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_empty_table(spark, workdir):
    spark.createDataFrame([], cases.SCHEMA).write.parquet(f"{workdir}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{workdir}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{workdir}/labels.parquet")
    assert corpus_pipeline.run(spark, workdir).count() == 0
