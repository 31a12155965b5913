"""Language identification as inference of a mixture of languages.

Training counts character 1- to 3-grams of words for every language, over all
labelled rows of the training part. Grams are hashed into a fixed number of
buckets, so the model has ``BUCKETS`` numbers a language whatever the corpus.

A document is a bag of words; a word's likelihood under a language is the
product over its grams. Expectation-maximisation estimates the proportions of
the languages in the document. The language set is then selected by penalised
likelihood: languages are dropped, weakest first, while the fit loses less
than the penalty of one parameter. The language with the largest remaining
proportion is the prediction, its proportion the score.

Defined cases: texts that are null or have no letter are ``und`` with score 0,
and so is everything where training rows are missing; ties go to the
alphabetically first language; repeated rows get equal results; other columns
are not carried.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import in_training, python_ready

BUCKETS = 1 << 16
MOST_LANGUAGES = 500
UNKNOWN = "und"
SMOOTHING = 0.5
ROUNDS = 30
_NO_LETTERS = re.compile(r"[\W\d_]+")
#: bytes of word likelihoods that a worker keeps
CACHE_BYTES = 32 << 20
CACHE_WORDS = 400_000


def grams(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, owner) of the 1- to 3-grams of each unit's words. Units without a letter own none."""
    joined, sizes = [], []
    for unit in units:
        word = _NO_LETTERS.sub(" ", unit.lower()).strip()
        if not word.isascii() and not word.replace(" ", "").isalpha():   # numerals such as ² and Ⅷ are no letters
            word = "".join(c if c.isalpha() else " " for c in word).strip()
        word = " " + word + " "
        joined.append(word)
        sizes.append(len(word))
    codes = np.frombuffer("".join(joined).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(units)), sizes)
    letter = codes != 32
    before = np.concatenate([[32], codes[:-1]]).astype(np.uint64)
    after = np.concatenate([codes[1:], [32]]).astype(np.uint64)
    at = np.flatnonzero(letter)
    factors = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
    one = codes * factors[0]
    two = one + (before + np.uint64(1)) * factors[1]
    three = two + (after + np.uint64(1)) * factors[2]
    buckets = np.concatenate([x[at] for x in (one, two, three)])
    buckets = ((buckets ^ (buckets >> np.uint64(31))) * factors[0]) >> np.uint64(48)
    return buckets.astype(np.int64), np.tile(owner[at], 3)


def train(docs: DataFrame) -> Model:
    """``docs``: doc_id, text, lang. Rows outside the training part or without
    a language or text are left out."""
    python_ready(docs.sparkSession)
    rows = (docs.filter(in_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select("lang", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(text.split())
            for lang, words in seen.items():
                bucket, owner = grams(list(words))
                times = np.fromiter(words.values(), np.int64, len(words))[owner]
                total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total += np.bincount(bucket, times, BUCKETS).astype(np.int64)
        for lang, total in totals.items():
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found)), pa.array(found), pa.array(total[found])],
                ["lang", "bucket", "n"])

    counted = rows.mapInArrow(count, "lang string, bucket long, n long")
    got = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    names = sorted(r[0] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the model's size has no bound")
    table = got.toPandas()  # at most BUCKETS rows a language
    counts = np.full((BUCKETS, len(names)), SMOOTHING)
    counts[table["bucket"], table["lang"].map({x: i for i, x in enumerate(names)})] += table["n"]
    return Model(names, (np.log(counts) - np.log(counts.sum(0))).astype(np.float32))


def mixture(fit: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions and log likelihood of words with likelihoods ``fit``."""
    share = np.full(fit.shape[1], 1 / fit.shape[1])
    for _ in range(rounds):
        weighted = fit * share
        weighted /= weighted.sum(1, keepdims=True)
        new = weighted.mean(0)
        moved = np.abs(new - share).max()
        share = new
        if moved < 1e-4:
            break
    return share, float(np.log(np.maximum(fit @ share, 1e-300)).sum())


@dataclass
class Model:
    names: list[str]
    logs: np.ndarray  # bucket x language

    def __post_init__(self) -> None:
        self.rows: dict[str, int] = {}
        most = CACHE_BYTES // (4 * max(1, len(self.names)))
        self.most = max(1000, min(CACHE_WORDS, most))
        self.kept = np.zeros((0, len(self.names)), np.float32)
        self.has = np.zeros(0, bool)

    def _learn(self, texts: list[list[str]]) -> None:
        """Rows of likelihoods for the words that have none yet."""
        new = list({w for words in texts for w in words if w not in self.rows})
        if not new:
            return
        if len(self.rows) + len(new) > self.most:
            self.rows.clear()
            self.kept, self.has = self.kept[:0], self.has[:0]
            new = list({w for words in texts for w in words})
        bucket, owner = grams(new)
        fit = np.stack([np.bincount(owner, column, len(new)) for column in self.logs[bucket].T], 1)
        if len(self.rows) + len(new) > len(self.kept):
            grown = max(2 * len(self.kept), len(self.rows) + len(new))
            self.kept = np.concatenate([self.kept, np.zeros((grown - len(self.kept), len(self.names)), np.float32)])
            self.has = np.concatenate([self.has, np.zeros(grown - len(self.has), bool)])
        start = len(self.rows)
        self.kept[start:start + len(new)] = fit
        self.has[start:start + len(new)] = np.bincount(owner, minlength=len(new)) > 0
        self.rows.update(zip(new, range(start, start + len(new))))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for start in range(0, len(texts), 256):
            block = [(t or "").split() for t in texts[start:start + 256]]
            if self.names:
                self._learn(block)
            out += [self._one(words) for words in block]
        return out

    def _one(self, words: list[str]) -> tuple[str, float]:
        if not self.names or not words:
            return UNKNOWN, 0.0
        row = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        row = row[self.has[row]]
        if not len(row):
            return UNKNOWN, 0.0
        logs = self.kept[row].astype(np.float64)
        top = logs.max(1, keepdims=True)
        chosen, share = self.select(np.maximum(np.exp(logs - top), 1e-30))
        best = int(np.argmax(share))  # the first of equals
        return self.names[chosen[best]], float(min(1.0, share[best]))

    def select(self, fit: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Languages and proportions after penalised backward selection."""
        share, likelihood = mixture(fit)
        chosen = [i for i in range(fit.shape[1]) if share[i] * len(fit) >= 0.5]
        chosen = chosen or [int(np.argmax(share))]
        if len(chosen) < fit.shape[1]:
            share, likelihood = mixture(fit[:, chosen])
        penalty = 0.5 * np.log(max(2, len(fit)))
        while len(chosen) > 1:
            weakest = int(np.argmin(share))
            rest = chosen[:weakest] + chosen[weakest + 1:]
            fewer, lower = mixture(fit[:, rest])
            if likelihood - lower >= penalty:
                break
            chosen, share, likelihood = rest, fewer, lower
        return chosen, share


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` (doc_id, text)."""
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.logs))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            got = own.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x for x, _ in got], pa.string()),
                 pa.array([x for _, x in got], pa.float64())], ["doc_id", "lang_pred", "score"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
