"""Toxicity scores of deobfuscated text.

Noisy channel: a writer hides words by leetspeak, spacing and repetition.
Each suspicious token becomes a lattice of the letters its characters may
stand for; Viterbi finds the likeliest reading under a character trigram
language model, whose counts come from the words of all documents. The
restored words' features (the word and its beginnings) are scored by a
logistic regression.

1. ``language_model``: trigram counts over all whole texts; its size is
   fixed by the alphabet.
2. ``fit``: labelled rows of the training part, at most about
   ``TRAINING_ROWS`` of them, chosen by a hash of the id, whatever their text.
   Features that are significantly more frequent in toxic rows are kept (at
   most ``FEATURES``) and weighted by a penalised maximum likelihood fit.
3. ``score``: every row, map-only, with the model broadcast.

Defined cases: null and empty texts get the score of a text without any
feature; a null label is no label; of conflicting labels of one id the larger
counts; without training rows all scores are 0; repeated rows get equal
scores; other columns are not carried.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm.common import cut, in_training, python_ready

TRAINING_ROWS = 20_000
FEATURES = 20_000
SIGNIFICANCE = 5.0
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7)
CACHE_ENTRIES = 150_000
#: fixed values: letters that a character may stand for, likeliest first
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: costs (nats) of channel events
SUBSTITUTE, SECOND_CHOICE, DROP, SHORTEN, WORD_BREAK = 0.5, 0.5, 8.0, 1.0, 1.0
LETTERS = 64
_WORD = re.compile(r"[^\W\d_]+")
_PLAIN = re.compile(r"[^\W\d_]+\Z")
#: decoration around a word
_EDGE = re.compile(r"^(?:[^\w@$]|[@$!]{3,}|_)+|(?:[^\w@$]|[@$!]{3,}|_)+$")
_SUSPECT = re.compile(
    r"[^\W\d_][0-9@$!|+(€£]+[^\W\d_]|^[0-9@$][0-9@$]*[^\W\d_]|[^\W\d_][0-9@$]+$|([^\W\d_])\1\1"
    r"|^(?:[^\W_][._*\-]){2,}[^\W_]$")


def letter(character: str) -> int:
    """Class of a lower-case letter: a-z, Latin-1 letters, any other."""
    code = ord(character)
    if 97 <= code <= 122:
        return code - 96
    return code - 0xDF + 27 if 0xDF <= code <= 0xFF else 60


def plain_words(unit: str) -> list[str]:
    return _WORD.findall(unit.lower())


def trigrams(words: Counter) -> np.ndarray:
    """Counts of the letter trigrams of words, with borders (class 0)."""
    out = np.zeros(LETTERS ** 3, np.int64)
    if not words:
        return out
    text = "\0\0" + "\0\0".join(words) + "\0"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    classes = np.where((codes >= 97) & (codes <= 122), codes - 96,
                       np.where((codes >= 0xDF) & (codes <= 0xFF), codes - 0xDF + 27, 60))
    classes[codes == 0] = 0
    times = np.repeat(np.fromiter(words.values(), np.int64, len(words)),
                      np.fromiter(map(len, words), np.int64, len(words)) + 2)
    # position i of the joined text belongs to the word whose two leading borders it follows
    triple = (classes[:-2] * LETTERS + classes[1:-1]) * LETTERS + classes[2:]
    owner = np.append(times, times[-1:])[:len(triple)]
    starts = (classes[1:-1] == 0) & (classes[:-2] != 0)
    keep = ~starts
    return out + np.bincount(triple[keep], owner[keep], LETTERS ** 3).astype(np.int64)


def language_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) of letter classes, from every text of ``docs``."""
    python_ready(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS ** 3, np.int64)
        for batch in batches:
            units = Counter()
            for text in batch.column(0).to_pylist():
                units.update((text or "").split())
            words = Counter()
            for unit, n in units.items():
                if _PLAIN.match(unit):
                    words[unit.lower()] += n
                elif not suspicious(unit):
                    for word in plain_words(unit):
                        words[word] += n
            total += trigrams(words)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["triple", "n"])

    got = (docs.select("text").mapInArrow(count, "triple long, n long")
           .groupBy("triple").agg(F.sum("n").alias("n")).toPandas())  # at most LETTERS^3 rows
    counts = np.zeros(LETTERS ** 3)
    counts[got["triple"].to_numpy(np.int64)] = got["n"]
    return smoothed(counts.reshape(LETTERS, LETTERS, LETTERS))


def smoothed(three: np.ndarray, weight: float = 2.0) -> np.ndarray:
    """Interpolation with shorter contexts."""
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + LETTERS)
    p2 = (two + weight * p1) / (two.sum(1, keepdims=True) + weight)
    p3 = (three + weight * p2) / (three.sum(2, keepdims=True) + weight)
    return np.log(p3).astype(np.float32)


def core(unit: str) -> str:
    return _EDGE.sub("", unit.lower())


def suspicious(unit: str) -> bool:
    return _SUSPECT.search(core(unit)) is not None


def lattice(characters: str, breaks: bool = False) -> list[list[tuple[str, float]]]:
    """For every run of one character its readings and their costs; with
    ``breaks``, words may end between characters."""
    out: list[list[tuple[str, float]]] = []
    for run in re.finditer(r"(.)\1*", characters, re.S):
        c, n = run.group(1), len(run.group())
        if c.isalpha():
            letters = [(c, 0.0)]
        elif c in LEET:
            letters = [(x, SUBSTITUTE + i * SECOND_CHOICE) for i, x in enumerate(LEET[c])]
        else:
            out.append([("", 0.0)])
            continue
        many = 0.0 if n == 2 else SHORTEN
        choices = [(x, cost + (0.0 if n == 1 else SHORTEN if n == 2 else 0.0)) for x, cost in letters]
        if n > 1:
            choices += [(x + x, cost + many) for x, cost in letters]
        if not c.isalpha():
            choices.append(("", DROP))
        out.append(choices)
        if breaks:
            out.append([("", 0.0), (" ", WORD_BREAK)])
    return out


def restore(characters: str, model: np.ndarray, breaks: bool = False) -> str:
    """The likeliest reading (Viterbi; ties go to the alphabetically first)."""
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for choices in lattice(characters, breaks):
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, text) in states.items():
            for letters, cost in choices:
                x, y, total = a, b, score - cost
                for c in letters:
                    if c == " ":
                        if y == 0:
                            continue
                        total += float(model[x, y, 0])
                        x, y = 0, 0
                    else:
                        z = letter(c)
                        total += float(model[x, y, z])
                        x, y = y, z
                best = after.get((x, y))
                if best is None or (-total, text + letters) < (-best[0], best[1]):
                    after[x, y] = (total, text + letters)
        states = after
    ends = [(-(s + float(model[a, b, 0])), t) for (a, b), (s, t) in states.items()]
    return min(ends)[1]


def beginnings(word: str) -> list[str]:
    """Features of a word: itself and its longer beginnings."""
    return [word] + [word[:k] + "-" for k in PREFIXES if len(word) > k]


class Reader(dict):
    """Unit (text between white space) -> features of its restored words that
    are ``wanted`` (None: all)."""

    def __init__(self, model: np.ndarray, wanted: dict[str, int] | None) -> None:
        self.model, self.wanted = model, wanted

    def of_words(self, words: list[str]) -> tuple:
        if self.wanted is None:
            return tuple({f for w in words for f in beginnings(w)})
        return tuple({self.wanted[f] for w in words for f in beginnings(w) if f in self.wanted})

    def __missing__(self, unit: str) -> tuple:
        words = restore(core(unit), self.model).split() if suspicious(unit) else plain_words(unit)
        found = self.of_words(words)
        if len(self) < CACHE_ENTRIES and len(unit) <= 64:
            self[unit] = found
        return found

    def features(self, text: str | None) -> set:
        units = (text or "").split()
        out = set()
        for found in map(self.__getitem__, units):
            if found:
                out.update(found)
        for spaced in spaced_runs(units):
            out.update(self.of_words(restore(spaced, self.model, True).split()))
        return out


def spaced_runs(units: list[str]) -> list[str]:
    """Runs of three or more single characters, joined (``i d i o t``)."""
    out, run = [], []
    if sum(map((1).__eq__, map(len, units))) < 3:
        return out
    for unit in [*units, ""]:
        if len(unit) == 1 and (unit.isalnum() or unit in LEET):
            run.append(unit)
            continue
        if len(run) >= 3:
            out.append("".join(run).lower())
        run = []
    return out


@dataclass
class Classifier:
    features: dict[str, int]
    weights: np.ndarray
    bias: float

    def score(self, found: set[int]) -> float:
        if not np.isfinite(self.bias):
            return 0.0
        return float(1 / (1 + np.exp(-(self.bias + self.weights[list(found)].sum()))))


def training_labels(labels: DataFrame, most: int) -> DataFrame:
    """doc_id and toxic of at most about ``most`` training rows."""
    known = (labels.filter(in_training(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    return known


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, most: int = TRAINING_ROWS) -> Classifier:
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    known = cut(training_labels(labels, most))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value, None)
        for batch in batches:
            found = [sorted(reader.features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(found, pa.list_(pa.string()))], ["toxic", "found"])

    toxic_type = known.schema["toxic"].dataType.simpleString()
    read_rows = cut(rows.mapInArrow(read, f"toxic {toxic_type}, found array<string>"))
    n, positive = read_rows.agg(F.count(F.lit(1)), F.sum(F.col("toxic").cast("double"))).first()
    if not n:
        return Classifier({}, np.zeros(0), -np.inf)
    rate = min(max(positive / n, 0.5 / n), 1 - 0.5 / n)
    counts = (read_rows.select(F.explode("found").alias("feature"), F.col("toxic").cast("double").alias("toxic"))
              .groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")))
    excess = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    chosen = (counts.filter((F.col("n") >= 2) & (excess > SIGNIFICANCE))
              .orderBy(excess.desc(), "feature").limit(FEATURES)
              .select("feature").toPandas()["feature"].tolist())
    places = {f: i for i, f in enumerate(sorted(chosen))}
    wanted = F.array(*[F.lit(f) for f in places]) if places else F.array().cast("array<string>")
    got = read_rows.select(F.array_intersect("found", wanted).alias("found"), "toxic").toPandas()
    return regression([[places[f] for f in found] for found in got["found"]],
                      got["toxic"].to_numpy(float), rate, places)


def regression(found: list[list[int]], toxic: np.ndarray, rate: float, places: dict[str, int],
               rounds: int = 300, penalty: float = 1e-4) -> Classifier:
    """Logistic regression by adaptive gradient steps over the bounded sample."""
    column = np.array([f for row in found for f in row], np.int64)
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    state = np.zeros(len(places) + 1)
    state[-1] = np.log(rate / (1 - rate))
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, rounds + 1):
        value = state[-1] + np.bincount(row, state[column], len(found))
        error = 1 / (1 + np.exp(-value)) - toxic
        slope = np.bincount(column, error[row], len(places)) / len(found) + penalty * state[:-1]
        slope = np.append(slope, error.mean())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope ** 2
        state -= 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Classifier(places, state[:-1], float(state[-1]))


def scorer(spark: SparkSession, model: np.ndarray, classifier: Classifier) -> Callable[[str], Column]:
    """Column function: the score of a text column."""
    python_ready(spark)
    shared = spark.sparkContext.broadcast((model, classifier))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own_model, own = shared.value
        reader = Reader(own_model, own.features)
        for texts in batches:
            yield pd.Series([own.score(reader.features(t)) for t in texts], dtype=float)
    return scored


def score(docs: DataFrame, model: np.ndarray, classifier: Classifier) -> DataFrame:
    """doc_id and score of every row."""
    return docs.select("doc_id", scorer(docs.sparkSession, model, classifier)("text").alias("score"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all columns, that score below the threshold."""
    model = language_model(docs)
    scored = scorer(docs.sparkSession, model, fit(docs, labels, model))
    return docs.filter(scored("text") < threshold)
