"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item of n (normalised) characters matches a document that holds a
passage within k = n * ``ERRORS`` edits of it. Of k + 1 disjoint pieces of the
item at least one stands in such a passage unchanged, so an automaton over all
pieces finds every candidate place; Myers' bit-parallel algorithm computes the
distance around it. Neighbouring candidates of one item are joined, so a
repetitive text is scanned once for an item, not once for a hit.

Normalised: lower case, every run of ASCII characters other than letters and
digits one space; other characters stay. Documents are read in a map-only
pass. Items are broadcast in blocks of about ``BLOCK_BYTES`` of text and every
block is matched against all documents, so the broadcast does not grow with
the benchmark.

Items of fewer than ``LEAST`` normalised characters match only as whole words,
within the same budget (so without edits below 13 characters): no word of the
document reaches across either end of the passage. In scripts that are written
without spaces every character is a word.

Defined cases: null or empty documents and items match nothing; of several passages the one with the smallest distance, then the first
end, is reported; repeated documents or items give repeated rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shopflow.llm.common import pieces, python_ready

ERRORS = 0.08
LEAST = 20
BLOCK_BYTES = 1 << 20
#: first and last code points of scripts that put no spaces between words
#: (Thai, Lao, Myanmar, Khmer, kana and ideographs)
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF),
            (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]
_SPACED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def normalised(text: str | None) -> str:
    return b" ".join((text or "").lower().encode().translate(_SPACED).split()).decode()


def in_word(character: str) -> bool:
    """Letters, digits and their marks, in scripts that separate words."""
    return ((character.isalnum() or unicodedata.category(character)[0] == "M")
            and not any(a <= ord(character) <= b for a, b in UNSPACED))


def border(text: str, at: int) -> bool:
    """Whether no word reaches across the place before ``text[at]``."""
    return not (0 < at < len(text) and in_word(text[at - 1]) and in_word(text[at]))


@dataclass
class Pattern:
    """A benchmark item ready for Myers' algorithm."""

    item_id: int
    text: str
    errors: int
    masks: dict[str, int] = field(default_factory=dict)
    whole_words: bool = False

    def __post_init__(self) -> None:
        for i, c in enumerate(self.text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def cuts(self) -> list[tuple[int, str]]:
        """(offset, piece) of the error budget plus one disjoint pieces."""
        n, k = len(self.text), self.errors + 1
        edges = [n * j // k for j in range(k + 1)]
        return [(a, self.text[a:b]) for a, b in zip(edges, edges[1:])]

    def exact(self, text: str, start: int, stop: int) -> tuple[int, int] | None:
        """(0, end) of the first place between word borders."""
        at = text.find(self.text, start, stop)
        while at >= 0:
            end = at + len(self.text)
            if border(text, at) and border(text, end):
                return 0, end
            at = text.find(self.text, at + 1, stop)
        return None

    def bordered(self, text: str, start: int, stop: int) -> tuple[int, int] | None:
        """(distance, end) of the closest passage between word borders, for
        items of a few characters."""
        best, n = None, len(self.text)
        for first in range(max(0, start), min(stop, len(text))):
            if not border(text, first):
                continue
            column = list(range(n + 1))
            for end in range(first + 1, min(len(text), first + n + self.errors) + 1):
                c, above, column[0] = text[end - 1], column[0], end - first
                for i in range(1, n + 1):
                    above, column[i] = column[i], min(above + (self.text[i - 1] != c), column[i] + 1, column[i - 1] + 1)
                if column[n] <= self.errors and border(text, end):
                    best = min(best or (column[n], end), (column[n], end))
        return best

    def best(self, text: str) -> tuple[int, int] | None:
        """(distance, end) of the closest passage of ``text`` within budget."""
        found = text.find(self.text)
        if found >= 0:
            return 0, found + len(self.text)
        m = len(self.text)
        full, high = (1 << m) - 1, 1 << (m - 1)
        up, down, distance = full, 0, m  # vertical differences +1 and -1
        best = None
        for end, c in enumerate(text, 1):
            same = self.masks.get(c, 0)
            diagonal = (((same & up) + up) ^ up) | same
            right_up = down | ~(diagonal | up) & full
            right_down = up & diagonal
            if right_up & high:
                distance += 1
            elif right_down & high:
                distance -= 1
                if distance <= self.errors and (best is None or distance < best[0]):
                    best = distance, end
            right_up, right_down = right_up << 1 & full, right_down << 1 & full
            turned = same | down
            up = right_down | ~(turned | right_up) & full
            down = right_up & turned
        return best


class Matcher:
    def __init__(self, items: list[tuple[int, str]], errors: float = ERRORS) -> None:
        texts = [(i, normalised(t)) for i, t in items]
        self.patterns = [Pattern(i, t, int(len(t) * errors), whole_words=len(t) < LEAST) for i, t in texts if t]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, pattern in enumerate(self.patterns):
            for offset, piece in pattern.cuts():
                places.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def regions(self, text: str) -> dict[int, list[list[int]]]:
        """Pattern -> joined stretches of the text that may hold it."""
        spans: dict[int, list[list[int]]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for number, offset in where:
                pattern = self.patterns[number]
                start = end + 1 - length - offset - pattern.errors
                stop = start + len(pattern.text) + 2 * pattern.errors
                known = spans.setdefault(number, [])
                # hits come by their end, so starts are nearly sorted
                if known and start <= known[-1][1]:
                    known[-1] = [min(start, known[-1][0]), max(stop, known[-1][1])]
                else:
                    known.append([start, stop])
        return spans

    def matches(self, text: str | None, any_one: bool = False) -> list[tuple[int, int, int]]:
        """(item_id, distance, end) of the items that ``text`` holds."""
        own = normalised(text)
        if not own or not self.patterns:
            return []
        out = []
        for number, spans in self.regions(own).items():
            found, pattern = [], self.patterns[number]
            for start, stop in spans:
                if pattern.whole_words:
                    got = pattern.bordered(own, start, stop) if pattern.errors else pattern.exact(own, start, stop)
                    if got:
                        found.append(got)
                        if not pattern.errors:
                            break
                    continue
                got = pattern.best(own[max(0, start):stop])
                if got:
                    found.append((got[0], got[1] + max(0, start)))
            if found:
                out.append((pattern.item_id, *min(found)))
                if any_one:
                    return out
        return out


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, text) in blocks of about ``block_bytes``."""
    rows = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = pieces(size, block_bytes)
    for block in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block) if n > 1 else rows
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, distance, end_at (in the normalised text): a row for
    each document and item that it holds."""
    spark = docs.sparkSession
    python_ready(spark)
    kinds = [x.schema[c].dataType.simpleString() for x, c in ((docs, "doc_id"), (benchmark, "item_id"))]
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, end_at int"
    out = None
    for items in blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, errors)
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                        for m in matcher.matches(t)]
                columns = list(zip(*rows)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], item_type),
                     pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())],
                    ["doc_id", "item_id", "distance", "end_at"])
        found = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no item."""
    spark = docs.sparkSession
    python_ready(spark)
    for items in blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, errors)
            for batch in batches:
                texts = batch.column("text").to_pylist()
                yield batch.filter(pa.array([not matcher.matches(t, True) for t in texts], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
