"""Token counts by rank-synchronous merging of ragged arrays.

A batch's new pre-tokens become one flat array of symbols with sequence
borders. Each round looks up the rank of every adjacent pair, finds every
sequence's lowest rank, and merges all of its occurrences in all sequences at
once (left to right where they overlap). Sequences without a mergeable pair
leave; their surviving symbols are their tokens. A merge never makes a pair of
lower rank than itself, so the rounds equal the one-by-one order.

The plan is map-only. A worker remembers the counts of a bounded number of
short units (text between spaces).

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows
are counted alike; special strings count as one token each; other columns are
not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopflow.llm import bpe
from shopflow.llm.common import python_ready

NONE = np.iinfo(np.int32).max
#: bytes of new pre-tokens that are merged together at most
BATCH_BYTES = 4 << 20


class Merger:
    def __init__(self, vocab: bpe.Vocabulary) -> None:
        self.base = np.int64(max(vocab.tokens) + 1)
        keys = np.array([a * self.base + b for a, b in vocab.merges], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        ranks = np.array([r for r, _ in vocab.merges.values()], np.int32)
        made = np.array([m for _, m in vocab.merges.values()], np.int32)
        self.ranks, self.made = np.append(ranks[order], NONE), np.append(made[order], 0)
        self.byte_ids = np.array(vocab.byte_ids, np.int32)

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        """Number of tokens of each (non-empty) pre-token."""
        out = np.zeros(len(sequences), np.int64)
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        symbols = self.byte_ids[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        while len(symbols):
            rank, made = self.look_up(symbols, owner)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            lowest = np.minimum.reduceat(rank, starts)
            size = np.diff(starts, append=len(symbols))
            done = lowest == NONE
            out[owner[starts[done]]] = size[done]
            merge = (rank == np.repeat(lowest, size)) & (rank != NONE)
            at = np.flatnonzero(merge)
            # of overlapping occurrences (a a a) every second one, from the left
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            offset = np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))
            at = at[offset % 2 == 0]
            symbols[at] = made[at]
            keep = np.repeat(~done, size)
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return out

    def look_up(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pair that starts at each symbol."""
        key = symbols[:-1] * self.base + symbols[1:]
        found = np.searchsorted(self.keys, key)
        hit = (self.keys[found] == key) & (owner[:-1] == owner[1:])
        found = np.append(np.where(hit, found, len(self.keys) - 1), len(self.keys) - 1)
        return self.ranks[found], self.made[found]


class Counter:
    """Counts of whole texts. ``rest`` holds the counts of units that follow a
    space, ``first`` those of other units."""

    def __init__(self, vocab: bpe.Vocabulary) -> None:
        self.vocab, self.merger = vocab, Merger(vocab)
        self.first: dict[str, int] = {}
        self.rest: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        out = []
        for start in range(0, len(texts), 512):
            out += self._block(texts[start:start + 512])
        return out

    def _block(self, texts: list[str]) -> list[int]:
        plans = [[self._cut(s) for s in self.vocab.segments(t)] for t in texts]
        heads, tails = {}, {}
        for plan in plans:
            for first, rest in plan:
                heads.update(dict.fromkeys(first))
                tails.update(dict.fromkeys(rest))
        new_first = [u for u in heads if u not in self.first]
        new_rest = [u for u in tails if u not in self.rest]
        got = self._merged(new_first + [" " + u for u in new_rest])
        head_count = dict(zip(new_first, got[:len(new_first)]))
        tail_count = dict(zip(new_rest, got[len(new_first):]))
        if len(self.first) + len(self.rest) < bpe.CACHE_ENTRIES:  # frequent units come early
            for kept, new in ((self.first, head_count), (self.rest, tail_count)):
                kept.update((u, n) for u, n in new.items() if len(u) <= bpe.CACHED_LENGTH)
        head_count |= {u: self.first[u] for u in heads if u not in head_count}
        tail_count |= {u: self.rest[u] for u in tails if u not in tail_count}
        return [sum(sum(map(head_count.__getitem__, first)) + sum(map(tail_count.__getitem__, rest))
                    for first, rest in plan) for plan in plans]

    def _cut(self, segment: str | int) -> tuple[list[str], list[str]]:
        if isinstance(segment, int):
            return [""], []  # a special string, counted below as one token
        cut = bpe.units(segment)
        if cut:
            return [cut[0]] if cut[0] else [], cut[1]
        found = bpe.pretokens(segment)
        return [p for p in found if p[0] != " "], [p[1:] for p in found if p[0] == " "]

    def _merged(self, new: list[str]) -> list[int]:
        """Tokens of units, through the distinct pre-tokens in them."""
        found = [bpe.pretokens(u) for u in new]
        distinct = list(dict.fromkeys(p for f in found for p in f))
        counts: dict[str, int] = {}
        block: list[bytes] = []
        begin = size = 0
        for i, p in enumerate(distinct):
            block.append(p.encode())
            size += len(block[-1])
            if size >= BATCH_BYTES or i == len(distinct) - 1:
                counts.update(zip(distinct[begin:i + 1], self.merger.counts(block).tolist()))
                block, begin, size = [], i + 1, 0
        return [sum(map(counts.__getitem__, f)) if u else 1 for u, f in zip(new, found)]


_COUNTERS: dict[int, Counter] = {}


def counter(file_text: str) -> Counter:
    vocab = bpe.vocabulary(file_text)
    if id(vocab) not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[id(vocab)] = Counter(vocab)
    return _COUNTERS[id(vocab)]


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = bpe.share(spark, path)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(own.count(texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long")
