"""Substring deduplication with fixed-block anchors.

A window is ``WINDOW`` consecutive words. Anchors are the non-overlapping
blocks of half a window at multiples of their length in every document; any
window holds at least one whole anchor block. So if a window occurs twice, one
occurrence's anchor is hit by a rolling probe of the other.

1. Documents are dealt into chunks by a hash of their id. A chunk sends the
   hashes of all its rolling blocks, with a flag for those that are anchors,
   packed and sorted, to key buckets.
2. A bucket finds the anchor hashes that any other position probes, and tells
   the chunks that hold them.
3. Chunks extend these hits: the windows that hold a hit are hashed twice and
   sent, each with the first document of the chunk that has it.
4. A bucket tells every chunk which of its windows start earlier elsewhere.
5. A window is a repeat if it starts earlier in another chunk or in its own;
   overlapping repeats join to maximal spans, whose words are removed.

A hash that is frequent is sent once a chunk, not once an occurrence, so hot
passages do not gather in one task. Windows of different chunks are equal if
two independent 64-bit hashes of their words are; block hashes only propose
candidates. The documents' exchange is one shuffle that all passes read. A
bucket holds the keys of a few chunks, so there are fewer buckets than chunks;
a bucket's work is one sort, and the shuffles get more partitions with the
number of chunks, so that no task grows with the input.

Defined cases: a null text has no words; order is by id, then by text; rows
without an id come last, by the 64-bit hash of their text (which also deals
them into chunks) and then by text; documents shorter than a window lose
nothing; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import pieces, python_ready, shuffle_partitions

WINDOW = 20
#: bytes of text in a chunk; more on larger clusters means fewer, larger messages
CHUNK_BYTES = 8 << 20
#: chunks whose keys a bucket holds on average, where there are many chunks
CHUNKS_A_BUCKET = 4
#: as many buckets as chunks up to here, so that small inputs use all cores
FEW_BUCKETS = 16
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_CHECK = np.uint64(0xC2B2AE3D27D4EB4F)
LAST = np.iinfo(np.int64).max


class Words(dict):
    """Word -> 64-bit hash; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = Words()


def rolling(codes: np.ndarray, size: int, factor: np.uint64 = _FACTOR) -> np.ndarray:
    """Hash of the ``size`` codes from each position on (shorter tails: none)."""
    n = max(0, len(codes) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * factor + codes[i:i + n]
    total ^= total >> np.uint64(32)
    total *= _MIX
    return total ^ (total >> np.uint64(29))


def text_order(doc_id: int | None, text: str | None) -> int:
    """Place of a row without an id among its like: Spark's ``xxhash64`` of the
    text, by which such rows are dealt, so equal places share a chunk."""
    if doc_id is not None or text is None:
        return 0
    value = xxhash.xxh64_intdigest(text, 42)
    return value - (1 << 64) if value >> 63 else value


@dataclass
class Chunk:
    """The documents of a chunk in order, their words' codes in one array."""

    ids: list[int | None]
    order: list[int]  # of rows without an id
    words: list[list[bytes]]
    codes: np.ndarray
    starts: np.ndarray  # of each document, and the end of the last

    @classmethod
    def of(cls, table: pa.Table) -> Chunk:
        rows = sorted(((d, text_order(d, t), t or "")
                       for d, t in zip(table["doc_id"].to_pylist(), table["text"].to_pylist())),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        words = [t.encode().split() for _, _, t in rows]  # ASCII white space
        n = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(n)])
        codes = np.fromiter((_WORDS[w] for own in words for w in own), np.uint64, int(starts[-1]))
        return cls([r[0] for r in rows], [r[1] for r in rows], words, codes, starts)

    def places(self, size: int) -> np.ndarray:
        """Positions where a window of that size lies within one document."""
        n = max(0, len(self.codes) - size + 1)
        ok = np.ones(n, bool)
        for start in self.starts[1:-1]:
            ok[max(0, start - size + 1):start] = False
        return np.flatnonzero(ok)

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and order of the documents at these positions."""
        ids = np.array([LAST if d is None else d for d in self.ids], np.int64)
        own = self.owner(at)
        return ids[own], np.array(self.order, np.int64)[own]


def squeezed(values: np.ndarray) -> bytes:
    """64-bit numbers as eight byte planes, compressed: planes that hold little
    cost little."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def restored(data: bytes, kind: type = np.uint64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def packed(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as compressed differences."""
    return squeezed(np.diff(values, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(restored(data), dtype=np.uint64)


def bucket_edges(sorted_keys: np.ndarray, bits: int, n: int) -> np.ndarray:
    """Slices of sorted keys of that many bits by n equal ranges."""
    bounds = [(i << bits) // n for i in range(1, n)]
    return np.concatenate([[0], np.searchsorted(sorted_keys, np.array(bounds, np.uint64)), [len(sorted_keys)]])


ANCHOR, MANY = np.uint8(1), np.uint8(2)


def key_bits(text_bytes: int) -> int:
    """Bits of a block key: enough that a probe meets a strange anchor by
    chance once in some thousands (an anchor stands for about 50 bytes)."""
    return min(62, max(24, int(text_bytes // 50).bit_length() + 12))


def probes(chunk: Chunk, block: int, bits: int) -> np.ndarray:
    """Sorted distinct block keys, shifted by two bits for the flags ANCHOR
    (an anchor block of this chunk) and MANY (at several positions of it)."""
    at = chunk.places(block)
    keys = rolling(chunk.codes, block)[at] >> np.uint64(64 - bits) << np.uint64(1)
    keys |= ((at - chunk.starts[chunk.owner(at)]) % block == 0).astype(np.uint64)  # ANCHOR
    keys.sort()
    own = keys >> np.uint64(1)
    first = np.flatnonzero(np.diff(own, prepend=own[:1] + np.uint64(1)) != 0) if len(own) else own.astype(np.int64)
    size = np.diff(first, append=len(own))
    last = keys[first + size - 1]  # the flagged ones of a key come last
    return own[first] << np.uint64(2) | (last & ANCHOR) | np.where(size > 1, MANY, np.uint64(0))


def isin(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def gathered(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(values, number of the part) of all parts."""
    source = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), source


def dealt_back(values: np.ndarray, source: np.ndarray, n: int) -> list[np.ndarray]:
    """The values of each of ``n`` parts, in the order given."""
    order = np.argsort(source, kind="stable")
    return np.split(values[order], np.searchsorted(source[order], np.arange(1, n)))


def hit_anchors(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Of the chunks' probes in one bucket, for each chunk its keys that are
    anchors somewhere and stand at two positions or more."""
    values, source = gathered(parts)
    if not len(values):
        return parts
    order = np.argsort(values >> np.uint64(2), kind="stable")
    values, source = values[order], source[order]
    del order
    flags = (values & np.uint64(3)).astype(np.uint8)
    values >>= np.uint64(2)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    size = np.diff(first, append=len(values))
    any_flag = np.bitwise_or.reduceat(flags, first)
    hot = (any_flag & ANCHOR > 0) & ((size > 1) | (any_flag & MANY > 0))
    hot = np.repeat(hot, size)
    return dealt_back(values[hot], source[hot], len(parts))


def candidate_windows(chunk: Chunk, hot: np.ndarray, window: int,
                      bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes of windows that hold a hit, a second hash and the
    first position of each."""
    block = window // 2
    at = chunk.places(window)
    blocks = rolling(chunk.codes, block) >> np.uint64(64 - bits)
    hits = np.concatenate([[0], np.cumsum(isin(blocks, hot))])
    held = hits[at + window - block + 1] > hits[at]
    at = at[held]
    keys, first = np.unique(rolling(chunk.codes, window)[at], return_index=True)
    at = at[first]
    return keys, rolling(chunk.codes, window, _CHECK)[at], at


def earlier_elsewhere(keys: list[np.ndarray], checks: list[np.ndarray],
                      ids: list[np.ndarray], orders: list[np.ndarray]) -> list[np.ndarray]:
    """For each chunk its window keys whose first document is in another one.
    Equal keys with different checks are different windows."""
    values, source = gathered(keys)
    if not len(values):
        return keys
    check = np.concatenate(checks)
    order = np.lexsort((np.concatenate(orders), np.concatenate(ids), check, values))
    values, check, source = values[order], check[order], source[order]
    later = np.concatenate([[False], (values[1:] == values[:-1]) & (check[1:] == check[:-1])])
    return dealt_back(values[later], source[later], len(keys))


def repeats(chunk: Chunk, elsewhere: np.ndarray, window: int) -> np.ndarray:
    """Which words of the chunk a repeated window covers."""
    at = chunk.places(window)
    keys = rolling(chunk.codes, window)[at]
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    again |= isin(keys, elsewhere)
    step = np.zeros(len(chunk.codes) + 1, np.int64)
    np.add.at(step, at[again], 1)
    np.add.at(step, at[again] + window, -1)
    return np.cumsum(step[:-1]) > 0


def spans(covered: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return [{"first": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]


def remove_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed,
    text (the words that stay, joined by one space), removed (spans of word
    positions)."""
    if window < 2 or window % 2:
        raise ValueError("a window is an even number of words")
    python_ready(docs.sparkSession)
    block = window // 2
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n, bits = pieces(size, chunk_bytes), key_bits(size)
    n_buckets = max(min(n, FEW_BUCKETS), pieces(n, CHUNKS_A_BUCKET))
    usual = shuffle_partitions(docs.sparkSession)
    dealt = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .select(F.pmod(F.xxhash64("doc_id", F.expr("if(doc_id is null, text, null)")), F.lit(n))
                     .cast("int").alias("chunk"), "doc_id", "text"))

    def spread(rows: DataFrame, key: str, groups: int) -> DataFrame:
        """As many partitions as groups where that is more than the usual."""
        return rows.repartition(groups, key) if groups > usual else rows

    def send(number: int, keys: np.ndarray, width: int, columns: dict) -> pa.Table:
        edges = bucket_edges(keys, width, n_buckets)
        full = np.flatnonzero(np.diff(edges)).tolist()
        out = {"bucket": pa.array(full, pa.int32()), "chunk": pa.array([number] * len(full), pa.int32())}
        return pa.table(out | {name: pa.array([f(edges[b], edges[b + 1]) for b in full], pa.binary())
                               for name, f in columns.items()})

    def answer(table: pa.Table, found: list[np.ndarray]) -> pa.Table:
        full = [i for i, x in enumerate(found) if len(x)]
        return pa.table({"chunk": table["chunk"].take(pa.array(full, pa.int64())),
                         "bucket": table["bucket"].take(pa.array(full, pa.int64())),
                         "keys": pa.array([packed(found[i]) for i in full], pa.binary())})

    def told(table: pa.Table) -> np.ndarray:
        rows = sorted(zip(table["bucket"].to_pylist(), table["keys"].to_pylist()))
        return np.concatenate([unpacked(k) for _, k in rows] or [np.zeros(0, np.uint64)])

    def probe(key: tuple, table: pa.Table) -> pa.Table:
        values = probes(Chunk.of(table), block, bits)
        return send(key[0].as_py(), values, bits + 2, {"keys": lambda a, b: packed(values[a:b])})

    def hit(key: tuple, table: pa.Table) -> pa.Table:
        return answer(table, hit_anchors([unpacked(k) for k in table["keys"].to_pylist()]))

    def extend(key: tuple, table: pa.Table, hot: pa.Table) -> pa.Table:
        chunk = Chunk.of(table)
        keys, checks, at = candidate_windows(chunk, told(hot), window, bits)
        ids, orders = chunk.place(at)
        return send(key[0].as_py(), keys, 64, {"keys": lambda a, b: packed(keys[a:b]),
                                               "checks": lambda a, b: checks[a:b].tobytes(),
                                               "ids": lambda a, b: squeezed(ids[a:b]),
                                               "orders": lambda a, b: squeezed(orders[a:b])})

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        keys = [unpacked(x) for x in table["keys"].to_pylist()]
        checks = [np.frombuffer(x, np.uint64) for x in table["checks"].to_pylist()]
        ids = [restored(x, np.int64) for x in table["ids"].to_pylist()]
        orders = [restored(x, np.int64) for x in table["orders"].to_pylist()]
        return answer(table, earlier_elsewhere(keys, checks, ids, orders))

    def strip(key: tuple, table: pa.Table, elsewhere: pa.Table) -> pa.Table:
        chunk = Chunk.of(table)
        covered = repeats(chunk, told(elsewhere), window)
        removed, texts, gone = [], [], []
        for i, words in enumerate(chunk.words):
            own = covered[chunk.starts[i]:chunk.starts[i + 1]]
            gone.append(int(own.sum()))
            removed.append(spans(own) if gone[-1] else [])
            kept = [w for w, c in zip(words, own.tolist()) if not c] if gone[-1] else words
            texts.append(b" ".join(kept).decode())
        span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        return pa.table({"doc_id": pa.array(chunk.ids, pa.int64()),
                         "n_words": pa.array([len(w) for w in chunk.words], pa.int64()),
                         "n_removed": pa.array(gone, pa.int64()), "text": pa.array(texts, pa.string()),
                         "removed": pa.array(removed, span)})

    chunks = spread(dealt, "chunk", n).groupBy("chunk")
    message, reply = "bucket int, chunk int, keys binary", "chunk int, bucket int, keys binary"

    def asked(messages: DataFrame, of: Callable) -> DataFrame:
        found = spread(messages, "bucket", n_buckets).groupBy("bucket").applyInArrow(of, reply)
        return spread(found, "chunk", n).groupBy("chunk")

    hot = asked(chunks.applyInArrow(probe, message), hit)
    known = asked(chunks.cogroup(hot).applyInArrow(extend, message + ", checks binary, ids binary, orders binary"),
                  compare)
    return chunks.cogroup(known).applyInArrow(
        strip, "doc_id long, n_words long, n_removed long, text string, removed array<struct<first:int,end:int>>")
