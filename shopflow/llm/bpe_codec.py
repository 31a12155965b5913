"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token exactly one token can be the last of its
encoding. An automaton over all tokens (suffix links) gives the tokens that
end at a position; the one whose pair with the last token of the shorter
prefix survives is stored. Back-pointers from the end give the exact ids.

Two neighbours survive if no merge across their border is ever applied: for
each symbol x that stands at the right edge of the left token at some time,
and y at the left edge of the right one, the merge (x, y) must come later than
the merge that consumes x or y inside its token.

Both directions are map-only, and ``round_trip`` does them in one pass. Workers remember the ids of a bounded number of
short units (text between spaces) and pairs.

Defined cases: null and empty texts have no ids and decode to the empty
string; special strings become their id; repeated rows are encoded alike;
other columns are not carried.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopflow.llm import bpe
from shopflow.llm.common import python_ready, sliced

NEVER = 1 << 60


class Encoder:
    def __init__(self, vocab: bpe.Vocabulary) -> None:
        self.vocab = vocab
        self.parts = {made: (pair, rank) for pair, (rank, made) in vocab.merges.items()}
        self.left, self.right = {}, {}
        for byte_id in vocab.byte_ids:
            self.left[byte_id] = self.right[byte_id] = [(byte_id, NEVER)]
        automaton = ahocorasick.Automaton()
        self.length = {}
        for token in [*vocab.byte_ids, *self.parts]:  # merges in rank order: parts come first
            if token in self.parts:
                (a, b), rank = self.parts[token]
                if a not in self.length or b not in self.length or not self._borders(a, b, rank):
                    continue  # never the encoding of its own bytes
                self.left[token] = [(x, min(d, rank)) for x, d in self.left[a]] + [(token, NEVER)]
                self.right[token] = [(x, min(d, rank)) for x, d in self.right[b]] + [(token, NEVER)]
            spelled = vocab.tokens[token]
            self.length[token] = len(spelled)
            automaton.add_word(spelled.decode("latin-1"), (token, len(spelled)))
        automaton.make_automaton()
        self.automaton = automaton
        self.pairs: dict[int, bool] = {}

    def _borders(self, a: int, b: int, until: int) -> bool:
        """No merge across the border of a and b is applied before ``until``."""
        merges = self.vocab.merges
        for x, x_gone in self.right[a]:
            for y, y_gone in self.left[b]:
                hit = merges.get((x, y))
                # equal ranks: the occurrence further left comes first
                if hit and hit[0] < until and hit[0] < x_gone and hit[0] <= y_gone:
                    return False
        return True

    def encode(self, pretoken: str) -> list[int]:
        spelled = pretoken.encode().decode("latin-1")
        last = [-1] * (len(spelled) + 1)
        pairs = self.pairs
        for end, (token, length) in self.automaton.iter(spelled):
            if last[end + 1] >= 0:
                continue
            before = last[end + 1 - length]
            if before >= 0:
                pair = before << 32 | token
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self._borders(before, token, NEVER)
            else:
                fits = True  # the prefix is the token
            if fits:
                last[end + 1] = token
        ids, at = [], len(spelled)
        while at:
            ids.append(last[at])
            at -= self.length[last[at]]
        ids.reverse()
        return ids


class Known(dict):
    """Pre-token without the text ``before`` it -> its ids as little-endian
    32-bit numbers. Frequent pre-tokens come early; a full cache stays."""

    def __init__(self, encoder: Encoder, before: str) -> None:
        self.encoder, self.before = encoder, before

    def __missing__(self, part: str) -> bytes:
        ids = packed(self.encoder.encode(self.before + part))
        if len(part) <= bpe.CACHED_LENGTH and len(self) < bpe.CACHE_ENTRIES:
            self[part] = ids
        return ids


class Units(dict):
    """Text between two spaces -> ids of the unit that starts with the first
    of them. Only units of one pre-token, or one and a full stop or comma, are
    looked up as a whole."""

    def __init__(self, codec: Codec) -> None:
        self.codec = codec

    def __missing__(self, unit: str) -> bytes:
        codec = self.codec
        if unit.isalpha():
            return codec.spaced[unit]
        if unit[-1:] in (",", ".") and unit[:-1].isalpha():
            ids = codec.spaced[unit[:-1]] + codec.bare[unit[-1]]
            if len(unit) <= bpe.CACHED_LENGTH and len(self) < bpe.CACHE_ENTRIES // 4:
                self[unit] = ids
            return ids
        return codec.plain(" " + unit)


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    def __init__(self, vocab: bpe.Vocabulary) -> None:
        self.vocab, self.encoder = vocab, Encoder(vocab)
        self.spaced, self.bare = Known(self.encoder, " "), Known(self.encoder, "")
        self.units = Units(self)

    def plain(self, text: str) -> bytes:
        """Ids of text without special strings."""
        spaced, bare = self.spaced, self.bare
        return b"".join([spaced[p[1:]] if p[0] == " " else bare[p] for p in bpe.pretokens(text)])

    def encode(self, text: str) -> bytes:
        out = []
        for segment in self.vocab.segments(text):
            if isinstance(segment, int):
                out.append(packed([segment]))
                continue
            cut = bpe.units(segment)
            if cut:
                out.append(self.plain(cut[0]))
                spaced, units = self.spaced, self.units
                out.extend([spaced.get(u) or units[u] for u in cut[1]])
            else:
                out.append(self.plain(segment))
        if len(self.encoder.pairs) > bpe.CACHE_ENTRIES:
            self.encoder.pairs.clear()
        return b"".join(out)


class Decoder:
    def __init__(self, vocab: bpe.Vocabulary) -> None:
        self.spelled = [vocab.tokens.get(i, b"") for i in range(max(vocab.tokens) + 1)]

    def decode(self, ids: bytes) -> str:
        spelled = b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return spelled.decode("utf-8", "replace")


_CODECS: dict[int, Codec] = {}


def codec(file_text: str) -> Codec:
    vocab = bpe.vocabulary(file_text)
    if id(vocab) not in _CODECS:
        _CODECS.clear()
        _CODECS[id(vocab)] = Codec(vocab)
    return _CODECS[id(vocab)]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (binary, 4 bytes a token) of every row (doc_id, text)."""
    python_ready(docs.sparkSession)
    shared = bpe.share(docs.sparkSession, path)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in sliced(batches):
            ids = [own.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the column text."""
    python_ready(encoded.sparkSession)
    shared = bpe.share(encoded.sparkSession, path)
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Decoder(bpe.vocabulary(shared.value))
        for batch in sliced(batches):
            texts = [own.decode(i or b"") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "ids"]).columns, pa.array(texts, pa.string())],
                ["doc_id", "ids", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {id_type}, ids binary, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text that the ids decode to, in one pass through one
    worker a task."""
    python_ready(docs.sparkSession)
    shared = bpe.share(docs.sparkSession, path)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = codec(shared.value), Decoder(bpe.vocabulary(shared.value))
        for batch in sliced(batches):
            ids = [encoder.encode(t or "") for t in batch.column("text").to_pylist()]
            texts = [decoder.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                ["doc_id", "ids", "text"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, ids binary, text string")
