"""What the byte-level BPE operators share: the vocabulary of a public
tokenizer file, and the cutting of texts into units that are encoded alone.

A tokenizer file is a few megabytes and does not grow with the data, so its
text is broadcast; workers parse it once.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field

import regex
from pyspark.sql import SparkSession

#: fixed value: the byte-level pre-tokenizer's pattern
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRETOKEN = regex.compile(PATTERN)
#: a space that may not start a new unit: it stands inside a longer white run,
#: or ends one at the end of the text
_INNER_SPACE = re.compile(r"\s (?:\s|\Z)")
#: entries that a worker's cache holds at most (some 200 bytes each)
CACHE_ENTRIES = 150_000
#: longer units are encoded without being kept
CACHED_LENGTH = 64


def byte_characters() -> dict[str, int]:
    """Character -> byte of the printable alphabet in which byte-level files
    spell their tokens: printable Latin-1 bytes stand for themselves, the
    others for the characters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass
class Vocabulary:
    """tokens: id -> bytes. merges: (left id, right id) -> (rank, merged id).
    specials: text -> id, matched in texts before anything else."""

    tokens: dict[int, bytes]
    merges: dict[tuple[int, int], tuple[int, int]]
    byte_ids: list[int]
    specials: dict[str, int]
    _special: re.Pattern | None = field(default=None)

    def __post_init__(self) -> None:
        longest = sorted(self.specials, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def segments(self, text: str) -> list[str | int]:
        """Runs of ordinary text, and the ids of special strings between them."""
        if self._special is None or not any(s in text for s in self.specials):
            return [text] if text else []
        return [self.specials.get(s, s) for s in self._special.split(text) if s]


def parse(file_text: str) -> Vocabulary:
    spec = json.loads(file_text)
    model = spec["model"]
    if model["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel" \
            or spec["pre_tokenizer"].get("add_prefix_space") or model.get("ignore_merges"):
        raise ValueError("a plain byte-level BPE file is expected")
    added = spec.get("added_tokens") or []
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
        raise ValueError("added tokens that strip or need whole words are not supported")
    to_byte = byte_characters()
    specials = {a["content"]: a["id"] for a in added}
    tokens = {i: bytes(map(to_byte.__getitem__, s)) for s, i in model["vocab"].items() if s not in specials}
    tokens |= {i: s.encode() for s, i in specials.items()}
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[model["vocab"][left], model["vocab"][right]] = (rank, model["vocab"][left + right])
    byte_ids = [0] * 256
    for character, byte in to_byte.items():
        byte_ids[byte] = model["vocab"][character]
    return Vocabulary(tokens, merges, byte_ids, specials)


_PARSED: dict[str, Vocabulary] = {}


def vocabulary(file_text: str) -> Vocabulary:
    """The parsed file, kept for the life of the worker."""
    key = hashlib.md5(file_text.encode()).hexdigest()
    if key not in _PARSED:
        _PARSED.clear()
        _PARSED[key] = parse(file_text)
    return _PARSED[key]


def share(spark: SparkSession, path: str):
    """Broadcast of the tokenizer file's text (fixed size)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def pretokens(text: str) -> list[str]:
    return _PRETOKEN.findall(text)


def units(text: str) -> tuple[str, list[str]] | None:
    """Text cut at its spaces: the first unit, and the others without the
    space they start with. None where white space does not allow it.

    Before a space with a visible neighbour a pre-token ends: the pattern joins
    a space to the visible character that follows it, and starts a white run
    with it after a visible one. So units can be pre-tokenized, and remembered, alone."""
    if _INNER_SPACE.search(text):
        return None
    first, *rest = text.split(" ")
    return first, rest
