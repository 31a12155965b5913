"""BPE codec and token counts against the tokenizers library."""

import hashlib
import itertools
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopflow.llm import bpe, bpe_codec, queries, token_counts
from tests.conftest import SF001
from tests.llm import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b", "the", " ", "  ", "   ", "\n", "\t", "'s", "'", "'ll", "1", "²", "Ⅷ", "é", "ß", "漢", "🙂", "\x1c",
          "\x85", "\u2009", "\u200b", "<|endoftext|>", "!", "--", "aaaa", "x" * 50, "\u0301", "_", "\r\n", "\x0b", ",", "."]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    made = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30))) for _ in range(5000)]
    return [*made, "a" * 5000, " " * 3000, "\n" * 500, "ab" * 3000, cases.words(1, 3000), *(r[1] or "" for r in cases.rows())]


@pytest.fixture(scope="module")
def file_text():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


def test_codec_equals_the_library(library, texts, file_text):
    codec, decoder = bpe_codec.codec(file_text), bpe_codec.Decoder(bpe.vocabulary(file_text))
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    ids = [codec.encode(t) for t in texts]
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == expected
    assert [decoder.decode(i) for i in ids] == library.decode_batch(expected, skip_special_tokens=False)


def test_full_caches_change_nothing(library, texts, file_text, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    vocab = bpe.parse(file_text)
    codec, counter = bpe_codec.Codec(vocab), token_counts.Counter(vocab)
    some = texts[:300]
    expected = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    assert [np.frombuffer(codec.encode(t), "<u4").tolist() for t in some] == expected
    assert counter.count(some) == list(map(len, expected))


def test_counts_equal_the_library(library, texts, file_text):
    counts = token_counts.counter(file_text).count(texts)
    assert counts == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_white_runs_with_a_vocabulary_that_merges_them():
    """Cutting at spaces does not part what the pattern keeps together."""
    spelled = {b: c for c, b in bpe.byte_characters().items()}
    space, line, tab, letter = (spelled[ord(c)] for c in " \n\ta")
    merges = [(space, space), (line, space), (space, line), (tab, space), (space, letter), (space * 2, space)]
    tokens = [*spelled.values(), *(a + b for a, b in merges)]
    file_text = json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "normalizer": None, "post_processor": None,
        "added_tokens": [{"id": len(tokens), "content": "<|end|>", "single_word": False, "lstrip": False,
                          "rstrip": False, "normalized": False, "special": True}],
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
        "decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True},
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False,
                  "vocab": {t: i for i, t in enumerate(tokens)}, "merges": [list(m) for m in merges]}})
    library = Tokenizer.from_str(file_text)
    made = ["".join(x) for n in range(1, 6) for x in itertools.product(" \n\ta", repeat=n)]
    made += [x + "<|end|>" + y for x in made[:84] for y in ("", "  ", "a \n ")]
    expected = [e.ids for e in library.encode_batch(made, add_special_tokens=False)]
    codec, counter = bpe_codec.Codec(bpe.parse(file_text)), token_counts.Counter(bpe.parse(file_text))
    assert [np.frombuffer(codec.encode(t), "<u4").tolist() for t in made] == expected
    assert counter.count(made) == list(map(len, expected))


def test_queries(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in queries.QUERIES["op3_bpe_codec"](spark, SF001).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    counted = queries.QUERIES["op9_token_counts"](spark, SF001).collect()
    assert len(counted) == len(docs)
    for r in counted:
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


def test_edges(spark):
    docs = cases.frame(spark, clash=True)
    encoded = bpe_codec.encode(docs, PATH)
    back = bpe_codec.decode(encoded, PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in back) == sorted(
        (r[0] is None, r[0] or 0, r[1] or "") for r in cases.rows())
    counted = token_counts.count_tokens(docs, PATH).collect()
    assert sum(r.n_tokens for r in counted) == sum(len(r.ids) // 4 for r in encoded.collect())
    assert bpe_codec.encode(docs.limit(0), PATH).count() == 0
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError), open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        bpe.parse(f.read())
