"""Ranked lexical search over posting lists in geometric blocks.

The index is built of shards of documents. In a shard every term has a posting
list; a long list is clustered by the similarity of its documents (each goes to
the nearest of a few of them, by a small projection of their term vectors) and
so cut into blocks. A block's summary is the coordinatewise maximum of its
documents' term impacts, rounded up to one byte: multiplied by an item's term
weights it bounds the score of every document in the block from above. An item
visits the blocks of its own terms' lists, best bound first, and skips a block
only when its bound lies below the tenth score found so far; nothing else is
left out, so results are exact.

Lists are visited from the heaviest term on. A document of a later list that
holds an earlier term was met there (scored, or skipped with proof), so a
block's bound counts only the terms from its own list on.

*Distribution.* One pass over the texts writes each document's length and its
counts of the items' terms; the corpus' statistics are sums over that table. One
pass over that small table writes the shards; one pass over the shards searches
them, each task keeping its ten best documents per item, whose scores raise the
bar for its later shards. Nothing is shuffled but statistics and candidates.

*Items* come in batches of at most ``MOST_TERMS`` distinct terms (a batch is
the only thing the driver reads, and bounds a shard's width); every batch is a
pass of its own.

Defined cases: a document without terms and a null text are in no result.
Repeated documents are ranked each by itself. Null ids rank behind others of
equal score. Rows of one item id count as one item, with its least text. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.common import cut, pieces, python_ready

K1_SCALE, LENGTH_SHARE = 1000, 75
TOP = 10
#: distinct terms of one batch of items; a shard's tables are this wide at most
MOST_TERMS = 8192
#: a shard holds at most so many documents and postings (a longer document is
#: a shard of its own)
SHARD_DOCS, SHARD_POSTINGS = 4096, 1_000_000
#: documents in a block, about; shorter lists are one block
BLOCK = 128
#: impacts are below 1,000,000; a summary holds them in steps of this size
STEP = 4000
#: numbers that stand for a document when posting lists are clustered
SKETCH = 16
#: documents scored before bounds are compared with what they gave
FIRST = 256
NO_ID = np.iinfo(np.int64).max

#: separators (and capitals) of the term pattern, byte by byte; all bytes of
#: characters beyond ASCII belong to terms
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal matches of the term pattern, A-Z lower-cased, in UTF-8."""
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


# --- statistics ---------------------------------------------------------------

def _counted(batches: Iterator[pa.RecordBatch], numbers: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Per document with a term: its length, and numbers and counts of the
    vocabulary's terms in it."""
    for batch in batches:
        ids, lengths, held, counts = [], [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = terms(text)
            if not words:
                continue
            found = [n for n in map(numbers.get, words) if n is not None]
            own, times = np.unique(np.asarray(found, np.int32), return_counts=True)
            ids.append(doc_id)
            lengths.append(len(words))
            held.append(own.tobytes())
            counts.append(times.astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(held, pa.binary()),
             pa.array(counts, pa.binary())], ["doc_id", "length", "terms", "counts"])


def count_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, length, terms, counts`` of every document that has a term."""
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        lambda batches: _counted(batches, shared.value),
        "doc_id bigint, length bigint, terms binary, counts binary")


def statistics(counted: DataFrame, width: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms and the documents of each term (``width`` numbers): the
    sums of one row of counts per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, docs, total = np.zeros(width, np.int64), 0, 0
        for batch in batches:
            docs += batch.num_rows
            total += int(np.sum(batch.column("length").to_numpy(zero_copy_only=False)))
            numbers = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32)
            holding += np.bincount(numbers, minlength=width)
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([some, [-1, -2]]), pa.int64()),
             pa.array(np.concatenate([holding[some], [docs, total]]), pa.int64())], ["term", "n"])
    rows = (counted.select("length", "terms").mapInArrow(run, "term bigint, n bigint")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())
    found = {term: n for term, n in rows}
    holding = np.zeros(width, np.int64)
    for term, n in found.items():
        if term >= 0:
            holding[term] = n
    return found.get(-1, 0), found.get(-2, 0), holding


def weights(docs: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(df) + 1))) for df in holding], np.int64)


def impacts(counts: np.ndarray, lengths: np.ndarray, docs: int, total: int) -> np.ndarray:
    """A term's share of a document's score, without the term's weight."""
    spread = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * docs) // total
    return (1_000_000_000 * counts) // (K1_SCALE * counts + 8 * spread)


# --- index --------------------------------------------------------------------

def _blocks(members: np.ndarray, sketches: np.ndarray) -> list[np.ndarray]:
    """A posting list's documents, clustered by similarity."""
    centres = pieces(len(members), BLOCK)
    if centres == 1:
        return [members]
    own = sketches[members]
    nearest = np.argmax(own @ own[np.linspace(0, len(members) - 1, centres).astype(int)].T, axis=1)
    order = np.argsort(nearest, kind="stable")
    groups = np.split(members[order], np.flatnonzero(np.diff(nearest[order])) + 1)
    return [part for g in groups for part in np.array_split(g, pieces(len(g), 2 * BLOCK))]


def _summaries(dense: np.ndarray, blocks: list[np.ndarray]) -> np.ndarray:
    out = np.empty((len(blocks), dense.shape[1]), np.uint8)
    for i, block in enumerate(blocks):
        np.max(dense[block], axis=0, out=out[i])
    return out


def _shard(rows: list[tuple], docs: int, total: int, weight: np.ndarray, sketch: np.ndarray) -> dict:
    """The index of some documents (doc_id, length, terms, counts)."""
    ids = np.array([NO_ID if r[0] is None else r[0] for r in rows], np.int64)
    sizes = np.array([len(r[2]) // 4 for r in rows])
    held = np.frombuffer(b"".join(r[2] for r in rows), np.int32)
    counts = np.frombuffer(b"".join(r[3] for r in rows), np.int32).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    worth = impacts(counts, np.repeat(np.array([r[1] for r in rows], np.int64), sizes), docs, total)
    dense = np.zeros((len(rows), len(weight)), np.uint8)
    dense[owner, held] = -(-worth // STEP)
    scored = np.zeros((len(rows), len(weight)), np.float32)
    scored[owner, held] = worth * weight[held] / 1e9
    sketches = scored @ sketch
    del scored
    by_term = np.argsort(held, kind="stable")
    starts = np.flatnonzero(np.diff(held[by_term], prepend=-1))
    blocks, lists = [], []
    for members in np.split(owner[by_term], starts[1:]) if len(held) else []:
        cut_up = _blocks(members, sketches)
        blocks += cut_up
        lists.append(len(cut_up))
    return {"ids": ids.tobytes(), "sizes": sizes.astype(np.int32).tobytes(), "terms": held.tobytes(),
            "impacts": worth.astype(np.int32).tobytes(),
            "lists": held[by_term][starts].astype(np.int32).tobytes() if len(held) else b"",
            "list_blocks": np.array(lists, np.int32).tobytes(),
            "block_sizes": np.array([len(b) for b in blocks], np.int32).tobytes(),
            "postings": (np.concatenate(blocks) if blocks else np.empty(0)).astype(np.int32).tobytes(),
            "summaries": _summaries(dense, blocks).tobytes()}


INDEX = ["ids", "sizes", "terms", "impacts", "lists", "list_blocks", "block_sizes", "postings", "summaries"]


def build_index(counted: DataFrame, docs: int, total: int, weight: np.ndarray) -> DataFrame:
    """Shards of ``count_terms``' documents, one row each (binary arrays)."""
    sketch = np.random.default_rng(11).choice([-1.0, 1.0], (len(weight), SKETCH)).astype(np.float32)
    shared = counted.sparkSession.sparkContext.broadcast((weight, sketch))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, sketch = shared.value
        rows, postings = [], 0

        def shard() -> pa.RecordBatch:
            built = _shard(rows, docs, total, weight, sketch)
            return pa.RecordBatch.from_arrays([pa.array([built[c]], pa.binary()) for c in INDEX], INDEX)
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "length", "terms", "counts"))):
                if not row[2]:
                    continue
                if rows and (len(rows) >= SHARD_DOCS or postings + len(row[2]) // 4 > SHARD_POSTINGS):
                    yield shard()
                    rows, postings = [], 0
                rows.append(row)
                postings += len(row[2]) // 4
        if rows:
            yield shard()
    return counted.mapInArrow(run, ", ".join(f"{c} binary" for c in INDEX))


# --- search -------------------------------------------------------------------

class Shard:
    def __init__(self, row: dict, width: int) -> None:
        a = {c: np.frombuffer(row[c], np.int32) for c in INDEX if c not in ("ids", "summaries")}
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.impacts = np.zeros((width, len(self.ids)), np.int32)
        self.impacts[a["terms"], np.repeat(np.arange(len(self.ids)), a["sizes"])] = a["impacts"]
        self.summaries = np.frombuffer(row["summaries"], np.uint8).reshape(-1, width)
        ends = np.cumsum(a["list_blocks"])
        #: term -> the range of its list's blocks
        self.lists = dict(zip(a["lists"].tolist(), zip((ends - a["list_blocks"]).tolist(), ends.tolist())))
        self.at = np.concatenate([[0], np.cumsum(a["block_sizes"])])
        self.postings = a["postings"]

    def docs(self, blocks: np.ndarray) -> np.ndarray:
        return np.unique(np.concatenate([self.postings[self.at[b]:self.at[b + 1]] for b in blocks]))


class Best:
    """An item's best documents so far, by falling score and rising id."""

    def __init__(self, limit: int) -> None:
        self.limit, self.scores, self.ids = limit, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def bar(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.limit else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.bar
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[:self.limit]
        self.scores, self.ids = scores[order], ids[order]


def visit(shard: Shard, own: np.ndarray, weight: np.ndarray, best: Best) -> tuple[int, int]:
    """Searches one shard for an item: ``own`` are its distinct terms, heaviest
    first, ``weight`` their weights times their repeats. Returns how many blocks
    were there and how many were skipped."""
    there = [j for j, t in enumerate(own.tolist()) if t in shard.lists]
    if not there:
        return 0, 0
    own, weight = own[there], weight[there]
    ranges = [shard.lists[t] for t in own.tolist()]
    blocks = np.concatenate([np.arange(a, b) for a, b in ranges])
    place = np.repeat(np.arange(len(ranges)), [b - a for a, b in ranges])
    later = np.arange(len(own)) >= place[:, None]
    bounds = (shard.summaries[np.ix_(blocks, own)].astype(np.int64) * STEP * later) @ weight
    order = np.argsort(-bounds, kind="stable")
    blocks, bounds = blocks[order], bounds[order]
    rows, seen, at, skipped = shard.impacts[own], np.zeros(len(shard.ids), bool), 0, 0
    batch = pieces(FIRST, BLOCK)
    while at < len(blocks):
        if bounds[at] < best.bar:   # and so all that follow
            skipped = len(blocks) - at
            break
        docs = shard.docs(blocks[at:at + batch][bounds[at:at + batch] >= best.bar])
        docs = docs[~seen[docs]]
        seen[docs] = True
        best.add(weight @ rows[:, docs].astype(np.int64), shard.ids[docs])
        at, batch = at + batch, batch * 2
    return len(blocks), skipped


def _queries(batch: list[list[bytes]], numbers: dict[bytes, int], weight: np.ndarray) -> list[tuple]:
    out = []
    for words in batch:
        own, repeats = np.unique(np.array([numbers[w] for w in words], np.int64), return_counts=True)
        worth = weight[own] * repeats
        order = np.argsort(-worth, kind="stable")
        order = order[worth[order] > 0]
        out.append((own[order], worth[order]))
    return out


def search_index(index: DataFrame, queries: list[tuple], width: int, limit: int = TOP) -> DataFrame:
    """``item`` (place in ``queries``), ``doc_id``, ``score``: the best documents
    of every task; and, as item -1 and -2, the blocks met and skipped."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, met, skipped = [Best(limit) for _ in shared.value], 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, width)
                for (own, weight), best in zip(shared.value, found):
                    if len(own):
                        a, b = visit(shard, own, weight, best)
                        met, skipped = met + a, skipped + b
        items = np.repeat(np.arange(len(found)), [len(b.ids) for b in found])
        ids = np.concatenate([b.ids for b in found] + [np.empty(0, np.int64)])
        scores = np.concatenate([b.scores for b in found] + [np.empty(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([items, [-1, -2]]), pa.int64()),
             pa.array(np.concatenate([ids, [0, 0]]), pa.int64(), mask=np.concatenate([ids == NO_ID, [True, True]])),
             pa.array(np.concatenate([scores, [met, skipped]]), pa.int64())], ["item", "doc_id", "score"])
    return index.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _batches(items: DataFrame) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Items and their terms, in batches of at most ``MOST_TERMS`` distinct
    terms (an item with more is a batch of its own). Read item by item, a
    partition at a time."""
    ids, texts, held = [], [], set()
    own = items.groupBy("item_id").agg(F.min("text").alias("text"))
    for item_id, text in own.toLocalIterator():
        words = terms(text)
        if not words:
            continue
        if ids and len(held | set(words)) > MOST_TERMS:
            yield ids, texts
            ids, texts, held = [], [], set()
        ids.append(item_id)
        texts.append(words)
        held |= set(words)
    if ids:
        yield ids, texts


def search(docs: DataFrame, items: DataFrame, limit: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``limit`` best documents of every
    item (``item_id, text``) with a score above 0."""
    spark = docs.sparkSession
    id_type = items.schema["item_id"].dataType.simpleString()
    out = None
    for ids, batch in _batches(items):
        vocabulary = sorted({w for words in batch for w in words})
        counted = cut(count_terms(docs, vocabulary))
        n_docs, total, holding = statistics(counted, len(vocabulary))
        if not n_docs:
            continue
        weight = weights(n_docs, holding)
        index = cut(build_index(counted, n_docs, total, weight))
        queries = _queries(batch, {t: i for i, t in enumerate(vocabulary)}, weight)
        found = search_index(index, queries, len(vocabulary), limit).filter("item >= 0")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
        names = spark.createDataFrame(list(enumerate(ids)), f"item bigint, item_id {id_type}")
        part = ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id bigint, score bigint")
    return out


ORACLE = r"""
WITH split AS (
  SELECT doc_id, rn, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS rn FROM documents)),
held AS (SELECT rn, doc_id, term, count(*) AS tf FROM split GROUP BY 1, 2, 3),
size AS (SELECT rn, sum(tf) AS n FROM held GROUP BY 1),
corpus AS (SELECT count(*) AS docs, sum(n) AS total FROM size),
word AS (SELECT term, CAST(floor(1000 * ln((2.0 * docs + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w
         FROM held, corpus GROUP BY term, docs),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY 1, 2),
scored AS (
  SELECT a.item_id, h.doc_id, h.rn,
         CAST(sum(a.times * w.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (25 + (75 * s.n * c.docs) // c.total)))) AS BIGINT)
           AS score
  FROM asked a JOIN held h ON h.term = a.term JOIN word w ON w.term = a.term JOIN size s ON s.rn = h.rn, corpus c
  GROUP BY 1, 2, 3)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
