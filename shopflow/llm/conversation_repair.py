"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is well formed when its role initials read ``(s?(ua)+)?``. Four
states say what has been put out so far: nothing, a system turn, a user turn
that waits for its answer, an answer. Every row is one edit (Keep, Rerole,
Delete), with Insert edits before it or at the end, so a row is a table of least
costs from state to state. The cheapest edits of a conversation are found as
Hirschberg finds an alignment: the cost vector that runs forward over the first
half and the one that runs backward over the second meet in the middle, the best
crossing state is fixed, and both halves are solved the same way with their end
states known. Only two vectors of four numbers are held at a time.

*Ties.* The audit is the string of the edits' initials; of equally cheap ones
the ASCII-least is wanted. Forward vectors carry, next to every cost, the rank
of the least audit that reaches the state at this cost. Two audits that end in a
row's edit after the same rows are never one the prefix of the other, so ranks
can be carried on without the strings, and the least rank among the optimal
crossings is the audit-least crossing.

*Distribution.* Rows are sorted over all partitions by conversation and turn, so
a conversation of any size is spread over as many partitions as its rows fill.
A partition's rows of one conversation are a fragment. Only a partition's first
and last fragment can belong to a conversation that goes on elsewhere: their
tables of costs and ranks (at most two per partition, 16 numbers each) go to the
driver, where the same crossing rule fixes the states between fragments. Then
all fragments are solved where they lie.

Defined cases: a null role or text is one space, a null id or turn is one space
in the damage key. Null ids are one conversation. Rows of equal turn come in the
order of role and text; equal rows are adjacent (and count as duplicates). Other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import cut, python_ready

#: edits' costs
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ANSWER = range(4)
STATES = range(4)
#: the state that a user or assistant turn leads to, from every state
NEXT = (USER, USER, ANSWER, USER)
#: edits that close a conversation in a state
CLOSE = ("", "II", "I", "")
#: rows that must go have one kind; others are (initial's number, truncated)
FORCED = 8
INITIALS = {"s": 0, "u": 1, "a": 2}
KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ANSWER: USER}, {USER: ANSWER}, {})

BLANK, DUPLICATE, CUT_OFF = "blank", "duplicate", "truncated"
#: bytes of text that a task gathers before it sends rows on
FLUSH = 4 << 20


# --- damage and faults (DataFrame expressions) --------------------------------

def _spaced(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after the damage that the key's
    checksum deals out; dropped rows stay with 0 copies, so no conversation is
    lost from sight."""
    fate = F.crc32(F.concat(_spaced(F.col("conv_id")), F.lit(":"), _spaced(F.col("turn"))).cast("binary")) % 20
    text = _spaced(F.col("text"))
    return rows.select(
        "conv_id", "turn",
        F.when(fate == 4, "user").otherwise(_spaced(F.col("role"))).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """One row per distinct ``conv_id, turn, role, text`` with its ``copies``
    and the ``fault`` of the first one (later copies of it are duplicates).
    ``rows`` needs those four columns; without ``copies`` each counts once."""
    if "copies" not in rows.columns:
        rows = rows.withColumn("copies", F.lit(1))
    alike = (rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
             .withColumn("digest", F.sha2("text", 256)))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = (alike.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(order).alias("first"))
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    shown = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    fault = (F.when(shown == "", BLANK)
             .when(~F.col("first").eqNullSafe(order), DUPLICATE)
             .when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), CUT_OFF))
    return alike.join(first, same, "left").select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


def counts(judged: DataFrame) -> DataFrame:
    """Per conversation: gaps in its turns and rows of each fault."""
    there = F.col("copies") > 0
    turn = F.when(there, F.col("turn"))
    extra = F.when(there & (F.col("fault").isNull() | (F.col("fault") == CUT_OFF)), F.col("copies") - 1)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return judged.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("bigint").alias("gaps"),
        total(F.when(F.col("fault") == BLANK, F.col("copies"))).alias("blank"),
        total(F.when(F.col("fault") == DUPLICATE, F.col("copies")).otherwise(extra)).alias("duplicate"),
        total(F.when(there & (F.col("fault") == CUT_OFF), 1)).alias("truncated"))


# --- the four-state tables ----------------------------------------------------

def _edits(kind: int) -> dict[tuple[int, int], tuple[int, str]]:
    """From (state, state) to the least (cost, edits) that consume one row of
    this kind, insertions before it included."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in STATES:
        state = start
        for inserted in range(len(STATES)):
            after = {(state, DELETE, "D")}
            if kind != FORCED:
                initial, extra = kind // 2, TRUNCATED * (kind % 2)
                after.add((NEXT[state], REROLE + extra, "R"))
                if state in KEPT[initial]:
                    after.add((KEPT[initial][state], extra, "K"))
            for end, cost, edit in after:
                found = (cost + INSERT * inserted, "I" * inserted + edit)
                best[start, end] = min(best.get((start, end), found), found)
            state = NEXT[state]
    return best


STEPS = [_edits(kind) for kind in range(FORCED + 1)]
#: cost and rank by state; None is out of reach
Vector = tuple[tuple[int, int] | None, ...]


def entering(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in STATES)


def _lowered(vector: list) -> tuple[Vector, int]:
    least = min(x[0] for x in vector if x)
    return tuple(x and (x[0] - least, x[1]) for x in vector), least


def _ranked(found: dict[int, tuple]) -> list:
    """``found``: state -> (cost, what its least audit compares by)."""
    order = {key: i for i, key in enumerate(sorted(key for _, key in found.values()))}
    return [(found[s][0], order[found[s][1]]) if s in found else None for s in STATES]


class Vectors:
    """Forward and backward steps; vectors with the same differences are
    stepped once."""

    def __init__(self) -> None:
        self.ahead: dict = {}
        self.back: dict = {}

    def forward(self, vector: Vector, kinds: bytes) -> tuple[Vector, int]:
        """The vector after these rows, lowered to a least cost of 0, and by
        how much."""
        vector, total = _lowered(list(vector))
        for kind in kinds:
            key = vector, kind
            if key not in self.ahead:
                found: dict[int, tuple] = {}
                for (a, b), (cost, edits) in STEPS[kind].items():
                    if vector[a]:
                        new = (vector[a][0] + cost, (vector[a][1], edits))
                        found[b] = min(found.get(b, new), new)
                self.ahead[key] = _lowered(_ranked(found))
            vector, more = self.ahead[key]
            total += more
        return vector, total

    def backward(self, costs: tuple, kinds: bytes) -> tuple[tuple, int]:
        """Costs from each state over these rows to the end that ``costs``
        holds, lowered like forward ones."""
        total = 0
        for kind in reversed(kinds):
            key = costs, kind
            if key not in self.back:
                found: dict[int, int] = {}
                for (a, b), (cost, _) in STEPS[kind].items():
                    if costs[b] is not None:
                        found[a] = min(found.get(a, cost + costs[b]), cost + costs[b])
                least = min(found.values())
                self.back[key] = tuple(found[s] - least if s in found else None for s in STATES), least
            costs, more = self.back[key]
            total += more
        return costs, total

    def crossing(self, first: bytes, second: bytes, start: int, end: int) -> int:
        """The state between two halves on the audit-least cheapest path."""
        ahead, _ = self.forward(entering(start), first)
        back, _ = self.backward(tuple(0 if s == end else None for s in STATES), second)
        return min((ahead[s][0] + back[s], ahead[s][1], s) for s in STATES if ahead[s] and back[s] is not None)[2]

    def solve(self, kinds: bytes, start: int, end: int, out: list[str]) -> None:
        """Appends the edits of the rows from state ``start`` to ``end``."""
        if len(kinds) <= 1:
            out.extend(STEPS[kind][start, end][1] for kind in kinds)
            return
        half = len(kinds) // 2
        state = self.crossing(kinds[:half], kinds[half:], start, end)
        self.solve(kinds[:half], start, state, out)
        self.solve(kinds[half:], state, end, out)


def closing(vector: Vector) -> int:
    """The last state of the audit-least cheapest path that may end here."""
    return min((x[0] + INSERT * len(CLOSE[s]), x[1], s) for s, x in enumerate(vector) if x)[2]


def price(audit: str, kinds: bytes) -> int:
    rows = (e for e in audit if e != "I")
    truncated = sum(k != FORCED and k % 2 for k, e in zip(kinds, rows) if e != "D")
    return sum({"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[e] for e in audit) + TRUNCATED * truncated


def audit_of(kinds: bytes) -> str:
    """Edits' initials of one whole conversation."""
    vectors, out = Vectors(), []
    end = closing(vectors.forward(entering(START), kinds)[0])
    vectors.solve(kinds, START, end, out)
    return "".join(out) + CLOSE[end]


# --- fragments ----------------------------------------------------------------

class Fragment:
    """A partition's rows of one conversation, in order."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.kinds, self.rows = conv_id, bytearray(), []

    def add(self, role: str, text: str, copies: int, fault: str | None) -> None:
        if not copies:
            return
        first = 2 * INITIALS.get(role[:1], 3) + (fault == CUT_OFF)
        self.kinds.append(FORCED if fault in (BLANK, DUPLICATE) else first)
        self.kinds.extend(bytes([FORCED]) * (copies - 1))
        self.rows.append((role, text, copies))

    def initials(self) -> Iterator[str]:
        for role, _, copies in self.rows:
            yield from [role[:1]] * copies

    def repaired(self, audit: str, state: int) -> list[str]:
        """Lines ``role:text`` that the edits leave, entered in ``state``."""
        lines, rows = [], ((r, t) for r, t, n in self.rows for _ in range(n))
        for edit in audit:
            role, text = (("", "") if edit == "I" else next(rows))
            if edit == "D":
                continue
            state = KEPT[INITIALS[role[0]]][state] if edit == "K" else NEXT[state]
            if edit != "K":
                role = "user" if state == USER else "assistant"
            lines.append(f"{role}:{text}")
        return lines


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[Fragment]:
    """A partition's fragments, one at a time."""
    own = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "copies", "fault")]
        for conv_id, *row in zip(*columns):
            if own is None or own.conv_id != conv_id:
                if own is not None:
                    yield own
                own = Fragment(conv_id)
            own.add(*row)
    if own is not None:
        yield own


def _outline(part: int, fragment: Fragment, vectors: Vectors) -> dict:
    """What the neighbours of a fragment need to know of it."""
    initials = list(fragment.initials())
    tables = [[v and (v[0] + more, v[1]) for v in vector]
              for vector, more in (vectors.forward(entering(s), bytes(fragment.kinds)) for s in STATES)]
    return {"part": part, "tables": tables, "last": initials[-1] if initials else None}


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition's first and last fragment: conv_id and its outline."""
    part, vectors, first, last, n = TaskContext.get().partitionId(), Vectors(), None, None, 0
    for last in _fragments(batches):
        first, n = first or last, n + 1
    ends = [x for x in (first, last if n > 1 else None) if x is not None]
    yield pa.RecordBatch.from_arrays(
        [pa.array([str(x.conv_id) for x in ends], pa.string()),
         pa.array([json.dumps(_outline(part, x, vectors)) for x in ends], pa.string())], ["conv", "outline"])


def chained(outlines: list[dict]) -> list[dict]:
    """Where each fragment of one conversation starts and ends. ``outlines`` are
    in the order of the partitions."""
    vector, before = entering(START), []
    for x in outlines:
        found, via = {}, {}
        for a in STATES:
            for b in STATES:
                if vector[a] and x["tables"][a][b]:
                    cost, rank = x["tables"][a][b]
                    new = (vector[a][0] + cost, (vector[a][1], rank))
                    if b not in found or new < found[b]:
                        found[b], via[b] = new, a
        vector = tuple(_ranked(found))
        before.append(via)
    state, ends = closing(vector), []
    for via in reversed(before):
        ends.append((via[state], state))
        state = via[state]
    out, last = [], None
    for i, (x, (start, end)) in enumerate(zip(outlines, reversed(ends))):
        out.append({"start": start, "end": end, "closes": i == len(outlines) - 1, "previous": last})
        last = x["last"] or last
    return out


FRAGMENT = ("part int, cost bigint, illegal bigint, audit string, repaired array<string>")


def repair(judged: DataFrame) -> DataFrame:
    """Fragments of all conversations of ``faults``: ``conv_id``, ``part`` (their
    order), ``cost``, ``illegal`` (neighbours that may not follow each other
    before the repair), ``audit`` and the ``repaired`` lines. Conversations
    without rows have one fragment without edits."""
    spark = judged.sparkSession
    python_ready(spark)
    kind = judged.schema["conv_id"].dataType.simpleString()
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"]
    # cut: both passes see the same partitions, also after a lost executor
    rows = cut(judged.repartitionByRange(*keys).sortWithinPartitions(*keys)
               .select("conv_id", "role", "text", "copies", "fault"))
    parts: dict[str, list[dict]] = {}
    for conv, outline in rows.mapInArrow(_outlines, "conv string, outline string").collect():
        parts.setdefault(conv, []).append(json.loads(outline))
    known = {}
    for conv, outlines in parts.items():
        if len(outlines) > 1:
            outlines.sort(key=lambda x: x["part"])
            known |= {(x["part"], conv): y for x, y in zip(outlines, chained(outlines))}
    shared = spark.sparkContext.broadcast(known)
    id_type = judged.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        part, vectors, out, held = TaskContext.get().partitionId(), Vectors(), [], 0
        types = [to_arrow_type(id_type), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())]
        names = ["conv_id", "part", "cost", "illegal", "audit", "repaired"]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        for own in _fragments(batches):
            kinds = bytes(own.kinds)
            place = shared.value.get((part, str(own.conv_id)))
            if place is None:
                end = closing(vectors.forward(entering(START), kinds)[0])
                place = {"start": START, "end": end, "closes": True, "previous": None}
            edits: list[str] = []
            vectors.solve(kinds, place["start"], place["end"], edits)
            audit = "".join(edits) + (CLOSE[place["end"]] if place["closes"] else "")
            illegal, previous = 0, place["previous"]
            for initial in own.initials():
                illegal += previous is not None and previous + initial not in ("su", "ua", "au")
                previous = initial
            out.append((own.conv_id, part, price(audit, kinds), illegal, audit, own.repaired(audit, place["start"])))
            held += sum(map(len, out[-1][5])) + 100
            if held > FLUSH:
                yield batch()
                out, held = [], 0
        if out:
            yield batch()
    return rows.mapInArrow(run, f"conv_id {kind}, {FRAGMENT}")


def digests(fragments: DataFrame) -> DataFrame:
    """Per conversation its cost, illegal neighbours, audit and the digest of
    its repaired lines, joined by newlines. A conversation's fragments stream
    through one task in order: a digest is sequential by its nature."""
    kind = fragments.schema["conv_id"].dataType
    names = ["conv_id", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        types = [to_arrow_type(kind), pa.int64(), pa.int64(), pa.string(), pa.string()]
        out, own = [], None

        def done() -> None:
            out.append((own["conv_id"], own["illegal"], own["cost"], "".join(own["audit"]), own["sha"].hexdigest()))
        for batch in batches:
            for x in batch.to_pylist():
                if own is None or own["conv_id"] != x["conv_id"]:
                    if own is not None:
                        done()
                    own = {"conv_id": x["conv_id"], "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(),
                           "begun": False}
                own["illegal"] += x["illegal"]
                own["cost"] += x["cost"]
                own["audit"].append(x["audit"])
                for line in x["repaired"]:
                    own["sha"].update((("\n" if own["begun"] else "") + line).encode("utf-8", "replace"))
                    own["begun"] = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out.clear()
        if own is not None:
            done()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
    ordered = fragments.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "part")
    return ordered.mapInArrow(run, f"conv_id {kind.simpleString()}, illegal bigint, cost bigint, audit string, "
                                   "repaired_sha256 string")


def report(conversations: DataFrame) -> DataFrame:
    """One row per original conversation: faults after the damage, the cheapest
    edits and the repaired text's digest."""
    judged = cut(faults(damage(conversations)))
    found = counts(judged).withColumnRenamed("conv_id", "c")
    fixed = digests(repair(judged))
    return (fixed.join(found, F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                    "repaired_sha256"))


#: crc32 bit by bit; dynamic programming over the rows of every conversation
ORACLE = r"""
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda acc, b: list_reduce(list_prepend(xor(acc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
        lambda x, y: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))), CAST(4294967295 AS BIGINT)) % 20 AS fate
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown
  FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN shown = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM placed),
ins AS (SELECT * FROM (VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (0, 2, 9, 'III'),
                              (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'), (1, 2, 9, 'III'),
                              (2, 2, 0, ''), (2, 3, 3, 'I'), (2, 2, 6, 'II'), (2, 3, 9, 'III'),
                              (3, 3, 0, ''), (3, 2, 3, 'I'), (3, 3, 6, 'II'), (3, 2, 9, 'III')) t(a, m, c, e)),
edit AS (SELECT * FROM (VALUES ('s', 0, 1, 0, 'K'), ('u', 0, 2, 0, 'K'), ('u', 1, 2, 0, 'K'), ('u', 3, 2, 0, 'K'),
                               ('a', 2, 3, 0, 'K'), ('', 0, 2, 3, 'R'), ('', 1, 2, 3, 'R'), ('', 2, 3, 3, 'R'),
                               ('', 3, 2, 3, 'R'), ('', 0, 0, 4, 'D'), ('', 1, 1, 4, 'D'), ('', 2, 2, 4, 'D'),
                               ('', 3, 3, 4, 'D')) t(initial, m, b, c, e)),
dp AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS st, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best
  FROM conversations
  UNION ALL
  SELECT conv_id, i, st, best FROM (
    SELECT dp.conv_id, dp.i + 1 AS i, edit.b AS st,
      min({'cost': dp.best.cost + ins.c + edit.c + CASE WHEN edit.e <> 'D' AND j.fault = 'truncated' THEN 3 ELSE 0 END,
           'audit': dp.best.audit || ins.e || edit.e,
           'lines': list_concat(dp.best.lines, list_concat(
              CASE WHEN ins.e = '' THEN CAST([] AS VARCHAR[])
                   WHEN dp.st = 2 THEN (['assistant:', 'user:', 'assistant:'])[1:length(ins.e)]
                   ELSE (['user:', 'assistant:', 'user:'])[1:length(ins.e)] END,
              CASE edit.e WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [j.role || ':' || j.text]
                   ELSE [CASE WHEN edit.b = 2 THEN 'user:' ELSE 'assistant:' END || j.text] END))}) AS best
    FROM dp JOIN judged j ON j.conv_id IS NOT DISTINCT FROM dp.conv_id AND j.i = dp.i + 1
    JOIN ins ON ins.a = dp.st
    JOIN edit ON edit.m = ins.m AND (edit.initial = '' OR edit.initial = j.initial)
             AND (edit.e = 'D' OR j.fault NOT IN ('blank', 'duplicate'))
    GROUP BY 1, 2, 3)),
total AS (
  SELECT conv_id, count(*) AS n, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM judged GROUP BY 1),
ended AS (
  SELECT dp.conv_id, min({'cost': best.cost + CASE st WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END,
                          'audit': best.audit || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                          'lines': list_concat(best.lines, CASE st WHEN 1 THEN ['user:', 'assistant:']
                                     WHEN 2 THEN ['assistant:'] ELSE CAST([] AS VARCHAR[]) END)}) AS best
  FROM dp LEFT JOIN total t ON t.conv_id IS NOT DISTINCT FROM dp.conv_id
  WHERE dp.i = coalesce(t.n, 0) GROUP BY 1)
SELECT e.conv_id, coalesce(t.gaps, 0) AS gaps, coalesce(t.blank, 0) AS blank, coalesce(t.duplicate, 0) AS duplicate,
       coalesce(t.truncated, 0) AS truncated, coalesce(t.illegal, 0) AS illegal, CAST(e.best.cost AS BIGINT) AS cost,
       e.best.audit AS audit, sha256(array_to_string(e.best.lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN total t ON t.conv_id IS NOT DISTINCT FROM e.conv_id
"""
