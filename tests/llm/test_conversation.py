"""Conversation repair against all edit sequences and against SQL."""

import random

import pytest
from pyspark.sql import functions as F

from shopflow.llm import conversation_repair as C
from tests.oracle import compare, duck

SCHEMA = "conv_id long, turn long, role string, text string"
KINDS = {"blank": C.FORCED, "s": 0, "s-": 1, "u": 2, "u-": 3, "a": 4, "a-": 5, "x": 6, "x-": 7}


def plain_audit(kinds):
    """Least (cost, audit) of every edit sequence, by trying all."""
    best = []

    def go(i, state, cost, audit, inserted):
        if best and cost > best[0][0]:
            return
        if i == len(kinds) and state in (C.START, C.ANSWER):
            best[:] = [min(best + [(cost, audit)])]
        if inserted < 3:
            go(i, {0: 2, 1: 2, 2: 3, 3: 2}[state], cost + 3, audit + "I", inserted + 1)
        if i == len(kinds):
            return
        kind = kinds[i]
        go(i + 1, state, cost + 4, audit + "D", 0)
        if kind != C.FORCED:
            extra = 3 * (kind % 2)
            go(i + 1, 3 if state == 2 else 2, cost + 3 + extra, audit + "R", 0)
            to = {(0, 0): 1, (1, 0): 2, (1, 1): 2, (1, 3): 2, (2, 2): 3}.get((kind // 2, state))
            if to is not None:
                go(i + 1, to, cost + extra, audit + "K", 0)
    go(0, C.START, 0, "", 0)
    return best[0]


def test_audit_is_the_least_of_all():
    rnd = random.Random(3)
    for n in [0, 1, 2, 3, 4, 5, 6] * 40:
        kinds = bytes(rnd.choice(list(KINDS.values())) for _ in range(n))
        cost, audit = plain_audit(kinds)
        assert C.audit_of(kinds) == audit
        assert C.price(audit, kinds) == cost


def test_fragments_chain_to_the_same_audit():
    rnd = random.Random(4)
    for _ in range(150):
        kinds = bytes(rnd.choice(list(KINDS.values())) for _ in range(rnd.randint(0, 30)))
        cuts = sorted(rnd.randint(0, len(kinds)) for _ in range(rnd.randint(0, 5)))
        parts = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, len(kinds)])]
        vectors, outlines = C.Vectors(), []
        for i, part in enumerate(parts):
            own = C.Fragment(1)
            own.kinds.extend(part)
            outlines.append(C._outline(i, own, vectors))
        out = []
        for part, place in zip(parts, C.chained(outlines)):
            vectors.solve(part, place["start"], place["end"], out)
        assert "".join(out) + C.CLOSE[place["end"]] == C.audit_of(kinds)


def odd_rows():
    long = "word " * 20_000
    data = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."),
            (2, None, "user", "No turn."), (2, 5, None, "No role."), (2, 9, "assistant", None), (2, 9, "tool", "x"),
            (3, 0, "user", ""), (3, 1, "user", "  \t"), (4, 7, "", long), (4, 8, "assistant", long + "."),
            (None, 1, "user", "Null id."), (None, 2, "assistant", "é漢🙂!"), (None, None, None, None),
            (5, 1, "assistant", "Alone."), (6, 3, "system", "a.\x0b"), (6, 10, "system", "a.\x1c"), (7, 1, "user", "b!")]
    return data + [(8, i, "user" if i % 2 else "assistant", f"t{i}.") for i in range(40)]


@pytest.fixture()
def small(tmp_path):
    def against(spark, data, clash=False):
        frame = spark.createDataFrame(data, SCHEMA).repartition(3)
        if clash:
            frame = frame.select("*", *[F.lit("own").alias(c) for c in
                                        ("fault", "copies", "digest", "audit", "part", "c", "r", "d", "first", "kind")])
        frame.write.mode("overwrite").parquet(str(tmp_path / "c"))
        con = duck("/nowhere")
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c/*.parquet')")
        return compare(C.report(spark.read.parquet(str(tmp_path / "c"))).fillna({"conv_id": -9}),
                       f"SELECT * REPLACE (coalesce(conv_id, -9) AS conv_id) FROM ({C.ORACLE})", con)
    return against


def test_edges_equal_sql(spark, small):
    for clash in (False, True):
        ok, message = small(spark, odd_rows(), clash)
        assert ok, message
    ok, message = small(spark, [])
    assert ok, message


def test_random_conversations_equal_sql(spark, small):
    rnd = random.Random(5)
    data = [(rnd.randint(0, 60), rnd.choice([None, *range(12)]), rnd.choice(["system", "user", "assistant", "tool", None]),
             rnd.choice(["a.", "b", "c!", " ", "", None, "d? "])) for _ in range(500)]
    ok, message = small(spark, data)
    assert ok, message


def test_conversation_over_many_partitions(spark):
    """One conversation holds most rows: its fragments lie in several tasks and
    give the audit of the whole."""
    rnd = random.Random(6)
    data = [(0, i, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice(["a", "b.", "c!"]) + str(i // 3) + ".")
            for i in range(3000)] + [(c, t, "user", "x.") for c in (1, 2, 3) for t in (0, 1)]
    keys = "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for key, value in zip(keys, ("false", "7")):
            spark.conf.set(key, value)
        judged = C.faults(spark.createDataFrame(data, SCHEMA)).cache()
        found = C.repair(judged).orderBy("conv_id", "part").collect()
        whole = C.digests(C.repair(judged)).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    parts = [r for r in found if r["conv_id"] == 0]
    assert len(parts) > 2
    rows = sorted((r for r in judged.collect() if r["conv_id"] == 0), key=lambda r: (r["turn"], r["role"], r["text"]))
    own = C.Fragment(0)
    for r in rows:
        own.add(r["role"], r["text"], r["copies"], r["fault"])
    audit = C.audit_of(bytes(own.kinds))
    one = next(r for r in whole if r["conv_id"] == 0)
    assert one["audit"] == "".join(r["audit"] for r in parts) == audit
    assert one["cost"] == C.price(audit, bytes(own.kinds))
    initials = list(own.initials())
    assert one["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    assert [x for r in parts for x in r["repaired"]] == own.repaired(audit, C.START)
