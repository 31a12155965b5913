"""One row per key: earliest, latest, any.

All three are aggregations, not ``row_number`` windows: ``min``/``max`` over a
struct whose leading fields are the ordering columns is an ordinary aggregate,
so Spark combines it map-side before the shuffle. A key that holds a third of
all rows therefore ships one partial row per map task instead of streaming
every row through a single sort/window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PICK = "_pick"


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str],
          agg) -> DataFrame:
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    # order columns first (lexicographic struct compare), then the payload
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(agg(packed).alias(_PICK))
    out = [F.col(k) for k in keys]
    out += [F.col(f"{_PICK}._o{i}").alias(c) for i, c in enumerate(order)]
    out += [F.col(f"{_PICK}.{c}").alias(c) for c in rest]
    return picked.select(*out).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the smallest ``order`` tuple per key. Make ``order`` end with
    a unique column so the pick is deterministic."""
    return _pick(df, keys, order, F.min)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the largest ``order`` tuple per key (upsert / latest-wins)."""
    return _pick(df, keys, order, F.max)
