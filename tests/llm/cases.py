"""Small inputs that the operators' tests share."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: columns whose names operators use themselves
CLASHING = ["keep_id", "kept", "text_sha256", "place", "row", "slot", "shard", "ids", "n_tokens", "chunk",
            "bucket", "component", "rep", "score", "predicted", "listed", "key", "digest", "toxic", "found"]


def words(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def rows() -> list[tuple]:
    """Nulls, empty and very long texts, repeated rows and repeated texts."""
    long = words(1, 20_000)
    texts = [None, "", "   \t\n", "one", "two words", words(2, 60), words(2, 60), words(2, 60) + " tail",
             words(3, 200), words(3, 100) + " " + words(4, 100), "a  b\t\tc", "a b c", "A B C", long, long + " x",
             "x" * 100_000, "é ü ß 漢字 🙂", "\x0b\x0c", "a\x1cb c", words(3, 200).replace(" ", "\n")]
    out = [(i, t, "en" if i % 2 else "de", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    out += [out[5], out[5], (900, None, None, None, None), (None, words(2, 60), "en", "s", 1), (None, None, None, None, None)]
    return out


def frame(spark, data=None, clash=False):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit("own").alias(c) for c in CLASHING])
    return df
