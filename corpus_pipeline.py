"""From raw documents to token ids: the stages that a training corpus passes.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``. ``run`` writes every
stage's rows as Parquet in the session's shared folder and reads them back as
the next stage's input, so a lost executor costs no finished stage. A stage's
folder goes when the next stage is written; the last one's stays.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import bpe_codec, decontamination, exact_dedup, near_dedup, toxicity
from shopflow.llm.common import table
from shopflow.session import checkpoint_root

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores as toxic go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the smallest id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles (similarity 0.8) one stays."""
    return near_dedup.keep_one(docs, size=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and a digest of what they decode to."""
    coded = bpe_codec.round_trip(docs, public_tokenizers.path(TOKENIZER))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("bpe_codec", tokenize),
]

#: no SQL form: a fitted classifier, components and BPE; tests hold the rows
#: against brute force
ORACLE_SQL = None


def remove(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_root(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
