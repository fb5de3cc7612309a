"""A training-corpus pipeline of five of the operators, each stage over all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lamina.llm import bpe, decontaminate, neardup, secrets, toxicity
from lamina.llm.queries import table, vocabulary_path
from lamina.llm.store import shared_dir
from lamina.llm.words import spread


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine rejects go."""
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, of five-word shingles' similarity 0.8, stays: the one of the smallest id.

    SimHash fingerprints say which texts are compared; the similarity decides.
    """
    return neardup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced."""
    return secrets.redact(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text that they decode to."""
    return bpe.encode(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("bpe", encode_tokens),
]

#: The stages are models, fingerprints and a tokenizer, which SQL can't express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each one's rows written to the shared folder and reread by the next; what went before is deleted.

    The result reads the last stage but one, whose folder goes when the driver ends.
    """
    folder, old = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    whole = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(whole)
    docs = spread(table(spark, sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if old:
            path = spark._jvm.org.apache.hadoop.fs.Path(old)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        old = f"{folder}/{name}"
    return STAGES[-1][1](spark, spread(docs), sf_dir)
