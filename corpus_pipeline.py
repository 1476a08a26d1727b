"""From raw documents to packed training sequences: five operators, one after another.

Each stage works on all documents that the one before kept and is written as Parquet; all but
the last return the columns of the documents.  Rows without an id go through the filters like
others; empty tables pass through as empty tables.  A worker holds a batch of texts a few times over,
so all stages run with small batches.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.llm import decontaminate, jaccard, langid, packing, secrets
from textquarry.llm.queries import public_tokenizer
from textquarry.session import shared_dir, ship_package
from textquarry.sources.tables import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those without a letter and ambiguous ones go."""
    training = docs.filter(langid.remainder(F.col("doc_id"), 3) != 1)
    found = langid.identify(docs, training, into="_language")
    known = (F.col("_language.lang_pred") != langid.UNDETERMINED) & ~F.col("_language.ambiguous")
    return found.filter(known).drop("_language")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of secrets; ``n_chars`` follows."""
    marked = secrets.redact(docs)
    return marked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizer("byte_bpe_50k.json"), end_id=2, capacity=1024)


BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def _in_small_batches(stage):
    """The stage in a session with small batches, which also hold when its result is read."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [(f.__name__, _in_small_batches(f)) for f in (language_id, jaccard_join, decontamination, secret_scan, best_fit_packing)]

# SQL can't express the first and the last stage; tests/llm/test_pipeline.py has the whole in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    ship_package(spark)
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
