"""Parquet tables as records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


SPLIT_BYTES = 1 << 25  # of files, for each core, from which a scan is left as it is


def spread(df: DataFrame, key: str) -> DataFrame:
    """Redistribute a small scan whose few splits would keep only some cores busy.

    A file with a single row group is worked on by a single core.  Decided by
    the size of the files, which the plan knows without running anything:
    beyond a few splits for each core a scan is left as it is, and nothing of
    it is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= SPLIT_BYTES * cores:
        return df
    return df.repartition(cores, key)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents table in the shape the operators take: ``seq``, ``text``."""
    docs = read_table(spark, folder, "documents")
    return spread(docs.withColumnRenamed("doc_id", "seq"), "seq")
