"""Chunk-by-chunk runs that resume where they stopped.

A file stream takes a bounded number of files per batch; ``stage_chunks`` cuts
records into files of ``chunk_size`` rows, so that a batch is a chunk.  The
checkpoint records which batches are done; each batch overwrites its own
folder, so a batch repeated after a failure, in the middle of a chunk too,
leaves a single copy.  Duplicates are searched once everything has arrived,
over all batches, or, with an index, among what is new and the index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CorpusConfig
from ..functions.spans import DEFAULT_RULES, Rule
from ..operators import mixture
from ..operators.dedup_index import DuplicateIndex
from ..plans.corpus import PROCESSED, annotate_records, drop_duplicates

CHUNK = "seq long, text string"


def stage_chunks(df: DataFrame, cfg: CorpusConfig, folder: str, seq: str = "seq") -> DataFrame:
    """Cuts records into files of ``cfg.chunk_size`` rows in the order of ``seq``; a stream of one file per batch.

    Without a chunk size there is one chunk.  What is staged already, whole,
    is left as it is, so that a run can be taken up again.
    """
    spark = df.sparkSession
    try:
        spark.read.text(f"{folder}/_SUCCESS").limit(0).collect()
    except AnalysisException:
        numbered = mixture.with_index(df.select(F.col(seq).alias("seq"), "text"))
        size = cfg.chunk_size or max(1, numbered.count())
        rows = numbered.withColumn("chunk", F.floor(F.col("index") / size)).drop("index")
        chunks = (rows.agg(F.max("chunk")).first()[0] or 0) + 1
        # All rows of a chunk in one task, hence in one file.
        rows.repartition(int(chunks), "chunk").write.mode("overwrite").partitionBy("chunk").parquet(folder)
    return file_stream(spark, folder, f"{CHUNK}, chunk long").select("seq", "text")


def write_chunks(
    stream: DataFrame,
    cfg: CorpusConfig,
    profile,
    output: str,
    rules: Sequence[Rule] = DEFAULT_RULES,
    chunks: int | None = None,
) -> bool:
    """Runs the row-by-row stages on everything that has arrived, or on ``chunks`` batches of it, then returns.

    The stream has ``seq`` and ``text``; ``output`` must be on storage all
    executors share.  Tells whether all that has arrived is done; if it isn't,
    the next call goes on where this one stopped.
    """
    done: list[int] = []

    def save(batch: DataFrame, number: int) -> None:
        if chunks is not None and len(done) >= chunks:
            raise RuntimeError("as many chunks as were asked for are done")
        done.append(number)
        # A file may have fewer row groups than splits, most of which are empty then; rows are dealt to all cores.
        cores = batch.sparkSession.sparkContext.defaultParallelism
        even = batch.repartition(max(cores, batch.rdd.getNumPartitions()), "seq")
        rows = annotate_records(even, cfg, profile, rules)
        rows.select(*PROCESSED).write.mode("overwrite").parquet(f"{output}/rows/batch={number}")

    query = (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", f"{output}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if chunks is None or len(done) < chunks:
            raise
        return False
    return True


def read_chunks(spark: SparkSession, output: str) -> DataFrame:
    """All rows written so far, with the number of their batch."""
    return spark.read.parquet(f"{output}/rows")


def finish(
    spark: SparkSession, cfg: CorpusConfig, output: str, index: DuplicateIndex | None = None, run: int = 0
) -> DataFrame:
    """The search for duplicates across all chunks, and, with an index, across the runs before."""
    rows = read_chunks(spark, output).select(*PROCESSED)
    if not cfg.remove_duplicates:
        return rows
    if index is not None:
        return drop_duplicates(rows, cfg, keep_text=True, later=index.add(rows.select("seq", "text"), run)).select(*PROCESSED)
    return drop_duplicates(rows, cfg, keep_text=True).select(*PROCESSED)


def file_stream(
    spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", files_per_chunk: int = 1, pattern: str = "*"
) -> DataFrame:
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_chunk)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
