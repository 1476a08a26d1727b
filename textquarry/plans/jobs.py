"""Stand-alone jobs over single stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CorpusConfig
from ..operators import cleaning, dedup, tokens
from ..session import PACKED, discard, shuffles_go, write_table
from ..sources import records, sinks


def clean_job(spark: SparkSession, paths: Sequence[str], output: str, cfg: CorpusConfig) -> DataFrame:
    """Reads, cleans, writes the outcome; returns the totals."""
    cleaned = write_table(cleaning.clean(records.load_texts(spark, paths), cfg))
    sinks.export_jsonl(cleaned.select("text", "dropped", "drop_reason"), f"{output}/cleaned")
    return cleaning.cleaning_totals(cleaned)


def tokenize_job(spark: SparkSession, paths: Sequence[str], output: str, cfg: CorpusConfig) -> DataFrame:
    """Reads, trains, encodes, writes; returns the totals.

    The texts lie in the table they were numbered in and go when they are
    encoded; tokens are named as they are written, in files compressed by gzip.
    """
    texts = records.nonempty(records.load_texts(spark, paths))
    vocab = tokens.train(tokens.word_counts(texts), cfg.tokenizer_type, cfg.vocab_size)
    ready = tokens.broadcast_vocabulary(*vocab, cfg.tokenizer_type)
    encoded = write_table(tokens.encode_ids(texts, ready).select("token_ids", "token_length"), options=PACKED)
    discard(texts)
    rows = tokens.named(encoded, ready).select("tokens", "token_ids", F.col("token_length").alias("length"))
    sinks.export_jsonl(rows, f"{output}/tokenized", compression="gzip")
    return tokens.token_totals(encoded)


def reduce_job(df: DataFrame, output: str) -> DataFrame:
    """Writes token ids alone; returns the sizes before and after.

    The rows are written once for both, so that texts aren't encoded a second time.
    """
    rows = write_table(df)
    sinks.export_jsonl(tokens.project_ids(rows), output)
    return tokens.size_report(rows)


def dedup_outcomes(df: DataFrame, cfg: CorpusConfig, keep: Sequence[str] | None = None) -> DataFrame:
    """Raw records with the outcome of cleaning and the duplicate check.

    ``outcome`` is malformed, empty, too_short, too_long, duplicate or unique;
    the columns of the input, or those to ``keep``, stay as they were.  They and
    the cleaned texts are written side by side, so nothing is joined for the
    outcome but the numbers of the duplicates.
    """
    kept = list(df.columns if keep is None else keep)
    empty = F.coalesce(F.length("text"), F.lit(0)) == 0
    named = df.withColumn("_raw", F.col("text")).withColumn("_empty", empty)
    cleaned = cleaning.clean(named, cfg).withColumnRenamed("text", "_clean").withColumnRenamed("_raw", "text")
    work = write_table(cleaned.select(*dict.fromkeys([*kept, "seq", "malformed", "drop_reason", "_empty", "_clean"])), options=PACKED)
    marked = dedup.mark_duplicates(work, cfg, text="_clean")
    outcome = (
        F.when(F.col("malformed"), F.lit("malformed"))
        .when(F.col("_empty"), F.lit("empty"))
        .when(F.col("drop_reason").startswith("too_short"), F.lit("too_short"))
        .when(F.col("drop_reason").startswith("too_long"), F.lit("too_long"))
        .when(F.col("drop_reason").isNotNull(), F.lit("empty"))
        .when(F.col("is_duplicate"), F.lit("duplicate"))
        .otherwise(F.lit("unique"))
    )
    return marked.select(*kept, outcome.alias("outcome"))


def dedup_stats(outcomes: DataFrame) -> DataFrame:
    """One row: counts by outcome; the rate is a percentage of all lines."""
    total = F.count(F.lit(1))

    def count(kind: str):
        return F.count_if(F.col("outcome") == kind)

    return outcomes.agg(
        total.alias("total"),
        count("unique").alias("unique"),
        count("duplicate").alias("duplicates"),
        count("too_short").alias("too_short"),
        count("too_long").alias("too_long"),
        count("empty").alias("empty"),
        F.when(total > 0, 100.0 * count("duplicate") / total).otherwise(F.lit(0.0)).alias("duplicate_rate"),
    )


def dedup_job(spark: SparkSession, paths: Sequence[str], output: str, cfg: CorpusConfig) -> DataFrame:
    """Writes the original lines of unique records and the stats; returns the stats.

    Lines are numbered like other records, without a sort, and lie in one table
    at a time; the cleaned texts go when the duplicates are known.
    """
    lines = records.numbered(records.read_lines(spark, paths), "value")
    marked = dedup_outcomes(records.parse_lines(lines.drop("file")), cfg, keep=("seq", "value"))
    discard(lines)
    outcomes = write_table(marked, options=PACKED)
    discard(marked)  # the cleaned texts
    unique = outcomes.filter("outcome = 'unique'").orderBy("seq").select("value")
    with shuffles_go(spark):
        unique.write.mode("overwrite").text(f"{output}/unique")
    totals = dedup_stats(outcomes)
    sinks.export_object(totals, f"{output}/dedup_stats")
    return totals


def read_dedup_stats(spark: SparkSession, output: str) -> DataFrame:
    """The stats an earlier ``dedup_job`` left, for the report."""
    return spark.read.json(f"{output}/dedup_stats")
