"""Length gates, scrubbing and the reasons for dropping a record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CorpusConfig
from ..functions import text as T
from ..functions.frames import compute_once


def clean(df: DataFrame, cfg: CorpusConfig, text: str = "text") -> DataFrame:
    """Adds ``length_before``, ``dropped`` and ``drop_reason``; replaces ``text``.

    Texts of a length outside the gates never reach the patterns.  A null text
    is dropped as ``null_text``.
    """
    length = F.col("length_before")
    scrubbed = T.scrub(F.col(text), cfg.control_chars)
    if cfg.remove_urls:
        scrubbed = T.remove_urls(scrubbed)
    if cfg.remove_emails:
        scrubbed = T.remove_emails(scrubbed)
    gate = F.length(text).between(cfg.min_length, cfg.max_length)
    gated = compute_once(df, length_before=F.length(text), **{text: F.when(gate, scrubbed)})
    after = F.coalesce(F.length(text), F.lit(0))
    reason = (
        F.when(length.isNull(), F.lit("null_text"))
        .when(length < cfg.min_length, F.lit(f"too_short_{cfg.min_length}"))
        .when(length > cfg.max_length, F.lit(f"too_long_{cfg.max_length}"))
        .when((after == 0) | (after < cfg.min_length), F.lit("empty_after_cleaning"))
    )
    return (
        gated.withColumn("drop_reason", reason)
        .withColumn("dropped", F.col("drop_reason").isNotNull())
        .withColumn(text, F.when(~F.col("dropped"), F.col(text)))
    )


def clean_batch(df: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """Only the outcome: text, dropped, drop_reason."""
    return clean(df, cfg).select("text", "dropped", "drop_reason")


def drop_counts(df: DataFrame) -> DataFrame:
    """Number of records per drop reason."""
    return (
        df.filter("dropped").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("records"))
    )


def cleaning_totals(df: DataFrame) -> DataFrame:
    """One row: records seen, records dropped, total length before and after."""
    return df.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if("dropped").alias("total_dropped"),
        F.coalesce(F.sum("length_before"), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars_after"),
    )


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("dropped"))
