"""Detection and redaction of personal data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CorpusConfig
from ..functions.frames import compute_once
from ..functions.spans import DEFAULT_RULES, ENTITIES, Rule, entities, redact


def detect(
    df: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = DEFAULT_RULES,
    min_score: float | None = None,
) -> DataFrame:
    """Adds ``pii_entities``."""
    return compute_once(df, pii_entities=entities(F.col(text), rules, min_score))


def has_pii(df: DataFrame, text: str = "text", rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Adds ``has_pii`` without building spans: one match answers the question."""
    found = F.lit(False)
    for rule in rules:
        hit = F.regexp_like(text, F.lit(rule.pattern))
        if rule.needs is not None:
            hit = F.contains(F.col(text), F.lit(rule.needs)) & hit
        found = found | hit
    return df.withColumn("has_pii", found)


def anonymize(df: DataFrame, text: str = "text", rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Detect and replace in one step; only ``text`` changes."""
    found = compute_once(df, _spans=entities(F.col(text), rules))
    return found.withColumn(text, redact(F.col(text), F.col("_spans"))).drop("_spans")


def annotate(df: DataFrame, cfg: CorpusConfig, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Adds the personal-data columns and ``length`` to every row not dropped.

    Spans refer to the text before redaction, ``length`` to the text after.
    Detection runs once for inspection and redaction alike, and not at all
    when neither is wanted.
    """
    alive = ~F.col("dropped")
    if cfg.redact_pii or cfg.inspect_pii:
        found = F.when(alive, entities(F.col("text"), rules, cfg.pii_threshold))
        df = compute_once(df, pii_entities=found)
    else:
        df = df.withColumn("pii_entities", F.when(alive, F.array().cast(ENTITIES)))
    df = df.withColumn("pii_count", F.when(alive, F.size("pii_entities"))).withColumn(
        "has_pii", F.col("pii_count") > 0
    )
    if cfg.redact_pii:
        clean = F.when(F.col("has_pii"), redact(F.col("text"), F.col("pii_entities")))
        df = compute_once(
            df.withColumn("pii_redacted", F.col("has_pii")), text=clean.otherwise(F.col("text"))
        )
    else:
        df = df.withColumn("pii_redacted", F.when(alive, F.lit(False)))
    return df.withColumn("length", F.when(alive, F.length("text")))


def type_counts(df: DataFrame) -> DataFrame:
    """Spans per entity type."""
    return (
        df.select(F.explode("pii_entities.type").alias("type"))
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("hits"))
    )


def detection_totals(df: DataFrame) -> DataFrame:
    """One row: texts checked, spans found."""
    return df.agg(
        F.count("pii_entities").alias("total_checked"),
        F.coalesce(F.sum(F.size("pii_entities")), F.lit(0)).cast("long").alias("total_pii_found"),
    )
