"""Length, language, duplicate and personal-data statistics.

Exact order statistics come from value counts: equal values are combined
before the shuffle, and what remains has at most as many rows as there are
distinct values (lengths up to the length gate, scores of six decimals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

PERCENTILES = (25, 75, 90, 95, 99)
BINS = 50


def value_counts(df: DataFrame, **measures: Column) -> DataFrame:
    """``name``, ``value``, ``n``: how often each value of each measure occurs."""
    cells = [F.struct(F.lit(name).alias("name"), m.cast("long").alias("value")) for name, m in measures.items()]
    return (
        df.select(F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def length_stats(counts: DataFrame) -> DataFrame:
    """One row per measure: count, extremes, mean, deviation, percentiles."""
    v, n = F.col("value"), F.col("n")
    total = F.sum("n")
    wide = "decimal(38,0)"
    s1 = F.sum((v * n).cast(wide)).cast("double")
    s2 = F.sum(v.cast("decimal(12,0)") * v.cast("decimal(12,0)") * n.cast("decimal(12,0)")).cast("double")
    qs = F.percentile(v, F.array(F.lit(0.5), *[F.lit(p / 100) for p in PERCENTILES]), n)
    summary = counts.groupBy("name").agg(
        total.alias("count"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        (s1 / total).alias("mean"),
        F.sqrt(F.greatest(s2 / total - F.pow(s1 / total, F.lit(2)), F.lit(0.0))).alias("std"),
        qs.alias("_q"),
    )
    return summary.select(
        "name",
        "count",
        "min",
        "max",
        "mean",
        F.col("_q")[0].alias("median"),
        "std",
        *[F.col("_q")[i + 1].alias(f"p{p}") for i, p in enumerate(PERCENTILES)],
    )


def upper_median(counts: DataFrame) -> DataFrame:
    """The element at position n div 2 of the sorted values, from 0."""
    w = Window.partitionBy("name")
    upto = F.sum("n").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    middle = F.floor(F.sum("n").over(w) / 2)
    return (
        counts.withColumn("upto", upto)
        .withColumn("middle", middle)
        .filter((F.col("upto") > F.col("middle")) & (F.col("upto") - F.col("n") <= F.col("middle")))
        .select("name", F.col("value").alias("upper_median"))
    )


def histogram(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty
    bins included; mean and median repeated as markers."""
    edges = length_stats(counts).select(
        "name",
        F.when(F.col("min") == F.col("max"), F.col("min") - 0.5).otherwise(F.col("min").cast("double")).alias("low"),
        F.when(F.col("min") == F.col("max"), F.lit(1.0)).otherwise((F.col("max") - F.col("min")).cast("double")).alias("span"),
        "mean",
        "median",
    )
    placed = counts.join(edges, "name").select(
        "name",
        F.least(F.floor((F.col("value") - F.col("low")) * bins / F.col("span")), F.lit(bins - 1)).cast("int").alias("bin"),
        "n",
    )
    filled = placed.groupBy("name", "bin").agg(F.sum("n").alias("n"))
    every = edges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(filled, ["name", "bin"], "left").select(
        "name",
        "bin",
        (F.col("low") + F.col("bin") * F.col("span") / bins).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * F.col("span") / bins).alias("bin_high"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
        "mean",
        "median",
    )


def score_counts(df: DataFrame) -> DataFrame:
    """Value counts of language scores; null and zero scores are left out."""
    return (
        df.filter(F.col("language").isNotNull() & (F.col("language_score") != 0))
        .groupBy("language", F.col("language_score").alias("score"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def language_stats(df: DataFrame) -> DataFrame:
    """Records, mean and median score per language, language-filtered ones included."""
    return (
        score_counts(df)
        .groupBy("language")
        .agg(
            F.sum("n").alias("records"),
            (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("mean_score"),
            F.percentile("score", F.lit(0.5), F.col("n")).alias("median_score"),
        )
    )


def _quartiles(counts: DataFrame) -> DataFrame:
    """``language``, ``q1``, ``med``, ``q3``: one row per language."""
    return (
        counts.groupBy("language")
        .agg(F.percentile("score", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"))
        .select("language", F.col("q")[0].alias("q1"), F.col("q")[1].alias("med"), F.col("q")[2].alias("q3"))
    )


def _within_whiskers() -> F.Column:
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return F.col("score").between(F.col("q1") - reach, F.col("q3") + reach)


def language_outliers(df: DataFrame) -> DataFrame:
    """The records whose score lies beyond the whiskers of their language, with all their columns.

    Quartiles come from value counts; the distinct scores beyond them are
    joined back, so that no language's records meet in one task unless its
    outliers are many and alike.
    """
    counts = cut_lineage(score_counts(df))
    beyond = counts.join(_quartiles(counts), "language").filter(~_within_whiskers())
    keys = beyond.select("language", F.col("score").alias("language_score"))
    return df.join(keys, ["language", "language_score"], "left_semi").select(df.columns)


def language_box(df: DataFrame) -> DataFrame:
    """Box-plot figures per language: quartiles, whiskers, number of outliers."""
    counts = score_counts(df)
    quartiles = _quartiles(counts)
    inside = _within_whiskers()
    return (
        counts.join(quartiles, "language")
        .groupBy("language", "q1", "med", "q3")
        .agg(
            F.min(F.when(inside, F.col("score"))).alias("lowest"),
            F.max(F.when(inside, F.col("score"))).alias("highest"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
        .select(
            "language",
            "q1",
            "med",
            "q3",
            F.least("lowest", "q1").alias("whisker_low"),
            F.greatest("highest", "q3").alias("whisker_high"),
            "outliers",
        )
    )


def duplicate_stats(df: DataFrame, checked_only: bool = False) -> DataFrame:
    """Duplicates among the records with a language.

    Records filtered for their language count as unique unless
    ``checked_only`` restricts the figures to records that reached the check.
    """
    population = df.filter(F.col("language").isNotNull())
    if checked_only:
        population = population.filter(F.col("is_duplicate").isNotNull())
    total = F.count(F.lit(1))
    twice = F.count_if(F.coalesce(F.col("is_duplicate"), F.lit(False)))
    return population.agg(
        total.alias("total_samples"),
        twice.alias("duplicate_count"),
        (total - twice).alias("unique_count"),
        F.when(total > 0, twice / total).otherwise(F.lit(0.0)).alias("duplicate_rate"),
    )


def pii_hits(df: DataFrame) -> DataFrame:
    """Spans per type over retained rows, with their share of all spans."""
    by_type = (
        df.filter(~F.col("dropped"))
        .select(F.explode("pii_entities.type").alias("type"))
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    # One row per entity type is all this window ever sees.
    everything = F.sum("hits").over(Window.partitionBy(F.lit(1)))
    return by_type.withColumn("total_hits", everything).withColumn("hit_rate", F.col("hits") / F.col("total_hits"))


def drop_reasons(df: DataFrame) -> DataFrame:
    return df.filter("dropped").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("records"))


def summary(df: DataFrame) -> DataFrame:
    """One row: samples, retained, dropped, characters before and after."""
    kept = ~F.col("dropped")
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(kept & (F.col("length") > 0)).alias("cleaned_text_count"),
        F.count_if("dropped").alias("total_dropped"),
        F.coalesce(F.sum("length_before"), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum(F.when(kept, F.col("length"))), F.lit(0)).cast("long").alias("chars_after"),
    )


def ranked_languages(df: DataFrame) -> DataFrame:
    """Languages by number of records, most first."""
    return language_stats(df).orderBy(F.desc("records"), "language")


def ranked_pii(df: DataFrame) -> DataFrame:
    """Entity types by number of spans, most first."""
    return pii_hits(df).orderBy(F.desc("hits"), "type")
