"""The run report: every figure by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import stats, tokens


def _melt(one_row: DataFrame, prefix: str = "") -> DataFrame:
    """The columns of a frame of one row as ``metric``, ``value``."""
    cells = [
        F.struct(F.lit(prefix + c).alias("metric"), F.col(c).cast("double").alias("value")) for c in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*cells)))


def _by_key(rows: DataFrame, key: str, names: dict[str, Column]) -> DataFrame:
    """Several figures per row, each named after the row's key."""
    cells = [
        F.struct(name.alias("metric"), F.col(c).cast("double").alias("value")) for c, name in names.items()
    ]
    return rows.filter(F.col(key).isNotNull()).select(F.inline(F.array(*cells)))


def lengths(processed: DataFrame, tokenized: DataFrame | None) -> DataFrame:
    """Value counts of text lengths and, if there are any, token lengths."""
    kept = F.when(~F.col("dropped"), F.col("length"))
    counts = stats.value_counts(processed, cleaned_text=kept)
    if tokenized is not None:
        counts = counts.unionByName(stats.value_counts(tokenized, token=F.col("token_length")))
    return counts


def assemble(processed: DataFrame, tokenized: DataFrame | None = None) -> DataFrame:
    """``metric``, ``value`` for the whole run.

    The median of the text lengths is the upper one, that of the token lengths
    the interpolated one.
    """
    counts = lengths(processed, tokenized)
    figures = ("count", "min", "max", "mean", "median", "std", "p25", "p75", "p90", "p95", "p99")
    by_measure = _by_key(
        stats.length_stats(counts),
        "name",
        {f: F.concat_ws("_", "name", F.lit(f)) for f in figures},
    ).filter("metric <> 'cleaned_text_median'")
    upper = (
        stats.upper_median(counts)
        .filter("name = 'cleaned_text'")
        .select(F.lit("cleaned_text_median").alias("metric"), F.col("upper_median").cast("double").alias("value"))
    )
    reasons = _by_key(
        stats.drop_reasons(processed),
        "drop_reason",
        {"records": F.concat(F.lit("drop_reasons."), "drop_reason")},
    )
    languages = _by_key(
        stats.language_stats(processed),
        "language",
        {
            "records": F.concat("language", F.lit("_count")),
            "mean_score": F.concat("language", F.lit("_mean_score")),
            "median_score": F.concat("language", F.lit("_median_score")),
        },
    )
    hits = _by_key(
        stats.pii_hits(processed),
        "type",
        {
            "hits": F.concat(F.lit("pii_type_counts."), "type"),
            "hit_rate": F.concat("type", F.lit("_hit_rate")),
        },
    )
    kept = ~F.col("dropped")
    totals = processed.agg(
        F.coalesce(F.sum(F.when(kept, F.size("pii_entities"))), F.lit(0)).alias("total_pii_hits"),
    )
    parts = [
        _melt(stats.summary(processed).drop("cleaned_text_count")),
        _melt(stats.duplicate_stats(processed).drop("total_samples")),
        _melt(totals),
        by_measure,
        upper,
        reasons,
        languages,
        hits,
    ]
    if tokenized is not None:
        parts.append(_melt(tokens.token_totals(tokenized)))
    return reduce(DataFrame.unionByName, parts)


def headline(processed: DataFrame, tokenized: DataFrame | None = None) -> DataFrame:
    """The six overview figures."""
    wanted = (
        "total_samples",
        "cleaned_text_count",
        "total_dropped",
        "total_sequences",
        "total_tokens",
        "avg_sequence_length",
    )
    rows = [_melt(stats.summary(processed).select("total_samples", "cleaned_text_count", "total_dropped"))]
    if tokenized is not None:
        rows.append(_melt(tokens.token_totals(tokenized)))
    one = reduce(DataFrame.unionByName, rows)
    return one.agg(
        *[F.coalesce(F.max(F.when(F.col("metric") == w, F.col("value"))), F.lit(0.0)).alias(w) for w in wanted]
    )


def as_object(report: DataFrame) -> DataFrame:
    """The report as a frame of one row holding one map, for export as JSON.

    There are as many entries as there are figures, languages and reasons.
    """
    return report.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("report"))


def with_dedup_stats(report: DataFrame, dedup_stats: DataFrame) -> DataFrame:
    """The report with the figures of an earlier de-duplication job added."""
    return report.unionByName(_melt(dedup_stats, "dedup_"))
