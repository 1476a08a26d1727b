"""Language profiles, detection and the allow-list."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CorpusConfig
from ..functions import langid as L
from ..functions.frames import compute_once
from ..session import cut_lineage, write_table

# A profile of up to so many cells (grams times languages, 8 bytes each) is broadcast; a larger one is joined.
BROADCAST_CELLS = 4_000_000


def gram_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Occurrences of every run of one to three characters per language, over whole texts.

    Each task counts its texts first, so what is shuffled is the vocabulary
    of its share and not its text.
    """
    labelled = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    lowered = labelled.select(F.col(lang).alias("lang"), L.profile_text(F.col(text)).alias("t"))
    partial = lowered.mapInPandas(L.count_grams, "lang string, gram string, n bigint")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train_profile(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The profile table: ``gram``, ``lang``, ``micro`` (log-probability in
    millionths, smoothed by adding one among the grams of the same length),
    complete over all grams and languages."""
    counts = gram_counts(df, text, lang)
    totals = counts.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang"))
    grams = cut_lineage(totals)
    cells = grams.select("gram", F.explode("by_lang").alias("lang", "n"))
    size = F.length("gram")
    # A row for each label of a language and length of grams.
    seen = {(r["lang"], r["size"]): r["seen"] for r in cells.groupBy("lang", size.alias("size")).agg(F.sum("n").alias("seen")).collect()}
    kinds = {r["size"]: r["kinds"] for r in grams.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("kinds")).collect()}
    table = F.array(
        *[
            F.struct(
                F.lit(lang).alias("lang"),
                F.array(*[F.lit(float(seen.get((lang, n), 0) + kinds.get(n, 0))) for n in L.ORDERS]).alias("mass"),
            )
            for lang in sorted({lang for lang, _ in seen})
        ]
    )
    if not seen:
        return grams.select("gram", F.lit("").alias("lang"), F.lit(0).cast("long").alias("micro")).limit(0)
    return (
        grams.select("gram", "by_lang", F.explode(table).alias("l"))
        .select(
            "gram",
            F.col("l.lang").alias("lang"),
            F.round(
                F.log((F.coalesce(F.try_element_at("by_lang", F.col("l.lang")), F.lit(0)) + 1) / F.element_at("l.mass", size))
                * L.MICRO
            )
            .cast("long")
            .alias("micro"),
        )
    )


def broadcast_profile(profile: DataFrame):
    """Hand a profile to the executors if its size allows; a larger one stays a table.

    ``detect`` takes either.
    """
    profile = cut_lineage(profile)
    if profile.count() > BROADCAST_CELLS:
        return profile
    rows = (
        profile.groupBy("gram")
        .agg(F.sort_array(F.collect_list(F.struct("lang", "micro"))).alias("cells"))
        .select("gram", F.col("cells.lang").alias("langs"), F.col("cells.micro").alias("micro"))
        .toPandas()
    )
    languages = list(rows["langs"].iat[0])
    model = L.Profile(languages, rows["gram"].tolist(), np.array(rows["micro"].tolist(), dtype=np.int64))
    return profile.sparkSession.sparkContext.broadcast(model)


def detect(df: DataFrame, profile, text: str = "text", min_chars: int = L.MIN_CHARS) -> DataFrame:
    """Adds ``language`` and ``language_score``, null for texts of fewer than ``min_chars`` characters.

    With a broadcast profile that is one Arrow pass without a shuffle; with a
    profile table the grams of the texts are joined with it.
    """
    if isinstance(profile, DataFrame):
        return _detect_by_join(df, profile, text, min_chars)
    found = compute_once(df, _lang=L.best_language(F.col(text), profile, min_chars))
    return found.select(*df.columns, "_lang.language", "_lang.language_score")


def _detect_by_join(df: DataFrame, profile: DataFrame, text: str, min_chars: int) -> DataFrame:
    """Sums up log-probabilities by row and language, in the integers of the other way."""
    rows = write_table(df.withColumn("_row", F.monotonically_increasing_id()))
    texts = rows.filter(F.col(text).isNotNull()).select("_row", L.profile_text(F.col(text)).alias("t"))
    counts = texts.mapInPandas(lambda batches: L.count_row_grams(batches, min_chars), "_row bigint, gram string, n bigint")
    sums = counts.join(profile, "gram").groupBy("_row", "lang").agg(F.sum(F.col("n") * F.col("micro")).alias("micro"))
    # The largest sum, of equal ones the first language.
    by_row = sums.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct((-F.col("micro")).alias("less"), "lang"))).alias("cells"))
    gaps = F.transform("cells", lambda c: F.exp((F.col("cells")[0]["less"] - c["less"]) / L.MICRO))
    total = F.aggregate(gaps, F.lit(0.0), lambda a, b: a + b)
    best = by_row.select("_row", F.col("cells")[0]["lang"].alias("language"), F.round(1.0 / total, 6).alias("language_score"))
    return rows.join(best, "_row", "left").select(*df.columns, "language", "language_score")


def detect_simple(df: DataFrame, profile, text: str = "text") -> DataFrame:
    """Adds ``language`` only."""
    return detect(df, profile, text).drop("language_score")


def is_allowed(allowed: Sequence[str]) -> Column:
    """Whether the detected language is on the list; undetected is not."""
    return F.coalesce(F.col("language").isin(list(allowed)), F.lit(False))


def filter_by_language(df: DataFrame, profile, allowed: Sequence[str], text: str = "text") -> DataFrame:
    """Adds ``is_allowed``, ``language``, ``language_score``."""
    return detect(df, profile, text).withColumn("is_allowed", is_allowed(allowed))


def apply_allow_list(df: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """Drops rows in other languages; an empty list switches this off.

    With ``lang_confidence`` set, rows detected with less are dropped as well.
    """
    reject = F.lit(False)
    if cfg.allowed_languages:
        reject = ~is_allowed(cfg.allowed_languages)
    if cfg.lang_confidence is not None:
        reject = reject | (F.coalesce(F.col("language_score"), F.lit(0.0)) < cfg.lang_confidence)
    hit = ~F.col("dropped") & reject
    reason = F.concat(F.lit("language_filtered_"), F.coalesce(F.col("language"), F.lit("None")))
    return (
        df.withColumn("drop_reason", F.when(hit, reason).otherwise(F.col("drop_reason")))
        .withColumn("text", F.when(~hit, F.col("text")))
        .withColumn("dropped", F.col("drop_reason").isNotNull())
    )


def language_counts(df: DataFrame) -> DataFrame:
    """Records per detected language; the null row counts failures."""
    return df.groupBy("language").agg(F.count(F.lit(1)).alias("records"))


def detection_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("language").alias("total_detected"),
        F.count_if(F.col("language").isNull()).alias("detection_failures"),
    )
