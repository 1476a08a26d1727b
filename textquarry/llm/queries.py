"""One query per operator of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, ship_package
from ..sources.tables import read_table
from . import collocations, cotraining, decontaminate, jaccard, langid, lattice, mixing, packing, pitmanyor, secrets, tokentree, variants, warc
from .oracles import ORACLES  # noqa: F401


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf, "documents").select("doc_id", "text"))
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id",
        *[secrets.count_kind(spans, kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(secrets.span_list(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_list(spans).alias("spans"),
    )


def op2_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.classes(read_table(spark, sf, "documents"))


def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(langid.remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    found = langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), docs.filter(langid.remainder(F.col("doc_id"), 3) != 1))
    return found.select("doc_id", "held_out", "language.lang_pred", "language.score", "language.margin", "language.ambiguous")


def op4_pack(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return packing.pack(docs, public_tokenizer("byte_bpe_50k.json"), end_id=2, capacity=1024)


def op5_score(spark: SparkSession, sf: str) -> DataFrame:
    part = langid.remainder(F.col("doc_id"), 10)
    return pitmanyor.scores(read_table(spark, sf, "documents"), train=part != 0, held_out=part == 0)


def edits_of(docs: DataFrame) -> F.Column:
    """Four edits of each text that follow from its id: an insertion, a removal, a replacement, an addition at the end."""
    size = F.length("text").cast("long")

    def place(k: int) -> F.Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(k)), size + 1)

    def edit(start: F.Column, length: int, insert: F.Column) -> F.Column:
        return F.struct(start.alias("start"), F.lit(length).cast("long").alias("length"), insert.alias("insert"))

    piece = F.substring("text", 1, 30)
    return F.array(edit(place(1), 0, piece), edit(place(2), 40, F.lit("")), edit(place(3), 7, F.lit("another ")), edit(size * 2, 0, piece))


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return tokentree.counts_after_edits(docs.select("doc_id", "text", edits_of(docs).alias("edits")), public_tokenizer("byte_bpe_50k.json"))


def op7_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark")
    found = decontaminate.contamination(docs, benchmark)
    lengths = F.zip_with("firsts", "afters", lambda a, b: (b - a).cast("long"))
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op8_lattice(spark: SparkSession, sf: str) -> DataFrame:
    return lattice.near_vectors(read_table(spark, sf, "embeddings"))


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages")
    records, _ = warc.archive(spark, pages, f"{shared_dir(spark)}/warc-{uuid.uuid4()}")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    return cotraining.score(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def op11_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op12_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.variant_groups(variants.word_counts(read_table(spark, sf, "documents")))


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf, "documents"))


def _shipping(query):
    @wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf)

    return run


QUERIES = {
    f.__name__: _shipping(f)
    for f in (
        op1_secrets,
        op2_jaccard,
        op3_language,
        op4_pack,
        op5_score,
        op6_token_counts,
        op7_decontaminate,
        op8_lattice,
        op9_warc,
        op10_quality,
        op11_mix,
        op12_variants,
        op13_collocations,
    )
}
