"""The full run: raw records in, training-ready records and reports out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CorpusConfig
from ..functions.spans import DEFAULT_RULES, Rule
from ..operators import cleaning, dedup, language, mixture, pii, tokens
from ..session import PACKED, discard, write_table
from ..sources import sinks
from ..sources.records import head_sample, load_texts, resolve
from . import report

PROCESSED = (
    "seq",
    "text",
    "dropped",
    "drop_reason",
    "language",
    "language_score",
    "is_duplicate",
    "has_pii",
    "pii_redacted",
    "pii_count",
    "pii_entities",
    "length",
    "length_before",
)


def annotate_records(
    df: DataFrame, cfg: CorpusConfig, profile, rules: Sequence[Rule] = DEFAULT_RULES
) -> DataFrame:
    """The row-by-row part: cleaning, language, personal data.

    Nothing in it shuffles, so it runs on a stream as it does on a table.
    """
    cleaned = cleaning.clean(df, cfg)
    known = language.apply_allow_list(language.detect(cleaned, profile), cfg)
    return pii.annotate(known, cfg, rules).withColumn("is_duplicate", F.lit(None).cast("boolean"))


def drop_duplicates(df: DataFrame, cfg: CorpusConfig, keep_text: bool, later: DataFrame | None = None) -> DataFrame:
    """Marks duplicates among the rows not dropped and drops them if wanted.

    Only ``seq`` and the text take part in the search.  ``keep_text`` tells
    whether a dropped duplicate keeps its text; ``later`` are the numbers of
    the duplicates where they are known.
    """
    rows = df.drop("is_duplicate")
    marked = dedup.mark_duplicates(rows, cfg) if later is None else dedup.mark_known(rows, later)
    if not cfg.remove_duplicates:
        return marked
    hit = F.coalesce(F.col("is_duplicate"), F.lit(False))
    marked = marked.withColumn("drop_reason", F.when(hit, F.lit("duplicate")).otherwise(F.col("drop_reason")))
    if not keep_text:
        marked = marked.withColumn("text", F.when(~hit, F.col("text")))
    return marked.withColumn("dropped", F.col("drop_reason").isNotNull())


def process_records(
    df: DataFrame, cfg: CorpusConfig, profile, rules: Sequence[Rule] = DEFAULT_RULES
) -> DataFrame:
    """Every input row with its outcome; see PROCESSED for the columns.

    ``dedup_stage='post_redact'`` compares texts after redaction and leaves
    duplicates their text; with ``remove_duplicates`` off it is skipped.
    ``'pre_pii'`` compares the cleaned texts and marks duplicates either way.
    """
    if cfg.dedup_stage == "post_redact":
        rows = write_table(annotate_records(df, cfg, profile, rules), options=PACKED)
        if cfg.remove_duplicates:
            rows = drop_duplicates(rows, cfg, keep_text=True)
    else:
        cleaned = cleaning.clean(df, cfg)
        known = write_table(language.apply_allow_list(language.detect(cleaned, profile), cfg), options=PACKED)
        rows = pii.annotate(drop_duplicates(known, cfg, keep_text=False), cfg, rules)
    return rows.select(*PROCESSED)


@dataclass
class Corpus:
    """Results of a full run."""

    processed: DataFrame
    retained: DataFrame
    tokenized: DataFrame | None
    vocabulary: tuple[DataFrame, DataFrame] | None
    report: DataFrame


def tokenize_records(
    retained: DataFrame, cfg: CorpusConfig, unk_policy: str = "unk", ordered: bool = False
) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """Trains or loads a vocabulary and encodes the retained rows with it.

    The rows and their ids are written as a table, in order and with their
    places if they are to be ``ordered``; tokens are named when they are read.
    """
    if cfg.train_tokenizer:
        counts = tokens.word_counts(retained)
        vocab = tokens.train(counts, cfg.tokenizer_type, cfg.vocab_size)
    elif cfg.tokenizer_path:
        vocab = tokens.load(retained.sparkSession, cfg.tokenizer_path)
    else:
        raise ValueError("neither train_tokenizer nor tokenizer_path is set")
    ready = tokens.broadcast_vocabulary(*vocab, cfg.tokenizer_type)

    def coded(rows: DataFrame) -> DataFrame:
        return tokens.encode_ids(rows, ready, unk_policy=unk_policy)

    table = mixture.in_order(retained, work=coded) if ordered else write_table(coded(retained), options=PACKED)
    return tokens.named(table, ready), vocab


def prepare_corpus(
    df: DataFrame,
    cfg: CorpusConfig,
    profile,
    rules: Sequence[Rule] = DEFAULT_RULES,
    tokenize: bool = True,
) -> Corpus:
    """Records given by ``seq`` and ``text`` through all stages.

    The vocabulary is trained on what is retained after redaction and removal
    of duplicates; the report covers all rows.
    """
    return _assembled(_processed(df, cfg, profile, rules), cfg, tokenize)


def _processed(df: DataFrame, cfg: CorpusConfig, profile, rules: Sequence[Rule]) -> DataFrame:
    """The outcomes as a table; the one that led to it goes."""
    outcomes = process_records(head_sample(df, cfg.sample_size), cfg, profile, rules)
    processed = write_table(outcomes, options=PACKED)
    discard(outcomes)
    return processed


def _assembled(processed: DataFrame, cfg: CorpusConfig, tokenize: bool, ordered: bool = False) -> Corpus:
    retained = processed.filter(~F.col("dropped"))
    tokenized = vocab = None
    if tokenize:
        tokenized, vocab = tokenize_records(retained, cfg, ordered=ordered)
    return Corpus(processed, retained, tokenized, vocab, report.assemble(processed, tokenized))


def run_corpus(
    spark: SparkSession,
    paths: Sequence[str],
    output: str,
    cfg: CorpusConfig,
    profile,
    rules: Sequence[Rule] = DEFAULT_RULES,
    tokenize: bool = True,
) -> Corpus:
    """The whole way from files to files.

    Sources that exist are read and numbered, go through all stages, and what
    is retained is written as JSON lines, in shards of ``cfg.shard_size`` as
    well if there are several, beside the report.  The files of lines are
    compressed by gzip: a token and its id take several times the characters
    they stand for.  Tables that others have replaced go at once.
    """
    records = load_texts(spark, resolve(spark, local_files=paths)).select("seq", "text")
    processed = _processed(records, cfg, profile, rules)
    discard(records)
    run = _assembled(processed, cfg, tokenize, ordered=True)
    sinks.export_tokenized(run.tokenized if tokenize else run.retained, output, cfg.shard_size, compression="gzip")
    if tokenize:
        run.tokenized = run.tokenized.drop(mixture.PLACE)
    sinks.export_jsonl(run.report, f"{output}/report")
    return run
