"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.config import CorpusConfig
from textquarry.functions import text as T
from textquarry.functions import words as W
from textquarry.functions.frames import compute_once
from textquarry.functions.spans import DEFAULT_RULES, Rule, entities
from textquarry.operators import cleaning, dedup, language, mixture, pii, stats, tokens
from textquarry.operators.dedup_index import DuplicateIndex
from textquarry.plans import corpus, jobs, report
from textquarry.session import cut_lineage, shared_dir, ship_package, shuffles_go, write_table
from textquarry.sources import ledger, records, sinks
from textquarry.sources.tables import read_documents, read_table, spread
from textquarry.streaming import ingest

CFG = CorpusConfig()
GATED = CFG.with_(max_length=5_000)
EXACT = CFG.with_(dup_method="exact")
WEIGHTS = {"en": 3.0, "fr": 2.0, "de": 1.0}
SEED = 7
EXTRA_RULE = Rule("NUMBER", r"(?U)\b\d{5,}\b", 0.6)
MERGES = 24  # that SQL follows one by one, beside the queries with the whole vocabulary
CHARACTERS = CFG.with_(vocab_size=0)  # no merges: every character is a token


def big(column: str) -> F.Column:
    return F.col(column).cast("long").alias(column)


def cleaned(spark: SparkSession, sf: str, cfg: CorpusConfig = CFG) -> DataFrame:
    return cleaning.clean(read_documents(spark, sf), cfg)


def kept(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.valid_rows(cleaned(spark, sf)).select("seq", "text")


def person_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, pages, and sentences made from customers and orders that
    hold numbers in the notation of social security and telephone numbers."""
    docs = read_table(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), "doc_id").alias("id"), "text"
    )
    pages = read_table(spark, sf, "pages").select(
        F.concat(F.lit("page-"), "page_id").alias("id"), F.col("html").alias("text")
    )
    customers = read_table(spark, sf, "customer").select(
        F.concat(F.lit("cust-"), "c_custkey").alias("id"),
        F.concat(
            "c_name",
            F.lit(" holds 123-45-"),
            F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"),
            F.lit(" and writes from "),
            F.lower("c_mktsegment"),
            F.col("c_custkey"),
            F.lit("@example.com."),
        ).alias("text"),
    )
    orders = read_table(spark, sf, "orders").select(
        F.concat(F.lit("order-"), "o_orderkey").alias("id"),
        F.concat(
            F.lit("Call 555-"),
            F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"),
            F.lit("."),
            F.lpad((F.col("o_custkey") % 10000).cast("string"), 4, "0"),
            F.lit(" about "),
            F.col("o_orderkey"),
        ).alias("text"),
    )
    return spread(docs.unionByName(pages).unionByName(customers).unionByName(orders), "id")


def profile(spark: SparkSession, sf: str):
    return language.broadcast_profile(language.train_profile(read_documents(spark, sf)))


def detected(spark: SparkSession, sf: str) -> DataFrame:
    return language.detect(cleaned(spark, sf), profile(spark, sf))


def datasets(spark: SparkSession, sf: str) -> DataFrame:
    return read_documents(spark, sf).withColumn("dataset", F.col("lang"))


# ------------------------------------------------------------------ sources


def a1_jsonl_extract(spark, sf):
    """Lines of four kinds: objects, bare strings, objects without text, broken ones."""
    docs = read_documents(spark, sf)
    quoted = F.to_json(F.array("text"))
    line = (
        F.when(F.col("lang") == "en", F.to_json(F.struct("seq", "text")))
        .when(F.col("lang") == "fr", F.substring(quoted, F.lit(2), F.length(quoted) - 2))
        .when(F.col("lang") == "de", F.to_json(F.struct("seq", F.col("text").alias("body"))))
        .otherwise(F.concat(F.lit('{"text": '), "text"))
    )
    return records.parse_lines(docs.select("seq", line.alias("value"))).select("seq", "text", "malformed")


def a4_load_files(spark, sf):
    return records.load_texts(spark, [f"{sf}/documents.parquet"]).select("seq", "text")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_dir(spark)}/{uuid.uuid4()}-{name}"


def documents_jsonl(spark: SparkSession, sf: str) -> str:
    """The documents as JSON lines, in order, in as many files as the sort has partitions."""
    path = scratch(spark, "documents.jsonl")
    with shuffles_go(spark):
        read_documents(spark, sf).orderBy("seq").select("text").write.json(path, compression="gzip")
    return path


def a1_read_jsonl(spark, sf):
    return records.load_texts(spark, [documents_jsonl(spark, sf)]).select("seq", "text")


def a2_read_json(spark, sf):
    """Benchmark items as files that hold an array of up to 16 each."""
    items = read_table(spark, sf, "benchmark").withColumn("part", F.floor(F.col("item_id") / 16))
    arrays = items.groupBy("part").agg(F.to_json(F.collect_list(F.struct("item_id", "text"))).alias("value"))
    path = scratch(spark, "items.json")
    arrays.write.partitionBy("part").text(path)
    return records.load_texts(spark, [path]).select("text")


def a3_read_txt(spark, sf):
    """Benchmark items as one file each; the writer ends each with a line feed."""
    path = scratch(spark, "items.txt")
    read_table(spark, sf, "benchmark").select("item_id", F.col("text").alias("value")).write.partitionBy("item_id").text(path)
    return records.load_texts(spark, [path]).select(F.regexp_replace("text", "\\n\\z", "").alias("text"))


def a11_dedup_job_files(spark, sf):
    """The job from files to files, and the statistics it left."""
    return _dedup_job_files(spark, sf, EXACT)


def a11_dedup_job_files_near(spark, sf):
    return _dedup_job_files(spark, sf, CFG)


def _dedup_job_files(spark, sf, cfg):
    out = scratch(spark, "dedup")
    jobs.dedup_job(spark, [documents_jsonl(spark, sf)], out, cfg)
    counts = ("total", "unique", "duplicates", "too_short", "too_long", "empty")
    return jobs.read_dedup_stats(spark, out).select(*[big(c) for c in counts], "duplicate_rate")


def r4_clean_job(spark, sf):
    out = scratch(spark, "clean")
    jobs.clean_job(spark, [documents_jsonl(spark, sf)], out, CFG)
    return spark.read.schema("text string, dropped boolean, drop_reason string").json(f"{out}/cleaned")


def a6_list_files(spark, sf):
    return records.list_files(spark, sf, "*.parquet").select(F.regexp_extract("path", "[^/]+$", 0).alias("name"))


def a7_ledger_antijoin(spark, sf):
    pages = read_table(spark, sf, "pages").select("page_id", "url")
    done = pages.filter(F.col("url").startswith("https:")).select(ledger.target_name(F.col("url")).alias("name"))
    return ledger.pending(pages, done).select("page_id", "url", "name")


def a8_head_sample(spark, sf):
    return records.head_sample(read_documents(spark, sf), 100).select("seq", "text")


def a8_head_tenth(spark, sf):
    """The first tenth of all records."""
    docs = read_documents(spark, sf).select("seq", "text")
    return records.head_sample(docs, docs.count() // 10)


def a10_nonempty(spark, sf):
    return records.nonempty(cleaned(spark, sf)).select("seq", "text")


# ----------------------------------------------------------------- cleaning


def c7_clean_text(spark, sf):
    return cleaned(spark, sf, GATED).select("seq", "text", "dropped", "drop_reason")


def c8_drop_counts(spark, sf):
    return cleaning.drop_counts(cleaned(spark, sf, GATED))


def c12_cleaning_totals(spark, sf):
    return cleaning.cleaning_totals(cleaned(spark, sf, GATED))


def c13_valid_rows(spark, sf):
    return cleaning.valid_rows(cleaned(spark, sf, GATED)).select("seq", big("length_before"))


def _with_controls(spark, sf):
    odd = F.lit("\x01 a[] \x02] &] ^] b\x7f \x85 c\x00d".replace("\x00", "\x03"))
    return read_documents(spark, sf).select("seq", F.concat("text", odd).alias("text"))


def c5_control_intent(spark, sf):
    return _with_controls(spark, sf).select("seq", T.scrub(F.col("text"), "intent").alias("text"))


def c5_control_parity(spark, sf):
    return _with_controls(spark, sf).select("seq", T.scrub(F.col("text"), "parity").alias("text"))


def c9_normalize_ws(spark, sf):
    return read_documents(spark, sf).select("seq", T.normalize_whitespace(F.col("text")).alias("text"))


def c10_remove_urls(spark, sf):
    pages = spread(read_table(spark, sf, "pages"), "page_id")
    text = F.concat_ws(" ", "url", "html", "url")
    return pages.select("page_id", T.remove_urls(text).alias("text"))


def c11_remove_emails(spark, sf):
    return person_texts(spark, sf).select("id", T.remove_emails(F.col("text")).alias("text"))


def c14_project_ids(spark, sf):
    rows, _ = _first_encoded(spark, sf)
    return tokens.project_ids(rows).select(F.array_join(F.col("token_ids").cast("array<string>"), " ").alias("token_ids"))


def c15_size_report(spark, sf):
    """The job that writes ids alone, and the sizes it reports."""
    rows, _ = _first_encoded(spark, sf)
    sizes = jobs.reduce_job(rows.select("seq", "text", "token_ids"), scratch(spark, "ids"))
    return sizes.select(
        "input_bytes",
        "output_bytes",
        F.round("input_mb", 6).alias("input_mb"),
        F.round("output_mb", 6).alias("output_mb"),
        F.round("reduction_pct", 6).alias("reduction_pct"),
    )


# ----------------------------------------------------------------- language


def l6_detection_totals(spark, sf):
    return language.detection_totals(detected(spark, sf))


def l8_words(spark, sf):
    """The language of each distinct word, of single characters too."""
    words = tokens.word_counts(read_documents(spark, sf)).select("word")
    return language.detect(words, profile(spark, sf), text="word", min_chars=1).select("word", "language", "language_score")


def l7_profile_counts(spark, sf):
    return language.gram_counts(read_documents(spark, sf))


def l7_profile(spark, sf):
    return language.train_profile(read_documents(spark, sf))


def l1_detect(spark, sf):
    return detected(spark, sf).select("seq", "language", "language_score")


def l2_detect_simple(spark, sf):
    return language.detect_simple(read_documents(spark, sf), profile(spark, sf)).select("seq", "language")


def l3_filter_by_language(spark, sf):
    rows = language.filter_by_language(read_documents(spark, sf), profile(spark, sf), ["en", "es"])
    return rows.select("seq", "is_allowed", "language")


def l4_allow_list(spark, sf):
    return language.apply_allow_list(detected(spark, sf), CFG).select("seq", "text", "dropped", "drop_reason")


def l5_confidence(spark, sf):
    """English texts detected with less than full confidence are dropped as well."""
    rows = language.apply_allow_list(detected(spark, sf), CFG.with_(lang_confidence=0.999999))
    return rows.select("seq", "dropped", "drop_reason")


def l6_language_counts(spark, sf):
    return language.language_counts(detected(spark, sf))


# --------------------------------------------------------------- duplicates


def d1_content_hash(spark, sf):
    return read_documents(spark, sf).select("seq", dedup.content_hash(F.col("text")).alias("hash"))


def d2_exact_dedup(spark, sf):
    return dedup.mark_exact(kept(spark, sf)).select("seq", "is_duplicate")


def d3_shingle_counts(spark, sf):
    return read_documents(spark, sf).select("seq", F.size(T.shingles(F.col("text"), 5)).cast("long").alias("shingles"))


def _signature_rows(spark, sf, family):
    sigs = dedup.signatures(kept(spark, sf), CFG.with_(hash_family=family))
    return sigs.select("seq", F.posexplode("sig").alias("perm", "value"))


def d4_signature_affine(spark, sf):
    return _signature_rows(spark, sf, "affine").select("seq", big("perm"), "value")


def d4_signature_sha1(spark, sf):
    rows = _signature_rows(spark, sf, "sha1")
    return rows.select("seq", big("perm"), F.lower(F.hex("value")).alias("digest"))


def d5_bucket_sizes(spark, sf):
    sizes = dedup.bucket_sizes(dedup.signatures(kept(spark, sf), CFG))
    return sizes.groupBy(big("band"), "n").agg(F.count(F.lit(1)).alias("buckets"))


def d6_candidates(spark, sf):
    """Whether a record shares a band with any earlier one."""
    return dedup.with_candidate_flag(cut_lineage(dedup.signatures(kept(spark, sf), CFG).select("seq", "keys")))


def d7_leader_similarity(spark, sf):
    pairs = dedup.leader_pairs(cut_lineage(dedup.signatures(kept(spark, sf), CFG)))
    return pairs.select("a", "b", (F.col("matches") / CFG.num_perm).alias("similarity"))


def d8_greedy_keep_first(spark, sf):
    return dedup.mark_duplicates(kept(spark, sf), CFG).select("seq", "is_duplicate")


def d8_greedy_sha1(spark, sf):
    return dedup.mark_duplicates(kept(spark, sf), CFG.with_(hash_family="sha1")).select("seq", "is_duplicate")


def d11_filter_duplicates(spark, sf):
    return dedup.filter_duplicates(kept(spark, sf), EXACT).select("seq", "text")


def d11_filter_duplicates_near(spark, sf):
    return dedup.filter_duplicates(kept(spark, sf), CFG).select("seq", "text")


def d12_dedup_totals(spark, sf):
    return dedup.dedup_totals(dedup.mark_exact(kept(spark, sf)))


def d13_dedup_job(spark, sf):
    return _dedup_job(spark, sf, EXACT)


def d13_dedup_job_near(spark, sf):
    return _dedup_job(spark, sf, CFG)


def _dedup_job(spark, sf, cfg):
    docs = read_documents(spark, sf).withColumn("malformed", F.lit(False))
    return jobs.dedup_stats(jobs.dedup_outcomes(docs, cfg))


def d15_index_two_runs(spark, sf):
    """The second half of the records against an index of the first."""
    rows = write_table(kept(spark, sf))
    middle = rows.agg(F.percentile_approx("seq", 0.5)).first()[0]
    index = DuplicateIndex(spark, scratch(spark, "index"), CFG)
    halves = [rows.filter(F.col("seq") <= middle), rows.filter(F.col("seq") > middle)]
    later = [index.add(half, run) for run, half in enumerate(halves)]
    return dedup.mark_known(rows, later[0].unionByName(later[1])).select("seq", "is_duplicate")


def d14_inline_marking(spark, sf):
    """Duplicates among cleaned texts, marked but not removed."""
    return _inline_marking(spark, sf, EXACT)


def d14_inline_marking_near(spark, sf):
    return _inline_marking(spark, sf, CFG)


def _inline_marking(spark, sf, cfg):
    cfg = cfg.with_(dedup_stage="pre_pii", remove_duplicates=False, allowed_languages=None)
    rows = corpus.process_records(read_documents(spark, sf), cfg, profile(spark, sf))
    return rows.select("seq", "dropped", "is_duplicate", F.coalesce("length", F.lit(0)).cast("long").alias("length"))


# ------------------------------------------------------------ personal data


def _matches(spark, sf, at):
    rule = DEFAULT_RULES[at]
    found = compute_once(person_texts(spark, sf), hits=entities(F.col("text"), [rule]))
    return found.select("id", F.explode("hits.text").alias("match"))


def p1_email(spark, sf):
    return _matches(spark, sf, 0)


def p2_phone(spark, sf):
    return _matches(spark, sf, 1)


def p3_ssn(spark, sf):
    return _matches(spark, sf, 2)


def _spans(df):
    return df.select("id", F.inline("pii_entities")).select(
        "id", "type", big("start"), big("end"), "score", F.col("text").alias("match")
    )


def p4_spans(spark, sf):
    return _spans(pii.detect(person_texts(spark, sf)))


def p7_redact(spark, sf):
    return pii.anonymize(person_texts(spark, sf)).select("id", "text")


def p9_has_pii(spark, sf):
    return pii.has_pii(person_texts(spark, sf)).select("id", "has_pii")


def p10_score_threshold(spark, sf):
    return pii.type_counts(pii.detect(person_texts(spark, sf), min_score=0.85))


def p11_type_counts(spark, sf):
    return pii.type_counts(pii.detect(person_texts(spark, sf)))


def p11_detection_totals(spark, sf):
    return pii.detection_totals(pii.detect(person_texts(spark, sf)))


def p12_annotation(spark, sf):
    rows = person_texts(spark, sf).withColumns({"dropped": F.lit(False), "drop_reason": F.lit(None).cast("string")})
    return pii.annotate(rows, CFG).select("id", "has_pii", "pii_redacted", big("pii_count"), big("length"))


def p14_rule_table(spark, sf):
    return _spans(pii.detect(person_texts(spark, sf), rules=[*DEFAULT_RULES, EXTRA_RULE]))


# ------------------------------------------------------------------- tokens


def t1_normalize(spark, sf):
    return read_documents(spark, sf).select("seq", W.normalize(F.col("text")).alias("text"))


def t2_pretokenize(spark, sf):
    words = tokens.words_of(read_documents(spark, sf).select("seq", "text"))
    return words.select("seq", F.array_join("words", " ").alias("words"))


def t3_word_counts(spark, sf):
    return tokens.word_counts(read_documents(spark, sf))


def t4_bpe_train(spark, sf):
    return tokens.train(tokens.word_counts(read_documents(spark, sf)), "bpe", CFG.vocab_size)[0].select(big("id"), "token")


def t5_wordpiece_train(spark, sf):
    return tokens.train(tokens.word_counts(read_documents(spark, sf)), "wordpiece", CFG.vocab_size)[0].select(big("id"), "token")


def _first_merges(spark, sf, kind="bpe"):
    """The vocabulary after ``MERGES`` merges."""
    counts = cut_lineage(tokens.word_counts(read_documents(spark, sf)))
    return tokens.train(counts, kind, len(tokens.start(counts, kind)) + MERGES)


def t4_bpe_first_merges(spark, sf):
    return _first_merges(spark, sf)[0].select(big("id"), "token")


def t5_wordpiece_first_merges(spark, sf):
    return _first_merges(spark, sf, "wordpiece")[0].select(big("id"), "token")


def t6_saved_vocabulary(spark, sf):
    """The same after it was written and read back."""
    path = scratch(spark, "vocabulary")
    tokens.save(*_first_merges(spark, sf), path)
    return tokens.load(spark, path)[0].select(big("id"), "token")


def t4_alphabet(spark, sf):
    """The vocabulary before the first merge."""
    return tokens.train(tokens.word_counts(read_documents(spark, sf)), "bpe", 0)[0].select(big("id"), "token")


def t4_pair_counts(spark, sf):
    """Adjacent characters over all words, what the first merge is chosen from."""
    counts = cut_lineage(tokens.word_counts(read_documents(spark, sf)))
    table = tokens.start(counts, "bpe")
    pairs = tokens.pair_counts(tokens.spell(counts, "bpe", {t: i for i, t in enumerate(table)}))
    return pairs.select(big("left"), big("right"), "n")


def _encoded(spark, sf, size):
    docs = read_documents(spark, sf).select("seq", "text")
    vocab = tokens.train(tokens.word_counts(docs), "bpe", size)
    ready = tokens.broadcast_vocabulary(*vocab, "bpe")
    return tokens.encode(docs, ready), ready


def _first_encoded(spark, sf):
    ready = tokens.broadcast_vocabulary(*_first_merges(spark, sf), "bpe")
    return tokens.encode(read_documents(spark, sf).select("seq", "text"), ready), ready


def _joined_ids():
    return F.array_join(F.col("token_ids").cast("array<string>"), " ").alias("token_ids")


def t7_encode(spark, sf):
    """With the whole vocabulary."""
    rows, _ = _encoded(spark, sf, CFG.vocab_size)
    return rows.select("seq", _joined_ids())


def t7_encode_first_merges(spark, sf):
    rows, _ = _first_encoded(spark, sf)
    return rows.select("seq", _joined_ids(), big("token_length"))


def t9_round_trip(spark, sf):
    """Ids of the whole vocabulary decoded: the tokens, which spell the words of the text."""
    rows, ready = _encoded(spark, sf, CFG.vocab_size)
    return tokens.decode(rows, ready).select("seq", F.replace("decoded", F.lit(" "), F.lit("")).alias("spelled"))


def t7_encode_characters(spark, sf):
    """With no merges every character is a token."""
    rows, _ = _encoded(spark, sf, 0)
    return rows.select(
        "seq", F.array_join(F.col("token_ids").cast("array<string>"), " ").alias("token_ids"), big("token_length")
    )


def t9_decode_characters(spark, sf):
    rows, ready = _encoded(spark, sf, 0)
    return tokens.decode(rows, ready).select("seq", "decoded")


def t10_token_totals(spark, sf):
    rows, _ = _first_encoded(spark, sf)
    return tokens.token_totals(rows).withColumn("avg_sequence_length", F.round("avg_sequence_length", 6))


def r5_tokenize_job(spark, sf):
    """From files to files, with characters as tokens."""
    totals = jobs.tokenize_job(spark, [documents_jsonl(spark, sf)], scratch(spark, "tokenized"), CHARACTERS)
    return totals.withColumn("avg_sequence_length", F.round("avg_sequence_length", 6))


# --------------------------------------------------------- shards, mixtures


def e2_shards(spark, sf):
    sharded = mixture.with_shard(read_documents(spark, sf).select("seq", "n_chars"), 64)
    return sharded.groupBy(big("shard")).agg(
        F.count(F.lit(1)).alias("records"), F.min("seq").alias("first"), F.max("seq").alias("last"), F.sum("n_chars").alias("chars")
    )


def e1_jsonl_read_back(spark, sf):
    path = scratch(spark, "kept")
    sinks.export_jsonl(kept(spark, sf), path)
    return spark.read.schema("seq bigint, text string").json(path)


def e3_shards_read_back(spark, sf):
    path = scratch(spark, "shards")
    sinks.export_shards(read_documents(spark, sf).select("seq", "n_chars"), path, 64)
    rows = spark.read.schema("seq bigint, n_chars bigint, shard string").json(path)
    return rows.groupBy("shard").agg(
        F.count(F.lit(1)).alias("records"), F.min("seq").alias("first"), F.max("seq").alias("last"), F.sum("n_chars").alias("chars")
    )


def e10_mixture_read_back(spark, sf):
    path = scratch(spark, "mixture")
    sinks.export_mixture(datasets(spark, sf), path, WEIGHTS, SEED)
    return spark.read.schema("dataset string, seq bigint, text string").json(f"{path}/mixture")


def e4_sample_sizes(spark, sf):
    return mixture.sample_sizes(datasets(spark, sf), WEIGHTS).select(
        "dataset", F.round("weight", 9).alias("weight"), "available", "samples"
    )


def e5_proportional(spark, sf):
    sizes = mixture.sample_sizes(datasets(spark, sf), WEIGHTS, mode="proportional", total=read_documents(spark, sf).count() // 3)
    return sizes.select("dataset", F.round("weight", 9).alias("weight"), "available", "samples")


def e6_mixture_sample(spark, sf):
    return mixture.sample(datasets(spark, sf), WEIGHTS, SEED).select("dataset", "seq", "text")


def e7_mixture_order(spark, sf):
    """Position of each sampled record in the shuffled mixture."""
    mixed = mixture.sample(datasets(spark, sf).drop("text"), WEIGHTS, SEED)
    order = mixture._draw(SEED + 1, F.col("dataset"), F.col("seq"))
    ranked = mixture.with_index(mixed.withColumn("draw", F.struct(order.alias("h"), "seq")), "draw")
    return ranked.select("dataset", "seq", big("index"))


def e8_mixture_metadata(spark, sf):
    meta = mixture.mixture_metadata(datasets(spark, sf), WEIGHTS)
    return meta.select(
        F.array_join("datasets", ",").alias("datasets"),
        F.array_join(F.transform(F.map_entries("samples_per_dataset"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias(
            "samples_per_dataset"
        ),
        "total_samples",
    )


def e8_mixture_weights(spark, sf):
    meta = mixture.mixture_metadata(datasets(spark, sf), WEIGHTS)
    return meta.select(F.explode("mixture_weights").alias("dataset", "weight")).withColumn("weight", F.round("weight", 9))


def e10_report_read_back(spark, sf):
    """The report of a run from files to files, read from where it was written."""
    out = scratch(spark, "run")
    corpus.run_corpus(spark, [documents_jsonl(spark, sf)], out, CFG, profile(spark, sf), tokenize=False)
    rows = spark.read.schema("metric string, value double").json(f"{out}/report")
    return rows.select("metric", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- statistics


def _n_chars(spark, sf):
    docs = read_table(spark, sf, "documents")
    return stats.value_counts(docs, text=F.col("n_chars"))


def i1_length_stats(spark, sf):
    s = stats.length_stats(_n_chars(spark, sf))
    return s.select("name", "count", "min", "max", *[F.round(c, 6).alias(c) for c in s.columns[4:]])


def i2_histogram(spark, sf):
    h = stats.histogram(_n_chars(spark, sf))
    return h.select(
        "name", big("bin"), F.round("bin_low", 6).alias("bin_low"), F.round("bin_high", 6).alias("bin_high"), "n",
        F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"),
    )


def i3_drop_reasons(spark, sf):
    return stats.drop_reasons(language.apply_allow_list(detected(spark, sf), CFG))


def i4_language_stats(spark, sf):
    s = stats.language_stats(detected(spark, sf))
    return s.select(
        "language", "records", F.round("mean_score", 6).alias("mean_score"), F.round("median_score", 6).alias("median_score")
    )


def _price_scores(spark, sf):
    """Order priorities in the place of languages, prices scaled to scores."""
    orders = read_table(spark, sf, "orders")
    return orders.select(
        F.col("o_orderpriority").alias("language"), F.round(F.col("o_totalprice") / 1000000, 4).alias("language_score")
    )


def i5_language_box(spark, sf):
    b = stats.language_box(_price_scores(spark, sf))
    return b.select("language", *[F.round(c, 6).alias(c) for c in b.columns[1:6]], "outliers")


def i5_language_outliers(spark, sf):
    """Orders in the place of records, with prices beyond the whiskers of their priority."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("language"), F.round(F.col("o_totalprice") / 1000000, 4).alias("language_score"))
    return stats.language_outliers(orders)


def i5_detected_box(spark, sf):
    b = stats.language_box(detected(spark, sf))
    return b.select("language", *[F.round(c, 6).alias(c) for c in b.columns[1:6]], "outliers")


def i5_detected_outliers(spark, sf):
    return stats.language_outliers(detected(spark, sf)).select("seq", "language", "language_score")


def i5_word_outliers(spark, sf):
    """Words whose language is much less certain than that of others in it."""
    return stats.language_outliers(l8_words(spark, sf)).select("word", "language", "language_score")


def i11_detected_languages(spark, sf):
    s = stats.ranked_languages(detected(spark, sf))
    return s.select("language", "records", F.round("mean_score", 6).alias("mean_score"), F.round("median_score", 6).alias("median_score"))


def i11_ranked_languages(spark, sf):
    s = stats.ranked_languages(_price_scores(spark, sf))
    return s.select("language", "records", F.round("mean_score", 6).alias("mean_score"), F.round("median_score", 6).alias("median_score"))


def i11_ranked_pii(spark, sf):
    s = stats.ranked_pii(pii.detect(person_texts(spark, sf)).withColumn("dropped", F.lit(False)))
    return s.select("type", "hits", F.round("hit_rate", 9).alias("hit_rate"))


def i9_upper_median(spark, sf):
    return stats.upper_median(_n_chars(spark, sf))


def _outcome(spark, sf, cfg=EXACT):
    return corpus.process_records(read_documents(spark, sf), cfg, profile(spark, sf))


def i6_duplicate_stats(spark, sf):
    return _duplicate_stats(spark, sf, EXACT)


def i6_duplicate_stats_near(spark, sf):
    return _duplicate_stats(spark, sf, CFG)


def _duplicate_stats(spark, sf, cfg):
    s = stats.duplicate_stats(_outcome(spark, sf, cfg))
    return s.withColumn("duplicate_rate", F.round("duplicate_rate", 9))


def i7_pii_hits(spark, sf):
    s = stats.pii_hits(pii.detect(person_texts(spark, sf)).withColumn("dropped", F.lit(False)))
    return s.withColumn("hit_rate", F.round("hit_rate", 9))


def i8_summary(spark, sf):
    return stats.summary(_outcome(spark, sf))


def i8_summary_near(spark, sf):
    return stats.summary(_outcome(spark, sf, CFG))


def i12_headline(spark, sf):
    return report.headline(_outcome(spark, sf))


def i12_headline_near(spark, sf):
    return report.headline(_outcome(spark, sf, CFG))


def i12_headline_tokens(spark, sf):
    """With the token figures of a run whose tokens are characters."""
    run = corpus.prepare_corpus(read_documents(spark, sf), CHARACTERS, profile(spark, sf))
    h = report.headline(run.processed, run.tokenized)
    return h.withColumn("avg_sequence_length", F.round("avg_sequence_length", 6))


# ---------------------------------------------------------------- whole runs


def _rows(processed: DataFrame) -> DataFrame:
    """Outcome per record; numbers that dropped records lack are given as 0."""
    return processed.select(
        "seq",
        "text",
        "dropped",
        "drop_reason",
        "language",
        "is_duplicate",
        "has_pii",
        "pii_redacted",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("pii_count", "length")],
    )


def r1_process_exact(spark, sf):
    return _rows(_outcome(spark, sf))


def r2_full_run(spark, sf):
    return _rows(_outcome(spark, sf, CFG))


def r2_files_to_files(spark, sf):
    """What a run over JSON lines retains, as its output files have it."""
    out = scratch(spark, "run")
    corpus.run_corpus(spark, [documents_jsonl(spark, sf)], out, CFG, profile(spark, sf))
    rows = spark.read.schema("text string, language string, pii_count bigint, length bigint").json(f"{out}/tokenized_data")
    return rows.select("text", "language", "pii_count", "length")


def r2_files_with_tokens(spark, sf):
    """The same with characters as tokens, and the ids in the files."""
    out = scratch(spark, "run")
    corpus.run_corpus(spark, [documents_jsonl(spark, sf)], out, CHARACTERS, profile(spark, sf))
    rows = spark.read.schema("text string, token_ids array<int>, token_length bigint").json(f"{out}/tokenized_data")
    return rows.select("text", _joined_ids(), "token_length")


def r2_report(spark, sf):
    rows = corpus.prepare_corpus(read_documents(spark, sf), CFG, profile(spark, sf), tokenize=False).report
    return rows.select("metric", F.round("value", 6).alias("value"))


def r2_with_tokens(spark, sf):
    run = corpus.prepare_corpus(read_documents(spark, sf), CFG, profile(spark, sf))
    return run.tokenized.select("seq", "language", big("length"), big("token_length"))


def r3_stream_chunks(spark, sf):
    """The documents through the stream, then the search for duplicates."""
    return _stream_chunks(spark, sf, EXACT)


def r3_stream_chunks_near(spark, sf):
    return _stream_chunks(spark, sf, CFG)


def _stream_chunks(spark, sf, cfg):
    out = f"{shared_dir(spark)}/chunks-{uuid.uuid4()}"
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    # As a pattern the path may name a file or a folder of files.
    stream = ingest.file_stream(spark, f"{sf}/documents.parque[t]", schema).withColumnRenamed("doc_id", "seq")
    ingest.write_chunks(stream, cfg, profile(spark, sf), out)
    return _rows(ingest.finish(spark, cfg, out))


def r3_chunked_resume(spark, sf):
    """Twelve chunks of counted rows, stopped after five and taken up again."""
    docs, out = read_documents(spark, sf), scratch(spark, "chunks")
    cfg = CFG.with_(chunk_size=-(-docs.count() // 12))
    known = profile(spark, sf)
    for chunks in (5, None):
        stream = ingest.stage_chunks(docs, cfg, f"{out}/staged")
        ingest.write_chunks(stream, cfg, known, out, chunks=chunks)
    return _rows(ingest.finish(spark, cfg, out))


def r3_indexed_runs(spark, sf):
    """Two runs in chunks, the second with an index of the first one's records in place of their texts."""
    docs, out = read_documents(spark, sf), scratch(spark, "runs")
    cfg = CFG.with_(chunk_size=-(-docs.count() // 6))
    middle = docs.agg(F.percentile_approx("seq", 0.5)).first()[0]
    index = DuplicateIndex(spark, f"{out}/index", cfg)
    known = profile(spark, sf)
    rows = []
    for run, part in enumerate((docs.filter(F.col("seq") <= middle), docs.filter(F.col("seq") > middle))):
        stream = ingest.stage_chunks(part, cfg, f"{out}/staged-{run}")
        ingest.write_chunks(stream, cfg, known, f"{out}/run-{run}")
        rows.append(ingest.finish(spark, cfg, f"{out}/run-{run}", index, run))
    return _rows(rows[0].unionByName(rows[1]))


NAMES = [
    a1_jsonl_extract, a1_read_jsonl, a2_read_json, a3_read_txt, a4_load_files, a7_ledger_antijoin, a8_head_sample, a10_nonempty, a11_dedup_job_files,
    c5_control_intent, c5_control_parity, c7_clean_text, c8_drop_counts, c9_normalize_ws, c10_remove_urls,
    c11_remove_emails, c12_cleaning_totals, c13_valid_rows, c14_project_ids, c15_size_report,
    l1_detect, l2_detect_simple, l3_filter_by_language, l4_allow_list, l5_confidence, l6_language_counts, l7_profile_counts, l7_profile,
    d1_content_hash, d2_exact_dedup, d3_shingle_counts, d4_signature_affine, d4_signature_sha1, d5_bucket_sizes,
    d6_candidates, d7_leader_similarity, d8_greedy_keep_first, d8_greedy_sha1, d11_filter_duplicates,
    d12_dedup_totals, d13_dedup_job, d14_inline_marking,
    p1_email, p2_phone, p3_ssn, p4_spans, p7_redact, p9_has_pii, p10_score_threshold, p11_type_counts,
    p11_detection_totals, p12_annotation, p14_rule_table,
    t1_normalize, t2_pretokenize, t3_word_counts, t4_alphabet, t4_pair_counts, t4_bpe_train, t5_wordpiece_train, t7_encode,
    t7_encode_characters, t9_decode_characters, t10_token_totals,
    e1_jsonl_read_back, e2_shards, e3_shards_read_back, e10_mixture_read_back, e4_sample_sizes, e6_mixture_sample, e7_mixture_order, e8_mixture_metadata,
    i1_length_stats, i2_histogram, i3_drop_reasons, i4_language_stats, i5_language_box, i6_duplicate_stats,
    i7_pii_hits, i8_summary, i9_upper_median, i11_ranked_languages, i11_ranked_pii, i12_headline,
    r1_process_exact, r2_full_run, r2_files_to_files, r2_report, r2_with_tokens, r3_stream_chunks, r4_clean_job,
    # With near duplicates, as the library is shipped; the ones without the ending look for exact copies.
    a11_dedup_job_files_near, d11_filter_duplicates_near, d13_dedup_job_near, d14_inline_marking_near,
    i6_duplicate_stats_near, i8_summary_near, i12_headline_near, r3_stream_chunks_near,
    a6_list_files, a8_head_tenth, l6_detection_totals, l8_words, d15_index_two_runs, t4_bpe_first_merges, t5_wordpiece_first_merges,
    t6_saved_vocabulary, t7_encode_first_merges, t9_round_trip, r5_tokenize_job, e5_proportional, e8_mixture_weights,
    e10_report_read_back, i5_language_outliers, i5_detected_box, i5_detected_outliers, i5_word_outliers, i11_detected_languages,
    i12_headline_tokens, r2_files_with_tokens, r3_chunked_resume, r3_indexed_runs,
]



# As the README advises for long texts: a batch is whole in a task's memory, a few times over.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def _shipped(query):
    """The query with the package sent to the executors first, in a session with small batches."""

    @wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship_package(spark)
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        return query(spark, sf)

    return run


QUERIES = {f.__name__: _shipped(f) for f in NAMES}
