import json
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from textquarry.config import CorpusConfig
from textquarry.functions import langid as L
from textquarry.operators import dedup, language, stats, tokens
from textquarry.operators.dedup_index import DuplicateIndex
from textquarry.plans import corpus, jobs, report
from textquarry.session import settings, shared_dir
from textquarry.sources import sinks
from textquarry.sources.tables import read_documents
from textquarry.streaming import ingest


@pytest.fixture(scope="module")
def docs(spark, sf):
    return read_documents(spark, sf).cache()


@pytest.fixture(scope="module")
def profile(docs):
    return language.broadcast_profile(language.train_profile(docs))


def test_a_joined_profile_gives_the_same(docs, profile):
    table = language.train_profile(docs)
    columns = ["seq", "language", "language_score"]
    joined = language.detect(docs, table).select(columns).collect()
    assert sorted(joined) == sorted(language.detect(docs, profile).select(columns).collect())


def test_language_profile_finds_the_label(docs, profile):
    got = language.detect(docs, profile).filter(F.length("text") >= 50)
    wrong = got.filter(F.col("language") != F.col("lang")).count()
    assert wrong <= 0.02 * got.count()


def test_short_and_unknown_texts(spark, profile):
    df = spark.createDataFrame([(1, " a "), (2, None), (3, "語語語語"), (4, "the other")], "seq int, text string")
    rows = {r.seq: r for r in language.detect(df, profile).collect()}
    assert [rows[i].language for i in (1, 2, 3)] == [None] * 3 and rows[4].language == "en"
    assert rows[1].language_score is None
    cleaned = df.withColumn("dropped", F.lit(False)).withColumn("drop_reason", F.lit(None).cast("string"))
    kept = language.apply_allow_list(language.detect(cleaned, profile), CorpusConfig(allowed_languages=("en",)))
    reasons = {r.seq: r.drop_reason for r in kept.collect()}
    assert reasons == {1: "language_filtered_None", 2: "language_filtered_None", 3: "language_filtered_None", 4: None}
    everything = language.apply_allow_list(language.detect(cleaned, profile), CorpusConfig(allowed_languages=None))
    assert everything.filter("dropped").count() == 0


def test_full_run(spark, docs, profile, tmp_path):
    cfg = CorpusConfig(num_perm=64, vocab_size=75)
    run = corpus.prepare_corpus(docs, cfg, profile)
    rows = run.processed.collect()
    assert len(rows) == docs.count() and len({r.seq for r in rows}) == len(rows)
    assert all(r.dropped == (r.drop_reason is not None) for r in rows)
    assert all(r.text is not None for r in rows if r.drop_reason == "duplicate")
    assert all(r.text is None for r in rows if r.dropped and r.drop_reason != "duplicate")
    kept = [r for r in rows if not r.dropped]
    assert run.tokenized.count() == len(kept) == run.retained.count()
    figures = {r.metric: r.value for r in run.report.collect()}
    assert figures["total_samples"] == len(rows) and figures["cleaned_text_count"] == len(kept)
    lengths = sorted(r.length for r in kept)
    assert figures["cleaned_text_median"] == lengths[len(lengths) // 2]
    assert figures["duplicate_count"] == sum(bool(r.is_duplicate) for r in rows)
    assert figures["total_sequences"] == len(kept)
    sinks.export_object(report.as_object(run.report), str(tmp_path / "report"))
    (only,) = [json.loads(x) for f in (tmp_path / "report").glob("*.json") for x in f.open()]
    assert only["report"]["total_samples"] == len(rows)
    head = report.headline(run.processed, run.tokenized).first()
    assert head.total_samples == len(rows) and head.total_sequences == len(kept)
    corrected = stats.duplicate_stats(run.processed, checked_only=True).first()
    assert corrected.total_samples <= figures["duplicate_count"] + figures["unique_count"]


def test_duplicates_before_redaction(docs, profile):
    cfg = CorpusConfig(dup_method="exact", dedup_stage="pre_pii")
    rows = corpus.process_records(docs, cfg, profile).filter("drop_reason = 'duplicate'").collect()
    assert rows and all(r.text is None and r.is_duplicate for r in rows)
    off = corpus.process_records(docs, cfg.with_(dedup_stage="post_redact", remove_duplicates=False), profile)
    assert off.filter("is_duplicate IS NOT NULL").count() == 0


def test_stream_equals_batch_and_resumes(spark, docs, profile, tmp_path):
    cfg = CorpusConfig(dup_method="exact")
    source = str(tmp_path / "in")
    docs.select("seq", "text").repartition(3).write.parquet(source)
    out = str(tmp_path / "out")

    def go():
        stream = ingest.file_stream(spark, source, "seq bigint, text string", pattern="*.parquet")
        ingest.write_chunks(stream, cfg, profile, out)
        return ingest.read_chunks(spark, out)

    assert {r.batch for r in go().select("batch").distinct().collect()} == {0, 1, 2}
    assert {r.batch for r in go().select("batch").distinct().collect()} == {0, 1, 2}
    extra = spark.createDataFrame([(10_000, "One more text that is quite long enough to pass the length gate of the run.")], "seq bigint, text string")
    extra.coalesce(1).write.mode("append").parquet(source)
    assert go().count() == docs.count() + 1
    columns = ["seq", "drop_reason", "is_duplicate", "length"]
    streamed = ingest.finish(spark, cfg, out).filter("seq < 10000").select(columns)
    batch = corpus.process_records(docs, cfg, profile).select(columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def test_jobs(spark, docs, tmp_path):
    source = tmp_path / "raw.jsonl"
    texts = [r.text for r in docs.orderBy("seq").limit(40).collect()]
    lines = [json.dumps({"text": t, "k": i}) for i, t in enumerate(texts)] + ["{oops", json.dumps({"text": ""}), json.dumps({"text": texts[0]})]
    source.write_text("\n".join(lines) + "\n")
    cfg = CorpusConfig(vocab_size=70, num_perm=32)
    totals = jobs.dedup_job(spark, [str(source)], str(tmp_path / "dedup"), cfg).first()
    assert totals.total == len(lines)
    assert totals.unique + totals.duplicates + totals.too_short + totals.too_long + totals.empty == len(lines) - 1
    written = [x.rstrip("\n") for f in sorted((tmp_path / "dedup/unique").glob("*.txt")) for x in f.open()]
    assert len(written) == totals.unique and set(written) <= set(lines) and lines[-1] not in written
    assert written == [x for x in lines if x in set(written)]
    cleaned = jobs.clean_job(spark, [str(source)], str(tmp_path / "clean"), cfg).first()
    assert cleaned.total_processed == len(lines) - 1
    encoded = jobs.tokenize_job(spark, [str(source)], str(tmp_path / "tok"), cfg).first()
    assert encoded.total_sequences == len([t for t in texts if t]) + 1
    merged = report.with_dedup_stats(
        spark.createDataFrame([("a", 1.0)], "metric string, value double"), jobs.read_dedup_stats(spark, str(tmp_path / "dedup"))
    )
    assert {r.metric: r.value for r in merged.collect()}["dedup_total"] == len(lines)


COLUMNS = ["seq", "text", "drop_reason", "is_duplicate", "length"]


def test_chunks_of_counted_rows_stop_and_resume(spark, docs, profile, tmp_path, monkeypatch):
    cfg = CorpusConfig(dup_method="exact", chunk_size=18)
    out = str(tmp_path / "out")
    done = []
    annotate = ingest.annotate_records

    def failing(batch, *args):
        """The fifth chunk breaks off in the middle of its writing, once."""
        done.append(batch.count())
        rows = annotate(batch, *args)
        if len(done) == 5:
            broken = F.when(F.monotonically_increasing_id() >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("drop_reason"))
            return rows.withColumn("drop_reason", F.when(F.col("seq") % 2 == 0, F.col("drop_reason")).otherwise(broken.cast("string")))
        return rows

    monkeypatch.setattr(ingest, "annotate_records", failing)

    def go(chunks=None):
        stream = ingest.stage_chunks(docs, cfg, f"{out}/staged")
        return ingest.write_chunks(stream, cfg, profile, out, chunks=chunks)

    assert go(chunks=3) is False
    with pytest.raises(Exception, match="lost"):
        go()
    assert go(chunks=2) is False and go() is True and go() is True
    sizes = {r.batch: r["count"] for r in ingest.read_chunks(spark, out).groupBy("batch").count().collect()}
    assert len(sizes) == 12 and sorted(sizes.values()) == [2] + [18] * 11 and max(done) == 18
    rows = ingest.finish(spark, cfg, out).select(COLUMNS)
    whole = corpus.process_records(docs, cfg, profile).select(COLUMNS)
    assert sorted(map(str, rows.collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("family", ["affine", "sha1"])
def test_index_gives_the_flags_of_one_search(spark, docs, tmp_path, family):
    import shutil

    cfg = CorpusConfig(num_perm=64, hash_family=family)
    texts = docs.select("seq", "text").filter("length(text) > 50").cache()
    want = {r.seq for r in dedup.near_duplicates(texts, cfg).collect()}
    index = DuplicateIndex(spark, str(tmp_path / "index"), cfg)
    got = set()
    for run, part in enumerate(("seq < 60", "seq >= 60 AND seq < 61", "seq >= 61 AND seq < 130", "seq >= 130", "seq < 0")):
        own = str(tmp_path / f"run-{run}")
        texts.filter(part).write.parquet(own)
        rows = spark.read.parquet(own)
        found = {r.seq for r in index.add(rows, run).collect()}
        if run == 2:
            # A run repeated after a failure replaces its part of the index.
            assert {r.seq for r in index.add(rows, run).collect()} == found
        got |= found
        # Later runs can't read this one's texts any more.
        shutil.rmtree(own)
    assert got == want and len(want) > 3
    # Other settings have an index of their own.
    assert DuplicateIndex(spark, str(tmp_path / "index"), cfg.with_(threshold=0.9)).add(texts.filter("seq < 60"), 9).count() >= 0


def test_tokens_of_a_run_spell_its_texts(spark, docs, profile, tmp_path):
    """Files to files with the shipped size of the vocabulary: ids and tokens agree and spell the words."""
    source, out = str(tmp_path / "raw.jsonl"), str(tmp_path / "out")
    docs.orderBy("seq").select("text").write.json(source)
    run = corpus.run_corpus(spark, [source], out, CorpusConfig(), profile)
    table = {r.id: r.token for r in run.vocabulary[0].collect()}
    assert len(table) > 1000
    schema = "text string, tokens array<string>, token_ids array<int>, token_length int"
    rows = tokens.words_of(spark.read.schema(schema).json(f"{out}/tokenized_data")).collect()
    assert rows
    for r in rows:
        assert [table[i] for i in r.token_ids] == r.tokens and len(r.tokens) == r.token_length
        assert "".join(r.tokens) == "".join(r.words)


def test_stream_of_a_table_written_as_a_folder(spark, sf, tmp_path):
    """The same rows from one file and from a folder of files."""
    from checks.queries import QUERIES

    folder = tmp_path / "tables"
    spark.read.parquet(f"{sf}/documents.parquet").repartition(2).write.parquet(str(folder / "documents.parquet"))
    one, several = (QUERIES["r3_stream_chunks"](spark, str(at)).collect() for at in (sf, folder))
    assert len(one) == 200 and sorted(one, key=str) == sorted(several, key=str)


def test_a_position_is_looked_up_once(monkeypatch):
    """The grams of one to three characters that begin at a position are found together."""
    texts = ["", "a", "ab", "\0\0b", "a\U0001f600c", "abc" * 50]
    looked_up = []
    factorize = L.pd.factorize
    monkeypatch.setattr(L.pd, "factorize", lambda x: (looked_up.append(len(x)), factorize(x))[1])
    counts = {g: n for grams, ns in L._counted(texts) for g, n in zip(grams, ns.tolist())}
    plain = Counter(t[i : i + n] for t in texts for n in (1, 2, 3) for i in range(len(t) - n + 1))
    assert counts == plain
    grams = sorted(plain)[::2]
    micro = np.arange(2 * len(grams)).reshape(-1, 2) * 7 - 50
    by_gram = dict(zip(grams, micro.tolist()))
    got = L.Profile(["x", "y"], grams, micro).score(texts)
    for text, row in zip(texts, got.tolist()):
        own = [by_gram[g] for n in (1, 2, 3) for i in range(len(text) - n + 1) if (g := text[i : i + n]) in by_gram]
        assert row == [sum(m[0] for m in own), sum(m[1] for m in own), len(own)]
    assert sum(n > sum(map(len, texts)) for n in looked_up) == 2


def test_chunked_queries_train_one_profile(spark, sf, monkeypatch):
    trained = []
    train = language.train_profile
    monkeypatch.setattr(language, "train_profile", lambda *a, **k: (trained.append(1), train(*a, **k))[1])
    QUERIES["r3_indexed_runs"](spark, sf)
    assert len(trained) == 1


def test_a_chunk_of_one_row_group_is_dealt_to_all_cores(spark, docs, profile, tmp_path):
    """A large file is read in several splits, but its only row group belongs to one of them."""
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    docs.select("seq", "text").coalesce(1).write.parquet(source)
    with settings(spark, spark__sql__files__maxPartitionBytes="16k", spark__sql__files__openCostInBytes="0"):
        ingest.write_chunks(ingest.file_stream(spark, source, ingest.CHUNK), CorpusConfig(), profile, out)
    rows = ingest.read_chunks(spark, out)
    assert rows.count() == docs.count()
    assert rows.select(F.col("_metadata.file_path")).distinct().count() >= spark.sparkContext.defaultParallelism


def tables(spark):
    return {str(p) for p in Path(shared_dir(spark)).glob("table-*") if any(p.glob("*.parquet"))}


def test_a_run_keeps_no_table_that_others_have_replaced(spark, docs, profile, tmp_path):
    """Files to files: rows in shards and in one piece are the same; what remains are outcomes and ids, one table each."""
    source, out, before = str(tmp_path / "raw.jsonl"), tmp_path / "out", tables(spark)
    docs.orderBy("seq").select("text").write.json(source)
    run = corpus.run_corpus(spark, [source], str(out), CorpusConfig(vocab_size=0, shard_size=20), profile)
    columns = [spark.read.parquet(t).columns for t in tables(spark) - before]
    texts = [c for c in columns if {"text", "_s", "sig", "tokens"} & set(c)]
    assert len(texts) == 2 and not any({"tokens", "sig"} & set(c) for c in texts)
    schema = "seq bigint, text string, tokens array<string>, token_ids array<int>, token_length int"
    whole = spark.read.schema(schema).json(str(out / "tokenized_data")).orderBy("seq").collect()
    names = sorted(p.name for p in (out / "shards").glob("shard=*"))
    assert names == [f"shard={i:05d}" for i in range(-(-len(whole) // 20))] and len(names) > 1
    for i, name in enumerate(names):
        assert spark.read.schema(schema).json(str(out / "shards" / name)).orderBy("seq").collect() == whole[20 * i : 20 * i + 20]
    assert all(r.tokens == [c for w in tokens.words_of(spark.createDataFrame([(r.text,)], "text string")).first().words for c in w] for r in whole[:3])
    assert run.tokenized.columns[-3:] == ["tokens", "token_ids", "token_length"] and run.tokenized.count() == run.retained.count() == len(whole)
    lines = [p for p in out.rglob("part-*") if "report" not in str(p)]
    assert lines and all(p.name.endswith(".json.gz") for p in lines)


def test_jobs_keep_one_table_of_texts(spark, docs, tmp_path):
    source = str(tmp_path / "raw.jsonl")
    docs.orderBy("seq").select("text").write.json(source)
    before = tables(spark)
    totals = jobs.dedup_job(spark, [source], str(tmp_path / "unique"), CorpusConfig(num_perm=32)).first()
    columns = [spark.read.parquet(t).columns for t in tables(spark) - before]
    assert [c for c in columns if {"value", "text", "_clean", "_s", "sig"} & set(c)] == [["seq", "value", "outcome"]]
    assert totals.total == docs.count()
    before = tables(spark)
    totals = jobs.tokenize_job(spark, [source], str(tmp_path / "ids"), CorpusConfig(vocab_size=0)).first()
    columns = [spark.read.parquet(t).columns for t in tables(spark) - before]
    assert columns == [["token_ids", "token_length"]]
    rows = spark.read.schema("tokens array<string>, token_ids array<int>, length int").json(str(tmp_path / "ids/tokenized")).collect()
    assert sum(r.length for r in rows) == totals.total_tokens and all(len(r.tokens) == len(r.token_ids) == r.length for r in rows)
