import test_decontaminate
import test_jaccard
import test_packing

import corpus_pipeline
from textquarry.llm import langid, secrets

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_against_plain_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    # Language: the model is the operator's, what the stage makes of it is checked.
    training = docs.filter(langid.remainder(docs["doc_id"], 3) != 1)
    found = langid.identify(docs, training).select("doc_id", "text", "language.*").collect()
    rows = [(r["doc_id"], r["text"]) for r in found if r["lang_pred"] != "und" and not r["ambiguous"]]
    rows = [(d, t) for (d, t), (_, _, c) in zip(rows, test_jaccard.brute(rows)) if d == c]
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r, (_, _, hit, _) in zip(rows, test_decontaminate.brute(rows, bench)) if not hit]
    rows = [(d, secrets.redact_text(t)) for d, t in rows]
    packed = corpus_pipeline.run(spark, sf).collect()
    n = test_packing.check(rows, packed, 1024)
    assert n <= 1.05 * -(-sum(r["length"] for r in packed) // 1024) + 1
    assert len(rows) < docs.count()


def test_stages_keep_columns_and_take_odd_rows(spark, sf):
    rows = [(1, "the thing with that and the other thing of it", "en", "s", 5), (1, "the thing with that and the other thing of it", "en", "s", 5)]
    rows += [(2, None, "en", None, None), (3, "", None, "s", 0), (4, "123 !?", "en", "s", 6), (None, "the words have no id but stay", "en", "s", 1)]
    rows += [(5, "êtes-vous là où nous étions", "fr", "s", 1), (6, "a token=0123456789abcdefXYZ in it, the thing", "en", "s", 1), (7, "the thing " * 40_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        empty = stage(spark, docs.limit(0), sf)
        assert empty.columns == docs.columns and empty.count() == 0, name
        docs = spark.createDataFrame(out.collect(), COLUMNS)
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(kept) == {None, 1, 5, 6, 7} and docs.count() == 5
    assert "0123456789" not in kept[6]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).select("doc_id").distinct().count() == 5


def test_order_and_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "secret_scan", "best_fit_packing"]


def test_stages_run_in_small_batches(spark, sf):
    """Also where a stage is called by itself and its result read later."""
    before = {key: spark.conf.get(key) for key in corpus_pipeline.BATCHES}
    try:
        for key in before:
            spark.conf.unset(key)
        dict(corpus_pipeline.STAGES)["secret_scan"](spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
        assert {key: spark.conf.get(key) for key in before} == corpus_pipeline.BATCHES
        assert all(stage.__wrapped__.__name__ == name for name, stage in corpus_pipeline.STAGES)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
