import numpy as np

from textquarry.llm import cotraining as C
from textquarry.llm import queries

DOCS = "doc_id long, text string, source string, lang string, quality string"
LABELS = "doc_id long, quality int, toxic int"


def rows(n=240):
    rng = np.random.default_rng(2)
    vocabulary = [f"word{i}" for i in range(60)]
    for i in range(n):
        good, toxic = i % 2, int(i % 5 == 0)
        words = list(rng.choice(vocabulary, size=30)) + (["nice"] if good else ["junk"]) + ["scum"] * toxic
        rng.shuffle(words)
        mark = "" if good else "***"
        yield (i, " ".join(w + mark for w in words) + ".", f"src{i % 3}", "en", "x"), (i, good, toxic)


def test_calibration_finds_a_known_curve():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20_000, 1))
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    assert np.allclose(C.calibrate(x, y), [2, -1], atol=0.15)


def test_views_teach_each_other():
    # The second view has labels for few, and learns from what the first is sure of.
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 3000)
    words = [np.array([10 + v, 20 + rng.integers(0, 5)]) for v in y]
    pages = [np.array([v if rng.random() < 0.85 else 1 - v, 5 + rng.integers(0, 5)]) for v in y]
    given = np.where(np.arange(3000) < 100, y, -1)
    model = C.co_train(words, pages, given, np.zeros((0, 0)), 3, 64, 64)
    p = model.probability(words, pages)
    assert ((p > 0.5) == (y == 1)).mean() > 0.98 and (p >= 0).all() and (p <= 1).all()


def test_scores_and_edge_rows(spark):
    docs, labels = zip(*rows())
    extra = [(1000, None, None, None, "x"), (1001, "", "src1", "en", "x"), (1001, "", "src1", "en", "x"), (None, "scum", "src1", "en", "x"), (1002, "nice word1 " * 60_000, None, "xx", "x")]
    extra += [(2000 + d[0], d[1], d[2], d[3], d[4]) for d in docs]
    df = spark.createDataFrame([*docs, *extra], DOCS).repartition(3)
    given = spark.createDataFrame([*labels, (5000, 1, 0), (None, 1, 1), (1001, None, None), labels[0]], LABELS)
    scored = C.score(df, given)
    got = scored.collect()
    assert scored.columns == ["doc_id", "quality", "toxic", "keep"] and len(got) == len(docs) + len(extra)
    assert all(0 <= r["quality"] <= 1 and 0 <= r["toxic"] <= 1 for r in got)
    by_id = {r["doc_id"]: r for r in got}
    unseen = [(by_id[2000 + i], q, t) for i, q, t in labels]
    assert np.mean([(r["quality"] > 0.5) == q for r, q, t in unseen]) > 0.95
    assert np.mean([(r["toxic"] > 0.5) == t for r, q, t in unseen]) > 0.95
    assert C.score(df.limit(0), given).count() == 0
    none = C.score(df, given.limit(0)).select("quality", "toxic", "keep").distinct().collect()
    assert [tuple(r) for r in none] == [(0.5, 0.5, True)]
    # Other columns may be missing, and one class alone is everyone's.
    good = C.score(df.select("doc_id", "text"), given.filter("quality = 1")).agg({"quality": "min"}).first()
    assert good[0] == 1.0


def test_held_out_accuracy(spark, tmp_path):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    spark.read.parquet(f"{folder}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    labels.filter("doc_id % 4 <> 0").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r for r in queries.QUERIES["op10_quality"](spark, str(tmp_path)).collect()}
    out = labels.filter("doc_id % 4 = 0").collect()
    assert np.mean([(got[r["doc_id"]]["quality"] > 0.5) == r["quality"] for r in out]) > 0.9
    assert np.mean([(got[r["doc_id"]]["toxic"] > 0.5) == r["toxic"] for r in out]) > 0.87


def test_every_unlabelled_document_can_be_passed_on(spark):
    """The surest of far more documents than are passed on are found, wherever they are, and none with a label or taken."""
    n = 20_000
    text = {4_999: "sure good", 13_777: "sure bad", 19_998: "sure good", 19_999: "sure bad"}
    rows = [(i, text.get(i, "plain text"), None, None) for i in range(n)] + [(4_999, "sure good", None, None)]
    table = C.features(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(7))
    labelled = spark.createDataFrame([(13_777,), (3,)], "doc_id long")
    views = [C.View(weights=np.zeros(1 << C.WORD_BITS)), C.View(edges=np.zeros((C.NUMBERS, C.BINS - 1)), weights=np.zeros(256 + C.NUMBERS * C.BINS))]
    good, bad, sure = (C.word_features([w])[0] for w in ("good", "bad", "sure"))
    views[0].weights[good], views[0].weights[bad] = 8, -8
    pool = C.Unlabelled(table, labelled)
    scales = [np.array([1.0, 0.0])] * 2
    got = sorted(pool.choose(views, scales, [5, 5], []), key=lambda r: r[1])
    assert [r[:3] for r in got] == [(0, 4_999, 1), (0, 19_998, 1), (0, 19_999, 0)]
    assert all(sorted(r[3]) == sorted({*sure, *(good if r[2] else bad)}) and len(r[4]) == 2 + C.NUMBERS for r in got)
    assert [r[1] for r in pool.choose(views, scales, [5, 1], [4_999, 19_999])] == [19_998]
