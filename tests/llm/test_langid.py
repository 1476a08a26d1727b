import random
import zlib
from collections import Counter

import numpy as np

from textquarry.llm import langid, queries

SCHEMA = "doc_id long, text string, lang string, language string, score double"


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 5, 6, 20, 60):
        codes = langid.codewords(n)
        distance = [(a != b).sum() for i, a in enumerate(codes) for b in codes[:i]]
        assert min(distance) >= (1 if n == 2 else codes.shape[1] / 4)
        assert all(len(set(bit)) == 2 for bit in codes.T)


def test_grams_stay_inside_their_text():
    raws = [b"abc", b"", b"d", "é ü".encode(), b""]
    buckets, counts = langid.gram_buckets(raws)
    assert counts.tolist() == [3, 0, 1, 5, 0] and len(buckets) == 9
    alone = [langid.gram_buckets([r])[0] for r in raws]
    assert np.concatenate(alone).tolist() == buckets.tolist()


def test_decoding_against_plain_sums(spark):
    rng = random.Random(4)
    letters = {"aa": "abcde", "bb": "defgh", "cc": "ghijé"}
    rows = [(i, "".join(rng.choices(letters[k], k=30)), k, None, None) for i in range(120) for k in letters]
    model = langid.train(spark.createDataFrame(rows, SCHEMA))
    text = "abcab"
    margins = np.zeros(model.codes.shape[1])
    for g in langid.gram_buckets([text.encode()])[0]:
        margins += model.weights[g]
    margins /= len(text) + langid.PRIOR_GRAMS
    assert np.allclose(langid.bit_margins(model, [b"x", text.encode()])[1], margins, atol=1e-5)
    want = [sum(t * np.log1p(np.exp(-langid.STEEPNESS * m * c)) for t, m, c in zip(model.trust[k], margins, model.codes[k])) for k in range(3)]
    assert np.allclose(langid.losses(model, margins[None]), [want])


def bucket_of(gram):
    key = (gram[0] << 16 | gram[1] << 8 | gram[2]) * 0x9E3779B1 % 2**32
    key ^= key >> 15
    return key * 0x85EBCA77 % 2**32 >> 18


def test_counts_weights_and_trust_against_plain_python(spark):
    """All that training learns, counted gram by gram and text by text."""
    rng = random.Random(9)
    letters = {"aa": "abcdé", "bb": "dEfg h", "cc": "ghij1k", "dd": "abgh"}
    rows = [(i, "".join(rng.choices(letters[k], k=rng.randrange(1, 25))), k, None, None) for i in range(60) for k in letters]
    model = langid.train(spark.createDataFrame(rows + [(0, None, "aa", None, None), (1, "xyz", None, None, None), (2, "12", "aa", None, None)], SCHEMA).repartition(3))
    rows = [r for r in rows if any(map(str.isalpha, r[1]))]

    def grams(text):
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
        data = b" " + bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in low) + b" "
        return [bucket_of(data[i : i + 3]) for i in range(len(data) - 2)]

    counts = {k: Counter(g for r in rows if r[2] == k for g in grams(r[1])) for k in letters}
    assert model.languages == sorted(letters)
    shares = {k: lambda g, k=k: (counts[k][g] + langid.SMOOTHING) / (sum(counts[k].values()) + langid.BUCKETS * langid.SMOOTHING) for k in letters}
    for bit, side in enumerate(model.codes.T):
        for g in rng.sample(sorted(set().union(*counts.values())), 40) + [5]:
            mean = lambda sign: np.mean([shares[k](g) for k, c in zip(model.languages, side) if c == sign])
            assert abs(model.weights[g, bit] - np.log(mean(1) / mean(-1))) < 1e-4
    for at, k in enumerate(model.languages):
        own = [grams(r[1]) for r in rows if r[2] == k]
        right = [sum(sum(float(model.weights[g, bit]) for g in text) * c > 0 for text in own) for bit, c in enumerate(model.codes[at])]
        trust = np.array([(n + 1) / (len(own) + 2) for n in right])
        assert np.allclose(model.trust[at], trust / trust.sum())


def test_edge_rows(spark):
    rows = [(i, t, k, "x", 1.0) for i in range(30) for k, t in (("en", "the thing with that"), ("fr", "êtes-vous là où"))]
    rows += [(90, None, "en", "x", 1.0), (91, "", "de", "x", 1.0), (92, "123 !?", "es", "x", 1.0), (93, "no label", None, "x", 1.0), (None, "the thing", "en", "x", 1.0)]
    rows += [(94, "the thing " * 100_000, None, "x", 1.0), (95, "猫", None, "x", 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = langid.identify(df, df)
    assert found.columns == df.columns
    by_text = {r["text"]: r["language"] for r in found.collect()}
    assert {by_text[t]["lang_pred"] for t in (None, "", "123 !?")} == {"und"}
    assert by_text["the thing " * 100_000]["lang_pred"] == by_text["the thing"]["lang_pred"] == "en"
    assert by_text["猫"]["lang_pred"] in ("en", "fr") and by_text["猫"]["ambiguous"]
    assert found.count() == len(rows)
    # Nothing to learn from, one language only, no rows.
    none = langid.identify(df, df.filter("lang = 'xx'")).select("language.*").distinct().collect()
    assert [tuple(r) for r in none] == [("und", 0.0, 0.0, True)]
    one = langid.identify(df, df.filter("lang = 'en'")).filter("doc_id = 0").select("language.*").first()
    assert one["lang_pred"] == "en" and one["score"] == 1.0
    assert langid.identify(df.limit(0), df).count() == 0


def test_held_out_accuracy(spark, sf):
    labels = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect())
    rows = queries.QUERIES["op3_language"](spark, sf).collect()
    assert len(rows) == len(labels)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == labels[r["doc_id"]] for r in out) >= 0.95 * len(out)
