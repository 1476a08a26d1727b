import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from textquarry.llm import pitmanyor as P
from textquarry.llm import queries

SCHEMA = "doc_id long, text string, train boolean, held_out boolean, c string, chunk string"


def tokens(text):
    return (text or "").encode().lower().split() + [P.END]


def base(rows):
    """Counts and base scores in plain Python; rows are (doc_id, text, train)."""
    counts = Counter(w for _, text, train in rows if train for w in tokens(text))
    n, v = sum(counts.values()), len(counts)
    for doc_id, text, _ in rows:
        own = tokens(text)
        score = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        yield doc_id, len(own), sum(counts[w] > 0 for w in own), n, round(score, 6)


def as_set(rows):
    return sorted(map(repr, rows))


def got(df):
    return as_set((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in df.collect())


def test_seating_follows_the_restaurant_rule():
    rng = np.random.default_rng(0)
    c = np.array([0, 1, 2, 5, 40, 3000])
    runs = np.stack([P.seat(c, np.full(6, 0.7), 0.6, rng) for _ in range(4000)])
    assert (runs[:, 0] == 0).all() and (runs[:, 1] == 1).all()
    assert (runs >= np.minimum(c, 1)).all() and (runs <= c).all()
    # The second customer opens a table with odds 0.7 to 1 - 0.6.
    assert abs((runs[:, 2] == 2).mean() - 0.7 / 1.1) < 0.03
    # One by one, without groups.
    for k, n in ((3, 5), (4, 40), (5, 3000)):
        plain = []
        for _ in range(400):
            t = 1.0
            for seated in range(1, n):
                t += rng.random() < 0.7 / (0.7 + seated - 0.6 * t)
            plain.append(t)
        assert abs(np.mean(plain) - runs[:, k].mean()) < 0.05 * np.mean(plain) + 0.1


def test_spelling_is_a_distribution():
    words = [b"abab", b"abc", b"", b"ba", "é".encode()] * 20
    context, symbols, starts = P.spelled(words)
    assert starts.tolist()[:4] == [0, 5, 9, 10] and symbols[9] == P._STOP
    keys, counts = np.unique(context * P.SYMBOLS + symbols, return_counts=True)
    rng = np.random.default_rng(1)
    model, held = P.seat_spelling(keys, counts, None, [], rng)
    for _ in range(3):
        model, held = P.seat_spelling(keys, counts, model, held, rng)
    # In seen and unseen contexts all symbols sum to 1, and what was seen is likelier.
    for c in (*np.unique(context), 12345):
        total = model.probability(P.LEVELS - 1, np.full(P.SYMBOLS, c), np.arange(P.SYMBOLS)).sum()
        assert abs(total - 1) < 1e-9
    known, other = P.log_spelling(model, [b"abab", b"zzzz"])
    assert known > other + 5


def test_counts_against_plain_python(spark, monkeypatch):
    rows = [(1, "A b\ta é É", True), (2, "b c d c", False), (3, None, True), (4, "", False), (None, "new words", True), (5, "A b", True), (5, "A b", True)]
    rows += [(6, "w" * 5000 + " " + "q " * 50_000, False)]
    df = spark.createDataFrame([(d, t, k, not k, "x", "y") for d, t, k in rows], SCHEMA).repartition(3)
    scored = P.scores(df, df["train"], df["held_out"]).cache()
    assert got(scored) == as_set(base(rows))
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in scored.collect())
    monkeypatch.setattr(P, "CHUNK_BYTES", 20)
    assert got(P.scores(df, df["train"], df["held_out"])) == as_set(base(rows))


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(1, "a b", False, True, "x", "y")], SCHEMA)
    assert P.scores(df.limit(0), df["train"], df["held_out"]).count() == 0
    row = P.scores(df, df["train"], df["held_out"]).first()
    assert (row["n_known"], row["train_tokens"]) == (0, 0) and math.isfinite(row["score"])


def test_words_sum_to_one_and_beat_the_base_score(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [(d, t, zlib.crc32(str(d).encode()) % 10 != 0) for d, t in docs.collect()]
    scored = queries.QUERIES["op5_score"](spark, sf).cache()
    assert got(scored) == as_set(base(rows))
    out = scored.filter("held_out").groupBy().sum("base_score", "score").first()
    assert out[1] > out[0]
    words = spark.createDataFrame([(b"a", 5), (b"b", 1), (b"", 3), (b"ab", 2)], "word binary, c long")
    learned, n, v, others = P.learn(words, 1, 4, 3)
    known = {bytes(r["word"]): math.exp(r["log_p"]) for r in learned.collect()}
    assert (n, v) == (11, 4) and abs(sum(known.values()) + math.exp(others) - 1) < 1e-9
    assert known[b"a"] > known[b"ab"] > known[b"b"] > 0


def test_word_order_counts(spark):
    rows = [(i, "the cat sat on the mat and the dog sat on the rug", True) for i in range(40)]
    rows += [(100, "the dog sat on the mat", False), (101, "mat the on sat dog the", False), (102, "dog", False), (103, "cat", False)]
    df = spark.createDataFrame([(d, t, k, not k, "x", "y") for d, t, k in rows], SCHEMA).repartition(3)
    got = {r["doc_id"]: r for r in P.scores(df, df["train"], df["held_out"]).collect()}
    assert got[100]["base_score"] - got[101]["base_score"] < 1e-9 and got[100]["score"] > got[101]["score"] + 3


def test_scores_follow_the_seating_of_pairs(spark):
    """Seatings as collected: tables and customers of each context add up, and scores are those of plain Python."""
    rows = [(i, text, True) for i, text in enumerate(["a b a b c", "b a d", "a b", "", "c a b d", "B É a"] * 5)]
    rows += [(100, "a b d new b", False), (101, "c d a", False), (102, "new", False)]
    df = spark.createDataFrame([(d, t, k, not k, "x", "y") for d, t, k in rows], SCHEMA).repartition(3)
    docs = df.select(F.col("doc_id"), "train", "held_out", "text")
    bags = P.bags_of_pairs(docs, 5)
    words = bags.filter("n > 0").groupBy("word").agg(F.sum("n").alias("c"))
    pairs = P.Pairs(bags, 7)
    learned, others = P._sampled(words, 1, 2, 7, pairs)
    known = {bytes(r["word"]): r for r in learned.collect()}
    named = {(r["bucket"], r["place"]): bytes(r["word"]) for r in pairs.words.collect()}
    seated = {}
    for r in pairs.state.collect():
        first, second, c, t, samples = P._unpack(r["packed"])
        for i, (a, b) in enumerate(zip(first, second)):
            seated[named[r["bucket"], a], named[r["bucket"], b]] = (int(c[i]), [int(x[i]) for x in (*samples, t)])
    plain = Counter()
    for _, text, train in rows:
        own = tokens(text)
        plain.update(zip([P.END, *own], own) if train else [])
    assert {k: v[0] for k, v in seated.items()} == plain

    def probability(u, w, k):
        own, tables = seated.get((u, w), (0, [0, 0]))
        size, held = (known[u]["c"], known[u][f"held{k}"]) if u in known else (0, 0)
        parent = known[w][f"p{k}"] if w in known else others[k]
        return (own - pairs.d * tables[k] + (P.STRENGTH + pairs.d * held) * parent) / (P.STRENGTH + size)

    for k in range(2):
        assert abs(sum(r[f"p{k}"] for r in known.values()) + others[k] - 1) < 1e-9
        for u in (*known, b"new"):
            assert abs(sum(probability(u, w, k) for w in (*known, b"new")) - 1) < 1e-9
    n, v = sum(r["c"] for r in known.values()), len(known)
    got = {r["doc_id"]: r["score"] for r in P._scored(bags, pairs, learned, others, n, v).collect()}
    for doc_id, text, _ in rows:
        own = tokens(text)
        want = sum(math.log10((probability(u, w, 0) + probability(u, w, 1)) / 2) for u, w in zip([P.END, *own], own))
        assert abs(got[str(doc_id)] - want) < 1e-9


def test_whole_characters_in_spelling_contexts():
    """Letters with equal low bits are different contexts, also two and three characters before."""
    for one, other in ((b"abc", b"qbc"), (b"xab", b"xqb")):
        a, q = P.spelled([one])[0], P.spelled([other])[0]
        assert (a[3] != q[3]) and a.max() < P._BEFORE**3


def test_sweeps_seat_only_pairs_that_occur_again(spark):
    """A sweep writes the tables of pairs with more than one customer, and tables that others replaced can go by kind."""
    texts = ["a b a b c", "b a d", "a b", "", "c a b d", "x y z"]
    df = spark.createDataFrame([(i, t, True, False, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    bags = P.bags_of_pairs(df.select("doc_id", "train", "held_out", "text"), 3)
    words = bags.filter("n > 0").groupBy("word").agg(F.sum("n").alias("c")).cache()
    known = words.count()
    pairs = P.Pairs(bags, 7)
    P.discard(bags, f"kind={P.PAIR_BAG}")
    learned, others = P._sampled(words, 1, 2, 7, pairs)
    plain = Counter(pair for t in texts for pair in zip([P.END, *tokens(t)], tokens(t)))
    seated = [P._unpack(r["packed"]) for r in pairs.swept.filter("to IS NULL").collect()]
    assert sum(len(t) for _, t in seated) == sum(n > 1 for n in plain.values())
    assert P._scored(bags, pairs, learned, others, sum(plain.values()), known).count() == len(texts)
