import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from textquarry.config import CorpusConfig
from textquarry.functions import minhash as M
from textquarry.functions import text as T
from textquarry.operators import dedup

CFG = CorpusConfig(num_perm=32)


def sequential(rows, num_perm, threshold):
    """Keep-first one record at a time: (seq, signature) to the set of duplicates."""
    width = num_perm // M.LSH_BANDS
    kept, gone = [], set()
    for seq, sig in sorted(rows):
        bands = [tuple(sig[b * width : (b + 1) * width]) for b in range(M.LSH_BANDS)]
        hit = any(
            any(x == y for x, y in zip(bands, other)) and sum(p == q for p, q in zip(sig, osig)) / num_perm >= threshold
            for osig, other in kept
        )
        gone.add(seq) if hit else kept.append((sig, bands))
    return gone


def crowd(seed, n, num_perm=32):
    """Families of drifting copies, a third of all rows in one of them."""
    rng = random.Random(seed)
    heads = [[rng.randrange(3) for _ in range(num_perm)] for _ in range(6)]
    rows = []
    for seq in rng.sample(range(10 * n), n):
        head = heads[0] if rng.random() < 0.35 else rng.choice(heads)
        rows.append((seq, [x if rng.random() > 0.12 else rng.randrange(5) for x in head]))
    return rows


def nodes(spark, rows, num_perm=32):
    df = spark.createDataFrame(rows, "seq bigint, sig array<bigint>")
    keyed = df.withColumn("keys", M.band_keys(F.col("sig"), num_perm))
    return keyed.withColumn("print", M.fingerprint(F.col("sig"), num_perm))


@pytest.mark.parametrize("seed,small,hot", [(1, 32, 500_000), (2, 2, 500_000), (3, 4, 20), (4, 1, 7)])
def test_rounds_equal_sequential_greedy(spark, monkeypatch, seed, small, hot):
    monkeypatch.setattr(dedup, "SMALL_BUCKET", small)
    monkeypatch.setattr(dedup, "HOT_ROWS", hot)
    rows = crowd(seed, 160)
    for threshold in (0.8, 0.7):
        got = {r.seq for r in dedup.greedy_duplicates(nodes(spark, rows), 32, threshold).collect()}
        assert got == sequential(rows, 32, threshold)


@pytest.mark.parametrize("num_perm", [8, 64, 100, 128])
def test_fingerprints_bound_the_matches(spark, num_perm):
    rows = crowd(9, 30, num_perm)
    df = nodes(spark, rows, num_perm)
    left, right = df.alias("l"), df.alias("r")
    pairs = left.join(right, F.col("l.seq") < F.col("r.seq"))
    got = pairs.select(
        M.matching(F.col("l.sig"), F.col("r.sig")).alias("m"),
        M.at_most_matching(F.col("l.print"), F.col("r.print"), num_perm).alias("most"),
        F.col("l.sig").alias("a"),
        F.col("r.sig").alias("b"),
    ).collect()
    for r in got:
        assert r.m == sum(x == y for x, y in zip(r.a, r.b))
        assert r.most == sum(x % 4 == y % 4 for x, y in zip(r.a, r.b))


def revisions(n, num_perm=32):
    """Each record shares 26 of 32 positions with the one before, and less with all others."""
    sig, rows = [0] * num_perm, []
    for seq in range(n):
        for k in range(6):
            sig[(6 * seq + k) % num_perm] = 1000 * seq + k
        rows.append((seq, list(sig)))
    return rows


@pytest.mark.parametrize("local", [200_000, 100])
def test_long_chains_settle_in_few_turns(spark, monkeypatch, local):
    n = 1000 if local > 100 else 300
    rows = revisions(n)
    turns = []
    cut = dedup.cut_lineage
    monkeypatch.setattr(dedup, "LOCAL_EDGES", local)
    monkeypatch.setattr(dedup, "cut_lineage", lambda df: turns.append("kept" in df.columns) or cut(df))
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "a long, b long")
    dropped, left = dedup._settle(edges, None)
    got = {r.seq for df in dropped for r in df.collect()}
    assert got == set(range(1, n, 2)) and left.isEmpty()
    assert sum(turns) <= 20
    if local > 100:
        found = {r.seq for r in dedup.greedy_duplicates(nodes(spark, rows[:200]), 32, 0.8).collect()}
        assert found == sequential(rows[:200], 32, 0.8) == set(range(1, 200, 2))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_settle_like_the_sequence(spark, monkeypatch, seed):
    """Random graphs, some records waiting, shares of a few pairs: what is decided is what the sequence decides."""
    rng = random.Random(seed)
    monkeypatch.setattr(dedup, "LOCAL_EDGES", 25)
    monkeypatch.setattr(dedup, "TASK_PAIRS", 5)
    monkeypatch.setattr(dedup, "PARALLEL_TURNS", 1)
    pairs = {tuple(sorted(rng.sample(range(300), 2))) for _ in range(400)}
    edges = spark.createDataFrame(list(pairs), "a long, b long")
    kept = set()
    for seq in range(300):
        if not any((a, seq) in pairs for a in kept):
            kept.add(seq)
    dropped, left = dedup._settle(edges, None)
    assert {r.seq for df in dropped for r in df.collect()} == set(range(300)) - kept and left.isEmpty()
    waiting = set(rng.sample(range(300), 30))
    state = {}
    for seq in range(300):
        found = {state[a] for a in range(seq) if (a, seq) in pairs}
        state[seq] = "gone" if "kept" in found else "open" if "open" in found or seq in waiting else "kept"
    held = spark.createDataFrame([(s,) for s in waiting], "seq long")
    dropped, left = dedup._settle(edges, held)
    assert {r.seq for df in dropped for r in df.collect()} == {s for s, x in state.items() if x == "gone"}
    assert {(r.a, r.b) for r in left.collect()} == {(a, b) for a, b in pairs if state[a] == state[b] == "open"}


def test_similarity_is_not_transitive(spark):
    base = list(range(100, 132))
    a, b, c = list(base), list(base), list(base)
    b[16:22] = range(6)  # a and b agree in 26 of 32
    c[16:22] = range(6)
    c[22:28] = range(10, 16)  # b and c agree in 26, a and c in 20
    got = {r.seq for r in dedup.greedy_duplicates(nodes(spark, [(1, a), (2, b), (3, c)]), 32, 0.8).collect()}
    assert got == {2}


def test_fewer_permutations_than_bands(spark):
    """With empty bands every record meets every other."""
    rows = [(i, [x % 5 for x in range(i, i + 8)]) for i in range(12)]
    got = {r.seq for r in dedup.greedy_duplicates(nodes(spark, rows, 8), 8, 0.8).collect()}
    assert got == sequential(rows, 8, 0.8)


def shingle_set(text, n):
    t = re.sub(r"\s+", " ", text.lower())
    return {t[i : i + n] for i in range(len(t) - n + 1)}


TEXTS = ["The quick brown fox", "the QUICK  brown\nfox!", "abc", "😀😀😀é日本語" * 3, "".join(map(chr, range(0x4E00, 0x4E00 + 900))), "aaaaaaa"]


def test_sha1_signature_equals_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    for n in (5, 7):
        got = {r.i: r.s for r in df.select("i", M.signature(T.shingle_text(F.col("t")), n, 20, "sha1").alias("s")).collect()}
        full = {r.i: r.s for r in df.select("i", M.signature_sha1_builtin(T.shingles(F.col("t"), n), 20).alias("s")).collect()}
        for i, t in enumerate(TEXTS):
            grams = shingle_set(t, n)
            if not grams:
                assert got[i] is None and full[i] == ["0" * 40] * 20
                continue
            want = [min(hashlib.sha1(f"{g}_{k}".encode()).hexdigest() for g in grams) for k in range(20)]
            assert full[i] == want
            assert [v.hex() for v in got[i]] == want


def test_least_digests_compare_all_words():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(200):
        # Few values, so that leading words tie.
        rows = [bytes([0] * 7 + [rng.integers(2)] + [0] * 7 + [rng.integers(2)] + [0] * 3 + [rng.integers(3)]) for _ in range(12)]
        least = M._least_digests(np.frombuffer(b"".join(rows), dtype=M.DIGEST), np.array([0, 1, 5]))
        assert [x.tobytes() for x in least] == [min(rows[:1]), min(rows[1:5]), min(rows[5:])]


def test_affine_signature_equals_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = {r.i: r.s for r in df.select("i", M.signature(T.shingle_text(F.col("t")), 5, 24).alias("s")).collect()}
    a, b = M.affine_coefficients(24)

    def base(gram):
        h = 0
        for ch in gram:
            h = (h * M.RADIX + ord(ch)) % M.PRIME
        h = ((h ^ (h >> 15)) * M.MIXER) % M.PRIME
        return h ^ (h >> 13)

    for i, t in enumerate(TEXTS):
        grams = shingle_set(t, 5)
        want = [min((base(g) * x + y) % M.PRIME for g in grams) for x, y in zip(a, b)] if grams else None
        assert got[i] == want


def test_whole_method_equals_sequential(spark):
    rng = random.Random(5)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed", "tempor"]
    originals = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(12)]
    texts = []
    for _ in range(60):
        ws = rng.choice(originals).split()
        if rng.random() < 0.6:
            ws[rng.randrange(len(ws))] = rng.choice(words)
        texts.append(" ".join(ws))
    texts += ["tiny", "tiny"]
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, text string")
    for family in ("sha1", "affine"):
        cfg = CorpusConfig(num_perm=64, hash_family=family)
        marked = {r.seq: r.is_duplicate for r in dedup.mark_duplicates(df, cfg).collect()}
        sigs = [(r.seq, r.sig) for r in dedup.signatures(df, cfg).collect()]
        want = sequential(sigs, 64, 0.8)
        assert {s for s, d in marked.items() if d} == want
        assert marked[60] is False and marked[61] is False  # no shingle, never a duplicate
        assert {r.seq for r in dedup.filter_duplicates(df, cfg).collect()} == set(marked) - want


def test_exact_keeps_the_first(spark):
    df = spark.createDataFrame([(5, "b"), (3, "b"), (1, "a"), (9, "b"), (4, None)], "seq bigint, text string")
    got = {r.seq: r.is_duplicate for r in dedup.mark_exact(df).collect()}
    assert got == {1: False, 3: False, 5: True, 9: True, 4: None}
    totals = dedup.dedup_totals(dedup.mark_exact(df)).first()
    assert tuple(totals) == (4, 2, 2)


def test_plans_have_no_cartesian_product(spark):
    df = spark.createDataFrame([(i, f"text number {i}") for i in range(20)], "seq bigint, text string")
    marked = dedup.mark_duplicates(df, CFG)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_sha1_signatures_by_small_digests(monkeypatch):
    """Whole signatures of short and long texts, with a memo that overflows, hashing most shingles once."""
    rng = random.Random(5)
    texts = ["abcde", "aaaaaaa", "é😀漢字x y", *("".join(rng.choices("abcdef ", k=k)) for k in (30, 200, 3000))] * 2
    want = [[min(hashlib.sha1(f"{t[j:j + 5]}_{i}".encode()).digest() for j in range(len(t) - 4)) for i in range(40)] for t in texts]
    assert M._signatures(texts, 5, 40, "sha1", {}) == want
    memo = {}
    for text in texts:
        M._signatures([text], 5, 40, "sha1", memo)
    # Of 40 digests of a shingle one or two are small; all of them would take 800 bytes.
    assert sum(map(len, memo.values())) / len(memo) < 80
    monkeypatch.setattr(M, "MEMO_SHINGLES", 100)
    memo = {}
    assert [M._signatures([text], 5, 40, "sha1", memo)[0] for text in texts] == want


def test_first_words_are_those_of_sha1():
    """Of blocks filled to the last byte that fits, with numbers of one to three digits."""
    rng = random.Random(3)
    for length in (2, 6, 9, 52):
        stems = [rng.randbytes(length) for _ in range(20)]
        want = [[int(hashlib.sha1(s + str(i).encode()).hexdigest()[:8], 16) for s in stems] for i in range(120)]
        assert M._first_words(stems, 120).tolist() == want


def test_few_digests_are_computed_one_by_one(monkeypatch):
    """Most are told to be large in arrays, and what one task has hashed the next one looks up."""
    calls = []
    real = hashlib.sha1
    monkeypatch.setattr(M.hashlib, "sha1", lambda data: (calls.append(data), real(data))[1])
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefgh ", k=5000)) for _ in range(3)]
    memo = M._memo(5, 120)
    memo.clear()
    first = M._signatures(texts, 5, 120, "sha1", memo)
    shingles = {t[i : i + 5] for t in texts for i in range(len(t) - 4)}
    assert set(memo) == {s.encode("utf-32-le") for s in shingles} and len(calls) < 120 * len(shingles) / 20
    calls.clear()
    assert M._signatures(texts[::-1], 5, 120, "sha1", M._memo(5, 120)) == first[::-1] and not calls


def test_members_of_shared_buckets_alone_get_keys(spark):
    """Rows of buckets are exchanged without keys and fingerprints, and only those with company go on."""
    sigs = nodes(spark, [(i, [100 * i + j for j in range(32)]) for i in range(30)] + [(40, list(range(32))), (41, [0, 1, 2, 3, *range(9000, 9028)])])
    rows = sigs.select("seq", "keys", "print")
    buckets = dedup._Buckets(rows)
    members, leaders = dedup._members_and_leaders(rows, buckets, 1, 1)
    assert "Exchange" not in members._jdf.queryExecution().executedPlan().toString()
    assert {r.seq for r in members.collect()} == {0, 40, 41} and {r.a for r in leaders.collect()} == {0}
    bands = {r.seq: r.keys for r in rows.collect()}
    assert all(r["keys"] == bands[r.seq] and r["key"] == r["keys"][r.band] for r in members.collect())
    found = {r.seq for r in dedup.greedy_duplicates(sigs, 32, 0.8).collect()}
    assert found == {40}
