import random

import pytest

from textquarry.llm import graph, jaccard, queries

SCHEMA = "doc_id long, text string, node string, n string, label string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in lowered.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, percent=80):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (d, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if d is not None and sets[j][0] is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(s), None if d is None else least[root(i)]) for i, (d, s) in enumerate(sets)]


def as_set(rows):
    return sorted(map(repr, rows))


def check(spark, rows):
    df = spark.createDataFrame([(d, t, "x", "y", "z") for d, t in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in jaccard.classes(df).collect()]
    assert as_set(got) == as_set(brute(rows))
    return df


def family(rng, base, n, edits):
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            k = rng.randrange(len(w))
            w[k : k + rng.randrange(2)] = [f"e{rng.randrange(10**6)}"] * rng.randrange(1, 3)
        yield " ".join(w)


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(50)]
    texts = []
    for n, length, edits in ((40, 60, 6), (30, 120, 14), (8, 30, 3), (5, 8, 2)):
        texts += family(rng, [word() for _ in range(length)], n, edits)
    # A passage in many documents that are otherwise unlike, and some that are little else.
    texts += [" ".join([word() for _ in range(rng.randrange(30, 90))] + passage) for _ in range(60)]
    texts += [" ".join(passage + [word() for _ in range(rng.randrange(12))]) for _ in range(25)]
    # A chain in which only neighbours are alike.
    chain = [word() for _ in range(200)]
    texts += [" ".join(chain[4 * k : 4 * k + 80]) for k in range(25)]
    texts += ["a b c", "A  b\\tc".replace("\\t", "\t"), "a b", "", " \n", "one", "a b c d e", "a b c d e a b c d e"] + texts[:3]
    ids = rng.sample(range(10_000), len(texts))
    rows = list(zip(ids, texts))
    rows += [rows[0], (rows[1][0], "another text under a known id here"), (None, rows[2][1]), (20_000, None), (20_001, "long " * 30_000 + "end")]
    monkeypatch.setattr(jaccard, "COMMON", 10)
    monkeypatch.setattr(jaccard, "LOCAL_COMMON", 2)
    df = check(spark, rows)
    # Small blocks take more rounds and give the same.
    monkeypatch.setattr(jaccard, "BLOCK_GROWTH", 2)
    check(spark, rows)
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    first = {c for d, n, c in brute(rows) if d is not None}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(first)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert jaccard.classes(empty).count() == 0 and jaccard.one_of_each(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 300])
def test_components_of_a_path(spark, n):
    ids = random.Random(1).sample(range(1000), n + 1)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    got = graph.components(edges).collect()
    assert sorted(tuple(r) for r in got) == sorted((i, min(ids)) for i in ids)


def test_prefix_bounds():
    for n in range(1, 300):
        for percent in (50, 80, 95, 100):
            p = jaccard.prefix_size(n, percent)
            # Rows without a shared column in the prefix share at most n - p columns.
            assert 1 <= p <= n and 100 * (n - p) < percent * n <= 100 * (n - p + 1)


def test_sketches_bound_the_difference(spark):
    rng = random.Random(6)
    import numpy as np
    from pyspark.sql import functions as F

    rows = []
    for _ in range(300):
        base = rng.sample(range(1 << 60), rng.randrange(1, 400))
        other = base[: rng.randrange(len(base) + 1)] + rng.sample(range(1 << 60), rng.randrange(0, 60))
        if other and 0.5 <= len(other) / len(base) <= 2:
            a, b = (np.unique(np.array(x, dtype=np.uint64)) for x in (base, other))
            rows.append((jaccard.sketch_of(a).tolist(), jaccard.sketch_of(b).tolist(), len(a), len(b), len(set(base) & set(other))))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, n long, m long, k long")
    may = jaccard.may_link(F.col("a"), F.col("b"), F.col("n"), F.col("m"), 80)
    got = df.select("*", jaccard.unlike(F.col("a"), F.col("b")).alias("unlike"), may.alias("may")).collect()
    assert len({(len(r["a"]), len(r["b"])) for r in got}) > 5
    for r in got:
        assert r["unlike"] <= r["n"] + r["m"] - 2 * r["k"]
        assert r["may"] or 180 * r["k"] < 80 * (r["n"] + r["m"])
    far = [r for r in got if r["n"] > 50 and r["k"] < 0.5 * min(r["n"], r["m"])]
    assert far and sum(r["may"] for r in far) < 0.1 * len(far)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.QUERIES["op2_jaccard"](spark, sf).collect()]
    assert as_set(got) == as_set(brute(rows))


def test_blocks_of_a_column_are_nested(spark):
    """A row of the block of a column is in that of any smaller column, so a pair is counted in all it shares."""
    from pyspark.sql import functions as F

    nodes = spark.range(3000).withColumn("node", F.xxhash64("id"))
    for block in (8, 64, 512):
        own = [{r.node for r in nodes.filter(jaccard.in_block(F.col("node"), F.lit(c), block)).collect()} for c in (3000, 2999, 701, 512)]
        assert own[0] <= own[1] <= own[2] <= own[3] and len(own[3]) > len(own[0])
        assert block / 2 < len(own[0]) < 2 * block and (block < 512 or len(own[3]) == 3000)


def test_repeated_values():
    import numpy as np

    values = np.array([5, 1, 5, 2, 5, 5, 2, 9, 2, 2, 2, 1], dtype=np.uint64)
    found, counts = jaccard.repeated(values.copy(), 4)
    assert (found.tolist(), counts.tolist()) == ([2, 5], [5, 4])
    for few in (values[:0], values[:3]):
        assert [len(x) for x in jaccard.repeated(few.copy(), 4)] == [0, 0]
