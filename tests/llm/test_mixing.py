import heapq
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textquarry.llm import mixing as M
from textquarry.llm import queries

SCHEMA = "doc_id long, text string, source string, size string, draw long, part string"


def plain_targets(sizes, weights=(3, 1, 2), ratio=1.5, limit=2):
    """By shares that are taken away and dealt out again, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    full, rest = set(), ratio * sum(sizes.values())
    while rest > 1e-9 and len(full) < len(names):
        total = sum(weight[s] for s in names if s not in full)
        share = {s: rest * weight[s] / total for s in names if s not in full}
        rest = 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= limit * sizes[s]:
                rest += target[s] - limit * sizes[s]
                target[s] = float(limit * sizes[s])
                full.add(s)
    return target


def frame(spark, rows):
    return spark.createDataFrame([(d, t, s, "x", 1, "y") for d, t, s in rows], SCHEMA)


def check(rows, got, near):
    """All rows there, right sizes and targets, runs that add up, and taken words near the targets."""
    size = lambda t: len((t or "").encode().split())
    assert sorted(map(str, [(d, size(t), s) for d, t, s in rows])) == sorted(str((r["doc_id"], r["size"], r["source"])) for r in got)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    targets = plain_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] == sum(n * c for n, c in zip(r["words"], r["copies"]))
        assert all(a >= 0 and a + n <= r["size"] for a, n in zip(r["firsts"], r["words"]))
        taken[r["source"]] += r["taken"]
    for s, n in taken.items():
        blocks = M.block_count(sizes[s])
        # Blocks of a source differ by one word.
        assert abs(n - targets[s]) <= near * sizes[s] / max(blocks, 1) + 2 * blocks**0.5


def test_quotas_are_those_of_highest_quotients():
    rng = np.random.default_rng(5)
    for _ in range(50):
        votes = rng.random(7) * 40
        quota = np.floor(votes + 0.5).astype(int)
        heap = [(-v, i, 0) for i, v in enumerate(votes)]
        heapq.heapify(heap)
        got = np.zeros(7, dtype=int)
        for _ in range(quota.sum()):
            _, i, a = heapq.heappop(heap)
            got[i] += 1
            heapq.heappush(heap, (-votes[i] / (2 * a + 3), i, a + 1))
        assert got.tolist() == quota.tolist() and -heap[0][0] < 0.5


def test_shard_quotas_add_up_and_stay_within_two_passes():
    for n_blocks, quota in ((10_000, 1), (10_000, 20_000), (9_001, 13_333), (4096, 4096), (5, 7), (12_289, 6_001)):
        shards = [M.shard_copies(1, 2, s, n_blocks, quota) for s in range(-(-n_blocks // M.SHARD_BLOCKS))]
        copies = np.concatenate(shards)
        assert len(copies) == n_blocks and copies.sum() == quota and copies.max() <= -(-quota // n_blocks)
        for i, s in enumerate(shards):
            assert abs(s.sum() - quota * len(s) / n_blocks) <= 1
        assert all((a == b).all() for a, b in zip(shards, [M.shard_copies(1, 2, s, n_blocks, quota) for s in range(len(shards))]))


def test_edges(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (None, "q " * 500, "x"), (3, "", None), (4, " \t\n", "z"), (5, "é ü b", None)]
    rows += [(6, "w " * 60_000, "é"), (7, "u\x0bv\x0cw", "Z"), (8, "solo", "")]
    got = M.mix(frame(spark, rows)).collect()
    check(rows, got, 1.01)
    empty = M.mix(frame(spark, rows).limit(0))
    assert empty.count() == 0
    nothing = M.mix(frame(spark, [(1, None, "x"), (2, " ", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in nothing] == [(0, 0.0, 0)] * 2


def test_hot_source_many_parts_and_reruns(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(0, 90)), "hot" if i % 3 else f"s{i % 11}") for i in range(3000)]
    monkeypatch.setattr(M, "PART_WORDS", 5000)
    monkeypatch.setattr(M, "SHARD_BLOCKS", 100)
    monkeypatch.setattr(M, "BLOCK_WORDS", 16)
    monkeypatch.setattr(M, "LEAST_BLOCKS", 64)
    docs = frame(spark, rows)
    first = sorted(map(str, M.mix(docs.repartition(7)).collect()))
    got = M.mix(docs).collect()
    assert first == sorted(map(str, got))
    check(rows, got, 4)
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 0)
    assert first == sorted(map(str, M.mix(docs.repartition(3)).collect()))
    assert first != sorted(map(str, M.mix(docs, seed=12).collect()))
    # Each block is taken whole: the runs of a block have the same copies and together its words.
    words, copies = defaultdict(int), defaultdict(set)
    for r in got:
        for b, n, c in zip(r["blocks"], r["words"], r["copies"]):
            words[r["source"], b] += n
            copies[r["source"], b].add(c)
    sizes = {r["source"]: r["source_size"] for r in got}
    for (s, b), n in words.items():
        blocks = M.block_count(sizes[s])
        assert n == sizes[s] // blocks + (b < sizes[s] % blocks) and len(copies[s, b]) == 1


def test_weights_by_name_and_texts_of_runs(spark):
    rows = [(i, f"a{i}  b{i}\nc{i} d{i}", "p" if i % 2 else "q") for i in range(400)]
    docs = frame(spark, rows)
    plan = M.mix(docs, weights={"p": 1.0, "q": 3.0}, ratio=0.5)
    by = {r["source"]: (r["t"], r["g"]) for r in plan.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()}
    assert by == {"p": (200, 200.0), "q": (600, 600.0)}
    texts = docs.select("doc_id", "text").join(plan, "doc_id").withColumn("pieces", M.pieces(F.col("text"), F.col("firsts"), F.col("words")))
    for r in texts.collect():
        assert [len(p.split()) for p in r["pieces"]] == list(r["words"]) and all(p in r["text"] for p in r["pieces"])


def test_query(spark, sf):
    got = queries.QUERIES["op11_mix"](spark, sf)
    assert got.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    rows = [tuple(r) for r in docs.collect()]
    check(rows, M.mix(docs).collect(), 1.01)
    assert got.count() == len(rows)
