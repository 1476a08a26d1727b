import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from textquarry.llm import packing
from textquarry.llm.bpe import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, length string"


def pieces_of(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            yield doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())


def test_both_ways_give_the_ids_of_the_tokenizer():
    rng = random.Random(3)
    alphabet = ["a", "B", "é", "猫", "7", " ", "  ", "\n", "\t", " ", "　", "'s", "'", "<|endoftext|>", "!", "\U0001f600", "\x1c", "\u0085"]
    tokenizer, encoder = Tokenizer.from_file(PATH), PieceEncoder(PATH)
    for _ in range(1500):
        text = "".join(rng.choices(alphabet, k=rng.randrange(25)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), dtype=np.uint32).tolist() == want, repr(text)
    for text in ("x" * 50_000, " " * 50_000 + "a", "ab " * 20_000 + "y" * 3000 + " é 猫" * 9):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), dtype=np.uint32).tolist() == want


def test_plan_uses_every_piece_once_and_two_for_one():
    rng = random.Random(1)
    for _ in range(30):
        counts = Counter(rng.randrange(1, 101) for _ in range(rng.randrange(1, 400)))
        plan = packing.plan_bins(counts, 100)
        used = Counter()
        for lengths, times in plan:
            assert sum(lengths) <= 100
            for n in lengths:
                used[n] += times
        assert used == counts
    # 60 + 30 leaves 10; 30 gives way to 20 + 19.
    assert packing.plan_bins({60: 1, 30: 1, 20: 1, 19: 1}, 100)[0] == ([60, 20, 19], 1)


def check(rows, packed, capacity):
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)
    want = sorted((d is not None, d or 0, *rest) for d, *rest in pieces_of(rows, capacity))
    assert got == want
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pack_edge_cases(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (None, "x"), (3, ""), (4, "word " * 900), (5, " lead  two\n\nthree ")]
    rows += [(i, "same text here") for i in range(10, 60)]
    df = spark.createDataFrame([(d, t, "extra") for d, t in rows], SCHEMA)
    check(rows, packing.pack(df, PATH, capacity=64).collect(), 64)
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_pack_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    packed = packing.pack(docs, PATH, with_ids=True).collect()
    n = check([(r[0], r[1]) for r in docs.collect()], packed, 1024)
    total = sum(r["length"] for r in packed)
    assert n <= 1.02 * -(-total // 1024) + 1
    assert all(len(r["ids"]) == r["length"] for r in packed)


def test_large_ids_beside_a_null_one(spark):
    ids = [2**53 + 1, None, 2**62 + 3, -(2**53) - 1]
    df = spark.createDataFrame([(i, "some text") for i in ids], "doc_id long, text string").coalesce(1)
    found = packing.token_pieces(df, PATH, 2, 1024).collect()
    assert {r["doc_id"] for r in found} == set(ids)
