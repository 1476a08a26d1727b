import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from textquarry.llm import blooms
from textquarry.llm import collocations as C
from textquarry.llm import queries

SCHEMA = "text string, lang string, n long, phrase string"


def plain(rows, least=30, top=2000):
    """All phrases of all pieces, counted and cut one by one."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    hidden = set()
    for (lang, p), a in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * a >= 80 * f[lang, p[i : i + k]]:
                    hidden.add((lang, p[i : i + k]))
    out = defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) not in hidden:
            score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    for lang, rows in out.items():
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            yield lang, rank, p.decode(), -a, l, r, n[lang], -score


def got(df):
    return sorted(tuple(r)[:8] for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], SCHEMA)


def random_rows(rng, n):
    words = ["the", "of", "New", "york", "city", "é", "à la", "x\x0by", "a b", "ÉA", "q", "\x1cz", "\x00"]
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" "] * 12 + ["\t", "  ", ". ", ",", "\n"]) for _ in range(rng.randint(0, 30)))
        yield text, rng.choice(["en", "en", "fr", None, "und"])


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_python(spark, monkeypatch, small):
    rng = random.Random(small)
    rows = list(random_rows(rng, 1500)) + [(None, "en"), ("", None), (" . ,", "fr"), ("the " * 3000, "en"), ("only here", "xx")]
    rows += [("one of a kind thing indeed", "de")] * 40 + [("of a kind", "de")] * 3
    if small:
        monkeypatch.setattr(C, "BURST", 4)
        monkeypatch.setattr(C, "TRIE_ENTRIES", 50)
        monkeypatch.setattr(C, "TASK_WORDS", 9)
        monkeypatch.setattr(C, "SLICE_BYTES", 64)
        monkeypatch.setattr(C, "TASK_PAIRS", 40)
        monkeypatch.setattr(C, "RANGE_PAIRS", 700)
        monkeypatch.setattr(C, "HOT_SHARE", 10)
        monkeypatch.setattr(blooms, "FILTER_BITS", (64, 64))  # full: nothing is left out
    found = got(C.collocations(frame(spark, rows).repartition(5)))
    assert found == sorted(plain(rows)) and len(found) > 50
    assert got(C.collocations(frame(spark, rows), least=5, top=7)) == sorted(plain(rows, 5, 7))


def test_empty(spark):
    assert C.collocations(frame(spark, [("a b", "en")])).count() == 0
    assert C.collocations(frame(spark, [("a b", "en")]).limit(0)).count() == 0
    assert C.collocations(frame(spark, [(None, None)])).count() == 0


def test_trie_counts_bursts_and_spills(monkeypatch):
    monkeypatch.setattr(C, "BURST", 3)
    rng = np.random.default_rng(1)
    trie, want, spilled = C.BurstTrie(), Counter(), Counter()

    def unpack(head, rest):
        out = []
        while rest:
            out.append((rest & (1 << C._DIGIT) - 1) - 1)
            rest >>= C._DIGIT
        return (head, *out[::-1])

    for turn in range(40):
        ids = rng.integers(0, 6, 50)
        kept = rng.random(49) < 0.9
        for size in (2, 3, 4):
            for i in range(50 - size + 1):
                if kept[i : i + size - 1].all():
                    want[tuple(ids[i : i + size].tolist())] += 1
        for found in C.phrase_rows(ids, kept, (2, 3, 4)):
            trie.add(*found)
        for head, run in trie.spill(0.4) if turn % 5 == 4 else ():
            assert run == sorted(run)
            for rest, n in run:
                spilled[unpack(head, rest)] += n
        assert trie.entries == sum(len(t) if isinstance(t, dict) else t.size() for t in trie.root.values())
    for head, run in trie.spill(1.0):
        for rest, n in run:
            spilled[unpack(head, rest)] += n
    assert spilled == want and trie.entries == 0


def test_packed_counts_come_back():
    rng = np.random.default_rng(4)
    for n in (1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << C.PAIR_BITS, n, dtype=np.uint64))
        counts = rng.integers(1, 400, len(keys))
        found = C.unpack_counts(*C.pack_counts(keys, counts))
        assert (found[0] == keys).all() and (found[1] == np.minimum(counts, 255)).all()


def test_packed_runs_come_back():
    run = [(b"b c", 3), (b"a", 1 << 40), (b"", 2), ("é ü".encode(), 9)]
    assert list(C.unpack_run(*C.pack_run(list(run)))) == sorted(run)


def test_arithmetic_beyond_64_bits(spark):
    big = 3_000_000_000_000_000_000
    frequent = spark.createDataFrame([("en", "a", big + 1), ("en", "b", big + 7), ("en", "a b", big)], "lang string, phrase string, n long")
    row = C.scored(frequent.filter("phrase = 'a b'"), frequent, big, C.SCALE, C.LONGEST).first()
    assert (row["score"], row["l"], row["r"]) == (2_000_000 * big // (2 * big + 8), big + 1, big + 7)


def test_query(spark, sf):
    df = queries.QUERIES["op13_collocations"](spark, sf)
    assert df.columns[:8] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang")
    assert got(df) == sorted(plain([tuple(r) for r in docs.collect()]))
