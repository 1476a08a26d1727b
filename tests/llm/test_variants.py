import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from textquarry.llm import queries
from textquarry.llm import variants as V

SCHEMA = "doc_id long, text string, word string, n string"


def plain_counts(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_near(words):
    """Pairs through the word with each letter left out, compared letter by letter."""
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
        for i in range(len(w) + 1):
            holes[w[:i], w[i:]].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a] |= group - {a}
    return near


def plain_groups(counts):
    near = plain_near(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None


def as_set(rows):
    return sorted(map(str, map(tuple, rows)))


def random_words(rng, n, letters="abcdé"):
    words = {"".join(rng.choices(letters, k=rng.randint(7, 10))) for _ in range(n)}
    for w in list(words):
        i, c = rng.randrange(len(w)), rng.choice(letters)
        words.add(rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :]]))
    return [w for w in words if len(w) >= 7]


def test_one_edit_against_plain_python():
    rng = random.Random(1)
    words = random_words(rng, 60, "abc")
    near = plain_near(words)
    letters = V.Letters(words)
    pairs = [(i, j) for i in range(len(words)) for j in range(len(words)) if len(words[i]) <= len(words[j])]
    a, b = map(np.array, zip(*pairs))
    width = int(letters.lengths.max())
    got = V.one_edit(letters.rows(a, width), letters.lengths[a], letters.rows(b, width + 1), letters.lengths[b])
    assert got.tolist() == [words[j] in near[words[i]] for i, j in pairs] and got.any()


@pytest.mark.parametrize("depth", [2, 3])
def test_cells_that_are_reached_hold_all_near_words(depth):
    words = random_words(random.Random(2), 300)
    letters = V.Letters(words)
    heads = letters.vectors[:, :depth]
    own = V.cell_keys(letters.lengths, heads)
    asked = defaultdict(dict)
    for w, cell, deficit in zip(*V.reached(letters.lengths, heads)):
        assert cell not in asked[w]
        asked[w][cell] = deficit
    place = {w: i for i, w in enumerate(words)}
    for w, others in plain_near(words).items():
        for x in others:
            if (len(w), w) < (len(x), x):
                assert own[place[x]] in asked[place[w]]


def test_trie_finds_each_pair_once(monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 37)
    monkeypatch.setattr(V, "PAIRS", 50)
    monkeypatch.setattr(V, "PAIR_CELLS", 200)
    words = random_words(random.Random(3), 250) + ["x" * 3000, "x" * 3001, "x" * 2999 + "y"]
    for cells in (V.TABLE_CELLS, 0):
        monkeypatch.setattr(V, "TABLE_CELLS", cells)
        members = V.Members(pd.DataFrame([(0, w, 1) for w in words], columns=["bucket", "word", "n"]))
        rows = pd.DataFrame([(0, 2, w) for w in words] + [(1, 2, w) for w in words], columns=["bucket", "role", "word"])
        got = [(words[a], words[b]) for x, y in members.near(rows) for a, b in zip(x, y)]
        check_pairs(words, got)


def check_pairs(words, got):
    want = {(a, b) for a, others in plain_near(words).items() for b in others if (len(a), a) < (len(b), b)}
    assert len(got) == len(set(got)) and set(got) == want


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", "y") for k, t in rows], SCHEMA)


def test_groups_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    words = random_words(rng, 400)
    counts = {w: rng.choice([2, 2, 3, 5, 30, 40, 300, 4000]) for w in words}
    counts |= {"zzzzzzz": 2, "zzzzzzx": 30, "zzzzzyx": 300, "zzzzayx": 4000}
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    want = as_set(plain_groups(counts))
    assert any(w[1] and w[2] != w[1] for w in plain_groups(counts))  # chains
    assert as_set(V.variant_groups(table).collect()) == want
    # Salted cells.
    monkeypatch.setattr(V, "CELL_WORDS", 3)
    monkeypatch.setattr(V, "DEPTHS", (2, 3))
    assert as_set(V.variant_groups(table).collect()) == want


def test_edges(spark):
    rows = [(1, "Example example éxample EXAMPLE"), (1, "Example example éxample EXAMPLE"), (2, None), (None, "example " * 50), (3, "")]
    rows += [(4, "exampel exampel examples examples ÉXAMPLE ÉXAMPLE"), (5, "a" * 20_000 + " " + "a" * 20_000 + " " + "a" * 19_999 + " 7" + "a" * 19_999), (6, "abc × ÷ short")]
    rows += [(i, "Wonderful wonderfull word") for i in range(10, 200)]
    counts = plain_counts(rows)
    assert any(len(w) == 19_999 or len(w) == 20_000 for w in counts)
    got = V.variant_groups(V.word_counts(frame(spark, rows))).collect()
    assert as_set(got) == as_set(plain_groups(counts))
    assert V.variant_groups(V.word_counts(frame(spark, rows).limit(0))).count() == 0
    assert V.variant_groups(V.word_counts(frame(spark, rows[2:3]))).count() == 0


def test_query(spark, sf):
    got = queries.QUERIES["op12_variants"](spark, sf)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    counts = plain_counts([tuple(r) for r in docs.collect()])
    assert as_set(got.collect()) == as_set(plain_groups(counts)) and len(counts) > 100
