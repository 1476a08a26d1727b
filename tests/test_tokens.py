import random
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, trainers

from textquarry.functions.patterns import SPECIAL_TOKENS
from textquarry.operators import tokens


def corpus():
    rng = random.Random(11)
    stems = ["lower", "newest", "widest", "banana", "aaaa", "été", "naïve", "don't", "x_1", "low-end", "ÉCOLE", "αβγ", "!!??", "abab"]
    return [" ".join(rng.choice(stems) + rng.choice(["", "s", "er", "."]) for _ in range(rng.randint(3, 25))) for _ in range(80)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(corpus())), "seq bigint, text string").cache()


def library(size):
    tok = Tokenizer(models.BPE())
    tok.normalizer = normalizers.Sequence([normalizers.NFD(), normalizers.Lowercase(), normalizers.StripAccents()])
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.train_from_iterator(
        corpus(), trainers.BpeTrainer(vocab_size=size, special_tokens=list(SPECIAL_TOKENS), show_progress=False)
    )
    return tok


@pytest.fixture(scope="module")
def bpe(texts):
    vocab, merges = tokens.train(tokens.word_counts(texts), "bpe", 90)
    return vocab, merges, tokens.broadcast_vocabulary(vocab, merges, "bpe")


def test_bpe_equals_library(spark, texts, bpe):
    vocab, _, ready = bpe
    tok = library(90)
    assert {r.token: r.id for r in vocab.collect()} == tok.get_vocab()
    got = {r.seq: (r.tokens, r.token_ids, r.token_length) for r in tokens.encode(texts, ready).collect()}
    for i, t in enumerate(corpus()):
        want = tok.encode(t)
        assert got[i] == (want.tokens, want.ids, len(want.ids))


def test_bpe_equals_library_on_documents(spark, sf):
    """Some hundred merges, among them many of equal counts."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    tok = Tokenizer(models.BPE())
    tok.normalizer = library(90).normalizer
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    trainer = trainers.BpeTrainer(vocab_size=700, special_tokens=list(SPECIAL_TOKENS), show_progress=False)
    tok.train_from_iterator([r.text for r in docs.collect()], trainer)
    vocab, _ = tokens.train(tokens.word_counts(docs), "bpe", 700)
    assert {r.token: r.id for r in vocab.collect()} == tok.get_vocab()


def test_long_words_encode_in_time(bpe):
    import time

    word = "lowerbanana" * 9000
    start = time.perf_counter()
    pieces = bpe[2].value.pieces(word)
    assert "".join(pieces) == word and time.perf_counter() - start < 5


def test_encode_corner_cases_equal_library(spark, bpe):
    tok = library(90)
    odd = ["<s> low </s>", "a<mask>b", "!<s>!", "zebra qqq", "", "   ", "İstanbul", "<pad", "low😀er"]
    df = spark.createDataFrame(list(enumerate(odd)), "seq bigint, text string")
    got = {r.seq: r.token_ids for r in tokens.encode(df, bpe[2]).collect()}
    assert [got[i] for i in range(len(odd))] == [tok.encode(t).ids for t in odd]


def test_decode(spark, bpe):
    tok = library(90)
    ids = [0, 5, 9, 40, 1, 3000]
    df = spark.createDataFrame([(ids,)], "token_ids array<int>")
    assert tokens.decode(df, bpe[2]).first().decoded == tok.decode(ids[:-1])


def test_wordpiece(spark, texts):
    vocab, merges = tokens.train(tokens.word_counts(texts), "wordpiece", 80)
    rows = vocab.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(80)) and len({r.token for r in rows}) == 80
    table = [r.token for r in rows]
    bare = [t for t in table[5:] if len(t) == 1]
    continuing = [t for t in table if t.startswith("##") and len(t) == 3]
    assert bare == sorted(bare) and continuing == sorted(continuing)
    ready = tokens.broadcast_vocabulary(vocab, merges, "wordpiece")
    encoded = {r.seq: r.tokens for r in tokens.encode(texts, ready).collect()}
    for got in encoded.values():
        for t in got:
            assert t in table
    df = spark.createDataFrame([(0, "low"), (1, "low Ω"), (2, "a" * 101)], "seq bigint, text string")
    unk = {r.seq: r.tokens for r in tokens.encode(df, ready, unk_policy="unk").collect()}
    assert unk[1][-1] == "<unk>" and unk[2] == ["<unk>"]
    assert {r.seq for r in tokens.encode(df, ready, unk_policy="drop").collect()} == {0}
    with pytest.raises(Exception, match="not in the vocabulary"):
        tokens.encode(df, ready, unk_policy="error").collect()


def test_save_and_load(spark, bpe, tmp_path):
    tokens.save(bpe[0], bpe[1], str(tmp_path / "vocab"))
    vocab, merges = tokens.load(spark, str(tmp_path / "vocab"))
    assert sorted(map(tuple, vocab.collect())) == sorted(map(tuple, bpe[0].collect()))
    assert sorted(map(tuple, merges.collect())) == sorted(map(tuple, bpe[1].collect()))


def one_at_a_time(words, kind, size):
    """Vocabulary by one merge after another; all words with a pair are recounted for it."""
    spelled = {w: [f"##{c}" if i and kind == "wordpiece" else c for i, c in enumerate(w)] for w in words}
    chars = {c for s in spelled.values() for c in s}
    if kind == "wordpiece":
        bare = sorted({c.removeprefix("##") if len(c) > 1 else c for c in chars})
        alphabet = bare + sorted(c for c in chars if len(c) > 1)
    else:
        alphabet = sorted(chars)
    table = [*SPECIAL_TOKENS, *(c for c in alphabet if c not in SPECIAL_TOKENS)]
    ids = {t: i for i, t in enumerate(table)}
    spelled = {w: [ids[c] for c in s] for w, s in spelled.items()}
    counts, holders = Counter(), defaultdict(set)

    def count(w, sign):
        for pair in zip(spelled[w], spelled[w][1:]):
            counts[pair] += sign * words[w]
            holders[pair].add(w)

    for w in words:
        count(w, 1)
    while len(table) < size:
        n = max(counts.values(), default=0)
        if n <= 0:
            break
        left, right = min(p for p, m in counts.items() if m == n)
        token = table[left] + (table[right].removeprefix("##") if kind == "wordpiece" else table[right])
        if token not in ids:
            ids[token] = len(table)
            table.append(token)
        for w in list(holders[left, right]):
            count(w, -1)
            s, out = spelled[w], []
            while s:
                step = 2 if s[:2] == [left, right] else 1
                out.append(ids[token] if step == 2 else s[0])
                s = s[step:]
            spelled[w] = out
            count(w, 1)
        counts += Counter()  # drops what is gone
    return table


@pytest.mark.parametrize("kind", ["bpe", "wordpiece"])
def test_training_equals_one_merge_at_a_time(spark, sf, kind, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    counts = tokens.word_counts(docs).cache()
    words = {r.word: r.n for r in counts.collect()}
    words["ab" * 500] = 3  # one long word
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    want = one_at_a_time(words, kind, 700)
    vocab, _ = tokens.train(table, kind, 700)
    assert [r.token for r in vocab.orderBy("id").collect()] == want
    # However small the parts of the order are.
    monkeypatch.setattr(tokens, "HEAVY_PAIRS", (60, 60))
    monkeypatch.setattr(tokens, "SEGMENT_SYMBOLS", 3000)
    vocab, _ = tokens.train(table, kind, 300)
    assert [r.token for r in vocab.orderBy("id").collect()] == want[:300]


def test_few_rounds(spark, sf):
    """5000 tokens equal those of the library, in a few rounds."""
    docs = spark.read.parquet(f"{sf}/documents.parquet".replace("sf0.001", "sf0.01")).select("text")
    tok = Tokenizer(models.BPE())
    tok.normalizer = library(90).normalizer
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    trainer = trainers.BpeTrainer(vocab_size=5000, special_tokens=list(SPECIAL_TOKENS), show_progress=False)
    tok.train_from_iterator([r.text for r in docs.collect()], trainer)
    counts = tokens.word_counts(docs)
    names = tokens._Naming(tokens.start(counts, "bpe"), "bpe")
    rounds = list(tokens._rounds(tokens.spell(counts, "bpe", names.known), names, 5000))
    assert names.known == tok.get_vocab()
    assert len(rounds) <= 20 and sum(map(len, rounds)) == len(names.merges)


def test_training_without_words_and_to_the_end(spark):
    none = spark.createDataFrame([], "word string, n bigint")
    assert tokens.train(none, "bpe", 50)[0].count() == len(SPECIAL_TOKENS)
    few = spark.createDataFrame([("aaaa", 3), ("b", 9), ("abaab", 1)], "word string, n bigint")
    for kind in ("bpe", "wordpiece"):
        table = [r.token for r in tokens.train(few, kind, 30_000)[0].orderBy("id").collect()]
        assert table == one_at_a_time({"aaaa": 3, "b": 9, "abaab": 1}, kind, 30_000)


def test_totals_and_sizes(spark):
    df = spark.createDataFrame([([1, 2, 3], 3), ([4], 1)], "token_ids array<int>, token_length int")
    assert tuple(tokens.token_totals(df).first()) == (2, 4, 2.0)
    report = tokens.size_report(df).first()
    assert report.input_bytes > report.output_bytes == len('{"token_ids":[1,2,3]}\n{"token_ids":[4]}\n')
    assert tokens.token_totals(df.limit(0)).first().avg_sequence_length == 0.0


def test_batches_are_worked_on_in_parts():
    """Parts of bounded size whatever the rows, a larger row by itself; nothing is lost or reordered."""
    import pyarrow as pa

    from textquarry.functions import words as W

    texts = pa.array(["a" * 1000, None, "", "b" * (W.SLICE_BYTES + 5)] * 3 + ["c" * 1000] * 5000)
    parts = list(W.slices(texts))
    assert pa.concat_arrays(parts).equals(texts)
    assert all(len(p) == 1 or sum(len(t.as_py() or "") for t in p) <= W.SLICE_BYTES for p in parts)
    rows = pa.array([[1] * (W.SLICE_ITEMS + 1), None, [], [2] * 90_000, [3] * 90_000, [4] * 90_000], pa.list_(pa.int32()))
    parts = list(W.slices(rows))
    assert pa.concat_arrays(parts).equals(rows)
    assert [len(p) for p in parts] == [1, 4, 1]


def test_tokens_are_named_only_when_selected(spark, bpe):
    texts = ["low " * 60_000, None, "", "newest\n\twidest", "<s>"]
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, text string").coalesce(1)
    coded = tokens.encode(df, bpe[2])
    plan = coded.select("seq", "token_ids")._jdf.queryExecution().executedPlan().toString()
    assert "name(" not in plan and "encode(" in plan
    got = {r.seq: (r.tokens, r.token_ids) for r in coded.collect()}
    tok = library(90)
    assert got == {i: (e.tokens, e.ids) for i, t in enumerate(texts) if t is not None for e in [tok.encode(t)]}
    spelled = {r.seq: r.decoded for r in tokens.decode(coded, bpe[2]).collect()}
    assert spelled == {i: tok.decode(ids) for i, (_, ids) in got.items()}


def test_reduce_job_encodes_once(spark, bpe, tmp_path):
    from textquarry.plans import jobs

    df = spark.createDataFrame([(0, "low <s> newest"), (1, None), (2, "naïve é")], "seq bigint, text string")
    rows = tokens.encode(df, bpe[2]).select("seq", "text", "token_ids")
    sizes = jobs.reduce_job(rows, str(tmp_path / "ids"))
    assert "encode(" not in sizes._jdf.queryExecution().executedPlan().toString()
    assert sizes.collect() == tokens.size_report(rows).collect()
    assert spark.read.json(str(tmp_path / "ids")).count() == 2


def test_words_are_spelled_without_an_exchange(spark):
    rows = [("été", 2), ("a", 1), (None, 5), ("", 4), ("xé😀", 3), ("x", 7)]
    words = spark.createDataFrame(rows, "word string, n bigint")
    for kind, ids, want in (
        ("bpe", {"é": 3, "t": 4, "a": 0, "😀": 9, "<s>": 1}, {(2, (3, 4, 3)), (1, (0,)), (3, (3, 9))}),
        ("wordpiece", {"é": 3, "##é": 5, "##t": 4, "a": 0, "##😀": 9}, {(2, (3, 4, 5)), (1, (0,)), (3, (5, 9))}),
    ):
        spelled = tokens.spell(words, kind, ids)
        plan = spelled._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
        assert {(r.n, tuple(r.symbols)) for r in spelled.collect()} == want


def test_rows_merge_like_one_at_a_time():
    """Also where a merge spells a known symbol, ranks are equal, and rows are empty or long."""
    import numpy as np

    from textquarry.functions.merges import LONG_ROW, Merges, Rows, merge_ranked, merge_rows

    rng = random.Random(3)
    for _ in range(500):
        k = rng.randint(2, 5)
        merged = {(rng.randrange(k + 6), rng.randrange(k + 6)): (rng.randrange(20), rng.randrange(k + 6)) for _ in range(rng.randint(0, 14))}
        rows = [[rng.randrange(k) for _ in range(rng.choice([0, 1, 2, 5, 30, LONG_ROW, LONG_ROW + 9]))] for _ in range(rng.randint(0, 9))]
        flat = np.array([s for row in rows for s in row], dtype=np.int32)
        symbols, sizes = merge_rows(Rows(flat, np.array([len(row) for row in rows], dtype=np.int64)), Merges(merged))
        want = [merge_ranked(row, merged) for row in rows]
        assert sizes.tolist() == [len(row) for row in want]
        assert symbols.tolist() == [s for row in want for s in row]


def test_words_are_coded_together_like_alone(bpe):
    vocab = bpe[2].value
    words = ["lower", "", "Ω", "﷑", "newest" * 30, "été", "loweΩst", "﷔", "a"]
    coded = vocab.coded(words)
    assert coded == [vocab._ids(vocab.pieces(w)) for w in words] and coded[2] == b"" and len(coded[3]) == 4
    assert vocab.coded([]) == []


def test_the_last_merges_take_few_pairs_and_no_pass(spark, sf, monkeypatch):
    """A vocabulary that is full needs no merged words, and a few merges no segments of thousands of pairs."""
    counts = tokens.word_counts(spark.read.parquet(f"{sf}/documents.parquet").select("text")).cache()
    size = len(tokens.start(counts, "bpe")) + 24
    heavy, made = [], []
    segments, apply = tokens._segments, tokens._apply
    monkeypatch.setattr(tokens, "_segments", lambda words, keys: heavy.append(len(keys)) or segments(words, keys))
    monkeypatch.setattr(tokens, "_apply", lambda words, merges: made.append(len(merges)) or apply(words, merges))
    vocab, merges = tokens.train(counts, "bpe", size)
    assert vocab.count() == size
    assert max(heavy) <= tokens.PAIRS_A_MERGE * 24 and sum(made) < merges.count()
