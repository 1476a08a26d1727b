import random

import public_tokenizers
from tokenizers import Tokenizer

from textquarry.llm import queries
from textquarry.llm import tokentree as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = f"doc_id long, text string, edits {T.EDITS}, counts string, n_tokens long"


def edited(text, edits):
    text = text or ""
    for start, length, insert in edits or []:
        start = min(max(start or 0, 0), len(text))
        text = text[:start] + (insert or "") + text[start + max(length or 0, 0) :]
    return text


def random_text(rng, n):
    return "".join(rng.choices(["a", "word", "The", " ", " ", " ", "  ", "\n", ".", "é", "猫", "'s", "7"], k=n))


def test_every_edit_against_a_full_count():
    rng = random.Random(6)
    tokenizer = Tokenizer.from_file(PATH)
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for _ in range(60):
        text = random_text(rng, rng.choice([0, 3, 40, 400]))
        tree = T.TokenTree(T.segments_of(text, 12), None, count)
        for _ in range(12):
            e = (rng.randrange(len(text) + 3), rng.choice([0, 0, 1, 5, 60]), random_text(rng, rng.choice([0, 1, 4, 30])))
            tree.edit(*e)
            text = edited(text, [e])
            assert "".join(tree.segments) == text
            assert (tree.chars, tree.tokens) == (len(text), count(text)), (e, text)
            assert sum(tree.counts()) == tree.tokens


def test_only_the_region_is_encoded():
    seen = []
    text = "some words of a text that is rather long " * 500
    tree = T.TokenTree(T.segments_of(text), None, lambda t: seen.append(len(t)) or len(t.split()))
    seen.clear()
    tree.edit(10_000, 5, "other")
    assert sum(seen) <= 4 * T.SEGMENT_CHARS and len(seen) <= 3


def test_edge_rows_and_kept_trees(spark):
    rng = random.Random(9)
    tokenizer = Tokenizer.from_file(PATH)
    count = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    rows = [(1, None, None), (2, "", [(0, 0, "new text")]), (3, "a b", [(0, 99, None)]), (3, "a b", [(0, 99, None)]), (None, "x y", [(None, None, "z")])]
    rows += [(i, random_text(rng, 300), [(rng.randrange(900), rng.randrange(50), random_text(rng, 9)) for _ in range(4)]) for i in range(10, 30)]
    rows += [(40, "long text " * 30_000, [(150_000, 10, "é")])]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).repartition(3)
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["n_tokens_after"], r["n_chars_after"]) for r in T.counts_after_edits(df, PATH).collect())
    assert got == sorted((d or -1, count(t), count(edited(t, e)), len(edited(t, e))) for d, t, e in rows)
    assert T.counts_after_edits(df.limit(0), PATH).count() == 0
    # Trees that are kept as a table and edited later.
    single = [r for r in rows if r[0] not in (None, 3)]
    trees = T.build_trees(spark.createDataFrame([(*r, "x", 5) for r in single], SCHEMA), PATH)
    edits = [(d, k, *e) for d, _, es in single for k, e in enumerate(es or [])]
    after = T.update_trees(trees, spark.createDataFrame(edits, "doc_id long, seq int, start long, length long, insert string"), PATH).collect()
    assert {r["doc_id"]: ("".join(r["segments"]), r["n_tokens"]) for r in after} == {d: (edited(t, e), count(edited(t, e))) for d, t, e in single}


def test_query(spark, sf):
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {}
    for doc_id, text, edits in docs.select("doc_id", "text", queries.edits_of(docs).alias("edits")).collect():
        after = edited(text, [(e["start"], e["length"], e["insert"]) for e in edits])
        want[doc_id] = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in (text, after)] + [len(after)]
    got = queries.QUERIES["op6_token_counts"](spark, sf).collect()
    assert {r["doc_id"]: [r["n_tokens"], r["n_tokens_after"], r["n_chars_after"]] for r in got} == want
    assert sum(r["n_chars_encoded"] for r in got) < 0.9 * sum(len(t or "") for (t,) in docs.select("text").collect())
