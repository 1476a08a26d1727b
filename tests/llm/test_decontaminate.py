import hashlib
import random
import re

from textquarry.llm import decontaminate, queries

SCHEMA = "doc_id long, text string, items string, n_words string"
ITEMS = "item_id long, text string, doc_id string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, items, window=10):
    for doc_id, text in rows:
        own = words(text)
        hit, found = set(), set()
        for item, passage in items:
            those = words(passage)
            n = min(window, len(those))
            if not n:
                continue
            runs = {tuple(those[i : i + n]) for i in range(len(those) - n + 1)}
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in runs:
                    hit.update(range(i, i + n))
                    found.update([] if item is None else [str(item)])
        yield doc_id, len(own), len(hit), sorted(found)


def result(df):
    for r in df.collect():
        yield r["doc_id"], r["n_words"], sum(b - a for a, b in zip(r["firsts"], r["afters"])), r["items"]


def cases():
    rng = random.Random(2)
    vocabulary = ["a", "B", "ça", "7", "猫", "word", "x9"]
    line = lambda n: rng.choice([" ", ", ", "--"]).join(rng.choices(vocabulary, k=n))
    items = [(i, line(rng.choice([0, 1, 2, 3, 9, 10, 11, 30]))) for i in range(12)] + [(3, line(12)), (None, line(10)), (50, None), (10, "never seen in any document " * 3)]
    rows = [(i, line(rng.randrange(60)) + " " + (rng.choice(items)[1] or "") + " " + line(rng.randrange(9))) for i in range(150)]
    rows += [(7, rows[7][1]), (8, "other text"), (200, None), (201, ""), (202, "!!!"), (None, items[5][1]), (203, "z " * 50_000 + items[7][1])]
    return rows, items


def as_set(rows):
    return sorted(map(repr, rows))


def test_against_brute_force(spark, monkeypatch):
    rows, items = cases()
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA).repartition(4)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    want = list(brute(rows, items))
    assert as_set(result(decontaminate.contamination(docs, bench))) == as_set(want)
    clean = as_set(w[:2] for w in want if not w[2])
    kept = decontaminate.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert as_set((r[0], len(words(r[1]))) for r in kept.collect()) == clean
    # Several blocks give the same.
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 60)
    assert as_set(result(decontaminate.contamination(docs, bench))) == as_set(want)
    assert as_set((r[0], len(words(r[1]))) for r in decontaminate.decontaminated(docs, bench).collect()) == clean


def test_an_item_without_an_id_hits_all_the_same(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"before {passage} after", "x", "y"), (2, "other", "x", "y")], SCHEMA)
    bench = spark.createDataFrame([(None, passage, "x")], ITEMS)
    assert sorted(result(decontaminate.contamination(docs, bench))) == [(1, 12, 10, []), (2, 1, 0, [])]
    assert [r["doc_id"] for r in decontaminate.decontaminated(docs, bench).collect()] == [2]


def test_empty_tables(spark):
    rows, items = cases()
    docs, bench = spark.createDataFrame([(1, "a b", "x", "y")], SCHEMA), spark.createDataFrame([(1, "a b", "x")], ITEMS)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert list(result(decontaminate.contamination(docs, bench.limit(0)))) == [(1, 2, 0, [])]


def test_query(spark, sf):
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(*c).collect()]
    want = brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    rows = queries.QUERIES["op7_decontaminate"](spark, sf).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows]
    digest = lambda items: hashlib.sha256(",".join(items).encode()).hexdigest()
    assert as_set(got) == as_set((d, n, h, len(i), digest(i), h > 0) for d, n, h, i in want)
    assert any(r["contaminated"] for r in rows)


def test_shingles_are_counted_in_small_batches(spark, monkeypatch):
    """Whatever the session's batches are, which then hold again."""
    from textquarry.llm import decontaminate as D

    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    docs = spark.createDataFrame([("one two three four five six seven eight nine ten eleven",)], "text string")
    collect, before = type(docs).collect, spark.conf.get(key)
    monkeypatch.setattr(type(docs), "collect", lambda df: seen.append(spark.conf.get(key)) or collect(df))
    index = D.build_index(docs, [("1", "two three four five six seven eight nine ten eleven")], 10)
    assert len(index.size) == 1 and seen == [D.COUNTED_TEXTS] and spark.conf.get(key) == before
