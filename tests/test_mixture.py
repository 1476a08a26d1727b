import hashlib
import json
from collections import Counter

from pyspark.sql import functions as F

from textquarry.operators import mixture
from textquarry.sources import sinks


def frame(spark):
    rows = [(i, "big" if i % 3 else "small" if i % 2 else "none") for i in range(400)]
    return spark.createDataFrame(rows, "seq bigint, dataset string"), rows


def test_sample_equals_brute_force(spark):
    df, rows = frame(spark)
    weights = {"big": 2.0, "small": 1.0}
    for seed in (0, 5):
        got = {(r.dataset, r.seq) for r in mixture.sample(df, weights, seed).collect()}
        want = set()
        for name, n in Counter(d for _, d in rows).items():
            k = int(n * (weights.get(name, 0) / 3.0))
            draw = sorted((hashlib.md5(f"{seed}:{name}:{i}".encode()).hexdigest(), i) for i, d in rows if d == name)
            want |= {(name, i) for _, i in draw[:k]}
        assert got == want


def test_default_weights_keep_equal_fractions(spark):
    df, rows = frame(spark)
    sizes = {r.dataset: r for r in mixture.sample_sizes(df).collect()}
    n = Counter(d for _, d in rows)
    assert all(sizes[d].samples == int(n[d] * (1 / 3)) for d in n)
    alone = df.filter("dataset = 'big'")
    assert mixture.sample(alone, {"big": 1.0}).count() == n["big"]


def test_index_and_shards(spark, tmp_path):
    df = spark.createDataFrame([(i * i * 7 % 1009, i) for i in range(300)], "seq bigint, v int").repartition(5)
    got = [r["index"] for r in mixture.with_index(df).orderBy("seq").collect()]
    assert got == list(range(300))
    sinks.export_shards(df, str(tmp_path / "shards"), 64)
    folders = sorted(p.name for p in (tmp_path / "shards").glob("shard=*"))
    assert folders == [f"shard={i:05d}" for i in range(5)]
    assert [len([1 for f in (tmp_path / "shards" / d).glob("*.json") for _ in f.open()]) for d in folders] == [64] * 4 + [44]
    assert sinks.export_tokenized(df, str(tmp_path / "all"), 1000) is False


def test_mixture_files(spark, tmp_path):
    df, _ = frame(spark)
    parts = {name: df.filter(F.col("dataset") == name).drop("dataset") for name in ("big", "small")}
    sinks.export_mixture(mixture.labelled(parts), str(tmp_path), {"big": 1, "small": 1}, seed=3)
    lines = [json.loads(x) for f in sorted((tmp_path / "mixture").glob("*.json")) for x in f.open()]
    meta = [json.loads(x) for f in (tmp_path / "mixture_metadata").glob("*.json") for x in f.open()]
    assert meta[0]["total_samples"] == len(lines) and meta[0]["datasets"] == ["big", "small"]
    assert Counter(x["dataset"] for x in lines) == meta[0]["samples_per_dataset"]
    again = [r.seq for r in mixture.mix(mixture.labelled(parts), {"big": 1, "small": 1}, 3).collect()]
    assert again == [x["seq"] for x in lines] and again != sorted(again)


def test_proportional_sizes_add_up(spark):
    rows = [(i, "abc"[min(i % 7, 2)]) for i in range(100)]
    df = spark.createDataFrame(rows, "seq bigint, dataset string")
    for weights, total in (({"a": 1, "b": 1, "c": 1}, 10), ({"a": 0.2, "b": 0.5, "c": 0.3}, 17), (None, 40)):
        sizes = {r.dataset: r.samples for r in mixture.sample_sizes(df, weights, "proportional", total).collect()}
        assert sum(min(n, 100) for n in sizes.values()) == total or any(sizes[d] == df.filter(df.dataset == d).count() for d in sizes)
        chosen = mixture.sample(df, weights, 3, mode="proportional", total=total)
        assert {r.dataset: r["count"] for r in chosen.groupBy("dataset").count().collect()} == {d: n for d, n in sizes.items() if n}
    # 10 / 3 each: the first name gets what is left.
    assert {r.dataset: r.samples for r in mixture.sample_sizes(df, {"a": 1, "b": 1, "c": 1}, "proportional", 10).collect()} == {"a": 4, "b": 3, "c": 3}
    # No dataset gives more than it has.
    assert all(r.samples <= r.available for r in mixture.sample_sizes(df, {"a": 9, "b": 1, "c": 0}, "proportional", 100).collect())


def test_numbers_without_a_join_of_rows(spark):
    df = spark.range(0, 1000, 1, 7).select((1000 - F.col("id")).alias("seq"), F.lit("x").alias("text")).filter("seq % 3 = 0")
    indexed = mixture.with_index(df)
    assert [tuple(r) for r in indexed.orderBy("seq").select("seq", "index").collect()] == [(s, i) for i, s in enumerate(range(3, 1001, 3))]
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_head_is_cut_where_the_rows_are(spark):
    df = spark.range(0, 1000, 1, 7).select(((F.col("id") * 7919) % 1009).alias("seq"), F.lit("x").alias("text"))
    want = sorted(r.seq for r in df.collect())
    for n in (1, 5, 100, 999, 1000, 5000):
        assert sorted(r.seq for r in mixture.head(df, n).collect()) == want[:n]
    plan = mixture.head(df, 100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan
    assert mixture.head(df.limit(0), 3).count() == 0
