import json

import pytest

from textquarry.sources import ledger, records


@pytest.fixture
def files(tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path / name)

    lines = [json.dumps({"text": "one é😀", "id": 1}), json.dumps("bare"), "{broken", "5", json.dumps({"body": "x"}), "", json.dumps({"text": "last"})]
    return {
        "jsonl": put("a.jsonl", "\n".join(lines) + "\n"),
        "list": put("b.json", json.dumps([{"text": "in\nlist"}, "string", 3, {"no": 1}])),
        "object": put("c.json", json.dumps({"text": "single"})),
        "txt": put("d.txt", "whole\nfile"),
        "text": put("e.text", "other"),
        "csv": put("f.csv", "a,b"),
    }


def test_all_kinds_in_order(spark, files):
    paths = [files[k] for k in ("txt", "jsonl", "csv", "list", "object", "text")] + [files["txt"] + ".missing.txt"]
    rows = records.load_texts(spark, paths).orderBy("seq").collect()
    assert [r.text for r in rows] == ["whole\nfile", "one é😀", "bare", "last", "in\nlist", "string", "single", "other"]
    assert [r.seq for r in rows] == list(range(8))
    assert [r.text for r in records.load_texts(spark, paths, 3).collect()] == ["whole\nfile", "one é😀", "bare"]
    assert [r.value for r in records.malformed_lines(spark, [files["jsonl"]]).collect()] == ["{broken"]


def test_resolution_and_listing(spark, files, tmp_path):
    found = records.resolve(spark, [files["list"]], [files["txt"], "/nowhere/x.txt"])
    assert found == [files["list"], files["txt"]]
    with pytest.raises(FileNotFoundError):
        records.resolve(spark, [], ["/nowhere/x.txt"])
    with pytest.raises(ValueError):
        records.load_texts(spark, [files["csv"]])
    names = {r.path.rsplit("/", 1)[1] for r in records.list_files(spark, str(tmp_path), "*.json").collect()}
    assert names == {"b.json", "c.json"}


def test_ledger(spark):
    urls = spark.createDataFrame([("http://a/x.jsonl",), ("http://b/y.jsonl",), ("http://c/z/",)], "url string")
    done = spark.createDataFrame([("x.jsonl",), ("x.jsonl",)], "name string")
    assert sorted(r.name for r in ledger.pending(urls, done).collect()) == ["", "y.jsonl"]


def test_splits_may_change_between_call_and_action(spark, tmp_path):
    path = tmp_path / "many.jsonl"
    path.write_text("".join(f'{{"text": "record {i} {"x" * 90}"}}\n' for i in range(5000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
        loaded = records.load_texts(spark, [str(path)])
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        rows = loaded.orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [r.seq for r in rows] == list(range(5000))
    assert [int(r.text.split()[1]) for r in rows] == list(range(5000))
    # The wide rows are joined with a table of one row per block, without a shuffle.
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_written_tables_leave_no_shuffles_and_can_go(spark, tmp_path):
    from pyspark.sql import functions as F

    from textquarry.session import discard, settings, write_table

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    table = write_table(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    assert table.count() == 10 and spark.conf.get(key) == before
    (folder,) = {name.rsplit("/", 1)[0].removeprefix("file://") for name in table.inputFiles()}
    other = tmp_path / "other"
    table.write.parquet(str(other))
    discard(spark.read.parquet(str(other)))
    discard(table.filter("k > 3"))
    import os

    assert not os.path.exists(folder) and os.path.exists(other)
    with settings(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") != "3"


def test_listing_takes_tables_written_as_folders(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    spark.range(4).selectExpr("id", "id % 2 as half").write.partitionBy("half").parquet(str(tmp_path / "parts.parquet"))
    (tmp_path / "one.parquet").write_bytes(b"12345")
    (tmp_path / "one.json").write_text("{}")
    got = {r.path.rsplit("/", 1)[1]: r.length for r in records.list_files(spark, str(tmp_path), "*.parquet").collect()}
    sizes = {d: sum(f.stat().st_size for f in (tmp_path / d).rglob("part-*")) for d in ("many.parquet", "parts.parquet")}
    assert got == sizes | {"one.parquet": 5}
    assert records.list_files(spark, str(tmp_path), "*.csv").collect() == []
