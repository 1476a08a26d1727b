import base64
import hashlib

import pytest
import zstandard

from textquarry.llm import warc

SCHEMA = "page_id long, url string, html string, offset string"
ROWS = [
    (1, "http://a/\r\nX: y", "same", "x"),
    (2, None, "same", "x"),
    (3, "http://ü/", "", "x"),
    (4, "u", None, "x"),
    (5, "u", "long é " * 40_000, "x"),
    (6, "u", "a\r\n\r\nWARC/1.1\r\n", "x"),
    (6, "u", "a\r\n\r\nWARC/1.1\r\n", "x"),
    (None, "u", "same", "x"),
    (7, "u", "same", None),
]


def expected(rows, least=0):
    first = {}
    for page, _, html, _ in rows:
        body = (html or "").encode()
        if page is not None and len(body) >= least:
            first[body] = min(page, first.get(body, page))
    for page, _, html, _ in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        to = first.get(body)
        to = None if len(body) < least or to == page else to
        yield page, len(body), digest, "response" if to is None else "revisit", to


def as_set(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    roles = warc.with_roles(pages, least_bytes=least)
    index = warc.write_bundles(roles, str(tmp_path), frame_bytes=300, bundle_bytes=500)
    records = warc.read_bundles(index, with_payload=True, part_bytes=400).collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in records]
    assert as_set(got) == as_set(expected(ROWS, least))
    texts = {r[0]: (r[2] or "").encode() for r in ROWS if r[0] is not None}
    for r in records:
        if r["record_type"] == "response" and r["page_id"] is not None:
            assert bytes(r["payload"]) == texts[r["page_id"]]
    for r in index.collect():
        record = warc.read_record(r["bundle"], r["frame_start"], r["frame_bytes"], r["offset"], r["length"])
        ((_, head, _, _),) = warc.parse_records(record)
        assert warc._page_of(head["WARC-Record-ID"]) == r["page_id"]
        # Readers that know nothing of the seek table read a bundle from start to end.
        with open(r["bundle"], "rb") as f:
            assert len(list(warc.parse_records(zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()))) >= 1


def test_empty_and_damaged(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    records, index = warc.archive(spark, empty, str(tmp_path / "none"))
    assert records.count() == 0 and index.count() == 0
    index = warc.write_bundles(warc.with_roles(spark.createDataFrame(ROWS, SCHEMA)), str(tmp_path))
    name = index.first()["bundle"]
    with open(name, "r+b") as f:
        f.seek(-1, 2)
        f.write(b"\0")
    with pytest.raises(Exception, match="seek table"):
        warc.read_bundles(index).collect()


def test_as_many_tasks_read_as_there_are_parts(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50, "x") for i in range(200)], SCHEMA).repartition(3)
    index = warc.write_bundles(warc.with_roles(pages), str(tmp_path), frame_bytes=300, bundle_bytes=2000)
    records = warc.read_bundles(index, part_bytes=500)
    parts = index.selectExpr("bundle", "floor(frame_start / 500) AS part").distinct().count()
    tasks = records.selectExpr("spark_partition_id() AS task").distinct().count()
    assert records.count() == 200 and parts > 20
    # Partitions are given by hash: not one for each part, but far more than one.
    assert records.rdd.getNumPartitions() == parts and tasks > parts / 2
