import duckdb
import pytest

from checks.compare import canonical
from checks.oracles import ORACLES
from checks.queries import QUERIES

DUPLICATES = {
    "a11_dedup_job_files": lambda rows: rows[0]["duplicates"],
    "d13_dedup_job": lambda rows: rows[0]["duplicates"],
    "d14_inline_marking": lambda rows: sum(bool(r["is_duplicate"]) for r in rows),
    "d11_filter_duplicates": lambda rows: -len(rows),
    "i6_duplicate_stats": lambda rows: rows[0]["duplicate_count"],
    "r3_stream_chunks": lambda rows: sum(bool(r["is_duplicate"]) for r in rows),
}


def collected(spark, sf, name):
    df = QUERIES[name](spark, sf)
    return df.columns, df.collect()


@pytest.mark.parametrize("name", ["a11_dedup_job_files", "d11_filter_duplicates", "d13_dedup_job", "d14_inline_marking", "i6_duplicate_stats", "i8_summary", "i12_headline", "r3_stream_chunks"])
def test_near_duplicates_as_shipped(spark, sf, name):
    columns, rows = collected(spark, sf, f"{name}_near")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(ORACLES[f"{name}_near"])
    assert canonical(columns, rows) == canonical(want.columns, want.fetchall())
    if name in DUPLICATES:
        count = DUPLICATES[name]
        assert count(rows) > count(collected(spark, sf, name)[1])
