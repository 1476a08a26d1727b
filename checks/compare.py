"""Runs queries against their SQL: python -m checks.compare FOLDER [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from textquarry.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("" if row[i] is None else str(row[i]) for i in order) for row in rows)


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(**{"spark.ui.showConsoleProgress": "false"})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = []
    for name in names:
        try:
            t0 = time.time()
            df = QUERIES[name](spark, folder)
            got = df.collect()
            t1 = time.time()
            if ORACLES.get(name) is None:
                print(f"{name}: {len(got)} rows, no SQL, spark {t1 - t0:.1f}s", flush=True)
                continue
            rel = con.sql(ORACLES[name])
            want = rel.fetchall()
            t2 = time.time()
            types = dict(zip(rel.columns, map(str, rel.types)))
            a, b = canonical(df.columns, got), canonical(rel.columns, want)
            ok = sorted(df.columns) == sorted(rel.columns) and a == b
            print(f"{name}: {'ok' if ok else 'DIFFERS'} {len(a)}/{len(b)} spark {t1 - t0:.1f}s duckdb {t2 - t1:.1f}s", flush=True)
            if not ok:
                bad.append(name)
                print("   ", dict(df.dtypes), types)
                only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
                print("    spark :", [tuple(x[:80] for x in r) for r in only_a])
                print("    duckdb:", [tuple(x[:80] for x in r) for r in only_b])
        except Exception as problem:  # report and go on to the next query
            bad.append(name)
            print(f"{name}: FAILED {type(problem).__name__} {str(problem)[:600]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
