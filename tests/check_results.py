"""Compare registered queries with their SQL check: python tests/check_results.py [folder] [query ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

INPUT_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def checker(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in INPUT_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def differences(df, con, statement: str) -> list[str]:
    """What differs between a DataFrame and a statement: columns, types, rows (exactly, as a bag)."""
    names = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({statement})")
    kinds = {d[0]: str(d[1]) for d in expected.description}
    rows = expected.fetchall()
    listed = {d[0] for d in con.execute(f"SELECT * FROM ({statement}) LIMIT 0").description}
    found = []
    if listed != set(names):
        found.append(f"columns differ: {listed ^ set(names)}")
    for name, kind in df.dtypes:
        ours = {"int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}.get(kind, kind.upper())
        if ours != kinds[name]:
            found.append(f"{name}: {kind} here, {kinds[name]} there")
    ours, theirs = Counter(tuple(r) for r in df.select(*names).collect()), Counter(rows)
    if ours != theirs:
        here, there = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
        found.append(f"rows differ: {sum(ours.values())} here, {sum(theirs.values())} there\n  {here}\n  {there}")
    return found


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, statements = local_session(), checker(folder), oracle_sql()
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        df = query(spark, folder)
        if name not in statements:
            print(f"{name}: {df.count()} rows, no check ({time.time() - start:.1f} s)", flush=True)
            continue
        found = differences(df, con, statements[name])
        print(f"{name}: {'ok' if not found else found} ({time.time() - start:.1f} s)", flush=True)


if __name__ == "__main__":
    main()
