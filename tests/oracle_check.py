"""Side-by-side run of the named queries and their SQL: ``python -m tests.oracle_check [folder] [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as contract
from ringspan.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def normalised(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, sorted; floats to nine digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None if equal, else what differs."""
    df = contract.queries()[name](spark, folder)
    got = normalised(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = normalised(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    return None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(folder)
    for name in sys.argv[2:] or contract.queries():
        began = time.time()
        if name in contract.oracle_sql():
            try:
                outcome = compare(spark, con, folder, name) or "equal"
            except Exception as error:
                outcome = f"{type(error).__name__}: {error}"[:300]
        else:
            outcome = f"rows only: {contract.queries()[name](spark, folder).count()}"
        print(f"{name:32s} {time.time() - began:6.2f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main()
