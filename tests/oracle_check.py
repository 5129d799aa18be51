"""Compares each query with its SQL twin. Run as a script for a report:

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, "nan") if math.isnan(value) else (2, repr(value))
    if isinstance(value, int):
        return (2, repr(value))
    if isinstance(value, datetime.datetime):
        return (3, value.isoformat())
    return (4, str(value))


def compare(df, con, sql: str) -> str | None:
    """None if both sides agree on names, types and rows; else what differs."""
    got_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    relation = con.sql(sql)
    want_types = dict(zip(relation.columns, map(str, relation.types)))
    if got_types != want_types:
        diff = {k: (got_types.get(k), want_types.get(k)) for k in got_types.keys() | want_types.keys()
                if got_types.get(k) != want_types.get(k)}
        return f"schema (spark, sql): {diff}"
    names = sorted(got_types)
    got = sorted(tuple(_cell(r[n]) for n in names) for r in df.select(*names).collect())
    order = [relation.columns.index(n) for n in names]
    want = sorted(tuple(_cell(r[i]) for i in order) for r in relation.fetchall())
    if got == want:
        return None
    for g, w in zip(got, want):
        if g != w:
            cells = [(n, a[1], b[1]) for n, a, b in zip(names, g, w) if a != b]
            return f"rows {len(got)} vs {len(want)}; first difference (spark, sql): {cells[:4]}"
    return f"rows {len(got)} vs {len(want)}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tallyloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = local_session(8, spark__ui__showConsoleProgress="false"), connect(sf_dir)
    wrong = []
    for name, build in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            sql = oracle_sql().get(name)
            df = build(spark, sf_dir)
            problem = compare(df, con, sql) if sql else f"no SQL; {df.count()} rows"
        except Exception as e:  # a report, not a gate
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        if problem:
            wrong.append(name)
        print(f"{'ok  ' if not problem else 'BAD '} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(wrong)} differ: {wrong}")


if __name__ == "__main__":
    main()
