"""Holds queries against their SQL, run by DuckDB over the same tables."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    return float(value) if type(value).__name__ == "Decimal" else value


def rows(columns: list[str], found: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def difference(spark, con, sf_dir: str, name: str, query, sql: str) -> str:
    """Empty if query and SQL agree in columns and rows."""
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows; {[x for x in got if x not in set(want)][:2]} {[x for x in want if x not in set(got)][:2]}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} rows differ: {bad[:2]}" if bad else ""


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    from evidar.session import local_session

    sf_dir = sys.argv[1]
    spark, con = local_session(4), connect(sf_dir)
    sql, chosen = entry.oracle_sql(), sys.argv[2:]
    for name, query in entry.queries().items():
        if (name in chosen) if chosen else not name.startswith(("op", "pipeline")):
            began = time.time()
            try:
                said = difference(spark, con, sf_dir, name, query, sql[name]) if name in sql else f"rows only: {query(spark, sf_dir).count()}"
            except Exception as e:  # noqa: BLE001
                said = f"{type(e).__name__}: {str(e)[:400]}"
            print(f"{name}: {said or 'same'} ({time.time() - began:.1f} s)", flush=True)
