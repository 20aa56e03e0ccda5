"""Side-by-side check of the registered queries against DuckDB on the same files."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def check(spark, con, sf_dir: str, name: str, query, sql: str | None) -> str:
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return "ok" if rows else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got, want = canonical(df.columns, rows), canonical(columns, expected)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else "ok"


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as e
    from bloomline.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    oracles = e.oracle_sql()
    for name, query in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            verdict = check(spark, con, sf_dir, name, query, oracles.get(name))
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += verdict != "ok"
        print(f"{name:28s} {time.time() - start:6.2f}s {'S' if name in oracles else 'R'} {verdict[:900]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
