"""Compare registered Spark queries with their DuckDB SQL: row count,
column names and an order-insensitive hash of the values as text.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _digest(rows: list[tuple]) -> str:
    lines = sorted("\x1f".join("\\N" if v is None else str(v) for v in r) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    from pyspark.sql import functions as F
    cols = sorted(df.columns)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return cols, [tuple(r) for r in text.collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    text = con.sql("select " + ", ".join(f'cast("{c}" as varchar) as "{c}"' for c in cols)
                   + f" from ({sql}) q")
    return cols, text.fetchall()


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    s_cols, s_rows = spark_rows(fn(spark, sf_dir))
    t1 = time.time()
    d_cols, d_rows = duck_rows(con, sql)
    return {
        "name": name, "rows": (len(s_rows), len(d_rows)), "cols_match": s_cols == d_cols,
        "hash_match": _digest(s_rows) == _digest(d_rows), "spark_sec": round(t1 - t0, 2),
        "cols": (s_cols, d_cols),
    }


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as entry
    from starloom.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:28s} NO ORACLE")
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # report and continue
            bad += 1
            print(f"{name:28s} ERROR {type(exc).__name__}: {str(exc)[:300]}")
            continue
        ok = r["rows"][0] == r["rows"][1] and r["cols_match"] and r["hash_match"]
        bad += not ok
        extra = "" if r["cols_match"] else f" cols={r['cols']}"
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={r['rows']} hash={r['hash_match']} "
              f"t={r['spark_sec']}s{extra}")
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
