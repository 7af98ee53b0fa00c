"""Run checked queries on Spark and DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return "\0" if v is None else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, text):
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(text)
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if got == want:
        return None
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return f"{len(got)} rows vs {len(want)}; only spark {only_got}; only sql {only_want}"


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from freightloom.session import local_session

    spark = local_session(8)
    con = duck(folder)
    qs, oracles = queries(), oracle_sql()
    bad = 0
    for name, run in qs.items():
        if names and not any(n in name for n in names):
            continue
        begin = time.time()
        try:
            df = run(spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                n = ""
            else:
                problem, n = None, f"rows only: {df.count()}"
        except Exception as exc:  # noqa: BLE001
            problem, n = f"{type(exc).__name__}: {str(exc)[:1500]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:40s} {time.time() - begin:6.2f}s {n} {problem or ''}", flush=True)
    print(f"{len(qs)} registered, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
