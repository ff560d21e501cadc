"""Side-by-side run of a query and its SQL; also a command: ``python tests/oracle.py DIR [names]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6g}" if v != int(v) else str(int(v))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(cell(x)) for x in v) + "]"
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is None, x or "") for x in r))


def compare(spark, folder: str, run, sql: str | None, con=None):
    """(rows, problem or None)."""
    df = run(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(rows), None
    con = con or connect(folder)
    cur = con.execute(sql)
    expected_cols = [d[0] for d in cur.description]
    expected = cur.fetchall()
    a_cols, a = normal(df.columns, rows)
    b_cols, b = normal(expected_cols, expected)
    if a_cols != b_cols:
        return len(rows), f"columns {a_cols} != {b_cols}"
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        return len(rows), f"rows {len(a)} vs {len(b)}; spark only {only_a}; sql only {only_b}"
    return len(rows), None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from hustings.session import local_session
    folder, names = sys.argv[1], sys.argv[2:]
    spark, con, sql = local_session(), connect(folder), oracle_sql()
    bad = 0
    for name, run in queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            rows, problem = compare(spark, folder, run, sql.get(name), con)
        except Exception as e:  # report and go on with the next query
            rows, problem = -1, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        kind = "sql" if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind:4} {name:28} {rows:7} rows "
              f"{time.time() - start:6.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
