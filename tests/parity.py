"""Run registered queries beside their DuckDB SQL and compare all values.

    python tests/parity.py [sf] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    return v


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, folder: str, name: str, con=None) -> str | None:
    """None when equal, else what differs."""
    import __spark_entry__ as entry

    fn, sql = entry.queries()[name], entry.oracle_sql().get(name)
    got = fn(spark, folder)
    cols = sorted(got.columns)
    rows = sorted((tuple(cell(r[c]) for c in cols) for r in got.collect()), key=repr)
    if sql is None:
        return None if rows else "no rows"
    cur = (con or duck(folder)).execute(sql)
    names = [x[0] for x in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} vs {sorted(names)}"
    at = [names.index(c) for c in cols]
    want = sorted((tuple(cell(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    if rows == want:
        return None if rows else "EMPTY"
    a, b = [r for r in rows if r not in set(want)][:3], [r for r in want if r not in set(rows)][:3]
    return f"{len(rows)} vs {len(want)} rows, cols {cols}\n  spark only {a}\n  duck only  {b}"


def main() -> None:
    import __spark_entry__ as entry
    from grantspark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sf}"
    con = duck(folder)
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for n in names:
        t = time.time()
        try:
            msg = compare(spark, folder, n, con)
        except Exception as e:  # noqa: BLE001
            msg = f"{type(e).__name__}: {str(e)[:1500]}"
        if msg:
            bad += 1
        print(f"{'ok ' if not msg else 'BAD'} {n} {time.time() - t:.1f}s {msg or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
