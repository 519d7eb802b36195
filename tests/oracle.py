"""Run registered queries beside their SQL twins: ``python tests/oracle.py [prefix ...]``."""
from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return "D" + format(v.normalize(), "f")
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return f"{type(v).__name__}:{v}"


def normalise(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(name, spark, sf_dir, con, queries, oracles):
    t0 = time.time()
    df = queries[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - t0
    if name not in oracles:
        return ("rows", len(rows), took, "")
    cur = con.execute(oracles[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return ("FAIL", len(rows), took, f"columns {sorted(df.columns)} vs {sorted(cols)}")
    a, b = normalise(rows, df.columns), normalise(want, cols)
    if a == b:
        return ("ok" if a else "EMPTY", len(rows), took, "")
    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
    return ("FAIL", len(rows), took, f"rows {len(a)} vs {len(b)} {sorted(cols)} {diff}")


def main(prefixes):
    import __spark_entry__ as entry
    from lakeops.session import build_session
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("lakeops-oracle", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = connect(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in queries:
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            status, n, took, note = compare(name, spark, sf_dir, con, queries, oracles)
        except Exception as exc:  # keep going: the list of failures is the point
            status, n, took, note = "ERROR", 0, 0.0, str(exc)[:700]
        bad += status in ("FAIL", "ERROR", "EMPTY")
        if status != "ok" or os.environ.get("VERBOSE"):
            print(f"{status:5} {name} rows={n} {took:.2f}s {note}", flush=True)
    print(f"{bad} not ok of {len(queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
