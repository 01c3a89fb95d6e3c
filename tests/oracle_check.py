"""Compare every registered query with its DuckDB twin, as the driver does:
row count, column names and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    s_hash, s_lines = digest(s_cols, s_rows)
    d_hash, d_lines = digest(d_cols, d_rows)
    ok = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows) and s_hash == d_hash
    res["status"] = "match" if ok else "MISMATCH"
    if not ok:
        if sorted(s_cols) != sorted(d_cols):
            res["cols"] = {"spark_only": sorted(set(s_cols) - set(d_cols)),
                           "duck_only": sorted(set(d_cols) - set(s_cols))}
        a, b = set(s_lines), set(d_lines)
        res["spark_only"] = sorted(a - b)[:3]
        res["duck_only"] = sorted(b - a)[:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(argv[2:])
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            res = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as exc:  # report and continue
            res = {"query": name, "status": "ERROR", "error": str(exc)[:800]}
        bad += res["status"] not in ("match", "no-oracle")
        print(json.dumps(res, default=str), flush=True)
    print(json.dumps({"failed": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
