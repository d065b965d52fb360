"""Local twin of the driver's correctness gate: run each registered Spark query
and its DuckDB SQL on the same parquet tables and compare row count, column
names and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [--plain] [name ...]

``--plain`` uses a session with Spark's defaults (only the UI off), as an
outside caller would build it; ``--tz ZONE`` sets the session time zone
(results must not depend on it).
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (int,)):
        return f"{float(v):.6f}"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def main():
    import duckdb
    import __spark_entry__ as entry
    from trafficlens.session import build_session

    args = sys.argv[1:]
    plain = "--plain" in args
    tz = None
    if "--tz" in args:
        tz = args[args.index("--tz") + 1]
        args = [a for a in args if a not in ("--tz", tz)]
    args = [a for a in args if a != "--plain"]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    if plain:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    if tz:
        spark.conf.set("spark.sql.session.timeZone", tz)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    ok = bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(ex).__name__}: {str(ex)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(rows)} rows ({dt:.1f}s), no oracle")
            continue
        try:
            cur = con.execute(sqls[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(ex)[:400]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        same = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        if same:
            ok += 1
            print(f"OK   {name}: {len(rows)} rows ({dt:.1f}s)")
        else:
            bad += 1
            print(f"FAIL {name}: cols {sorted(cols)} vs {sorted(ocols)}; rows {len(rows)} vs {len(orows)}")
            s1, s2 = set(l1), set(l2)
            print("   spark only:", sorted(s1 - s2)[:3])
            print("   duck  only:", sorted(s2 - s1)[:3])
    print(f"{ok} ok, {bad} failed")
    spark.stop()


if __name__ == "__main__":
    main()
