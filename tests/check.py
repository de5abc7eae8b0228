"""Run registered queries against their SQL checks: python tests/check.py [name ...]."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def norm(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int,)):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    if type(value).__name__ == "Decimal":
        return norm(float(value))
    if type(value).__name__ == "Row":
        return tuple(norm(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, norm(v)) for k, v in value.items()))
    return value


def compare(spark_df, con, sql: str):
    """(ok, message): same column names and the same multiset of rows."""
    cols = sorted(spark_df.columns)
    left = Counter(tuple(norm(v) for v in r) for r in spark_df.select(*[f"`{c}`" for c in cols]).collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != cols:
        return False, f"columns {sorted(set(cols) ^ set(names))}"
    order = [names.index(c) for c in cols]
    right = Counter(tuple(norm(r[i]) for i in order) for r in rel.fetchall())
    n1, n2 = sum(left.values()), sum(right.values())
    if left == right:
        return True, f"{n1} rows"
    only_left, only_right = left - right, right - left
    key = lambda r: tuple(str(x) for x in r)
    return False, (
        f"rows {n1} vs {n2}; {sum(only_left.values())} only Spark, {sum(only_right.values())} only SQL\n"
        f"   cols  {cols}\n"
        + "".join(f"   spark {r}\n" for r in sorted(only_left, key=key)[:4])
        + "".join(f"   sql   {r}\n" for r in sorted(only_right, key=key)[:4])
    )


def main(names: list[str]) -> int:
    from access_spark.session import local_session
    from catalog import ORACLES, QUERIES

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    todo = [n for n in QUERIES if not names or any(n == x or (x.endswith("*") and n.startswith(x[:-1])) for x in names)]
    for name in todo:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                ok, message = compare(df, con, ORACLES[name])
            else:
                ok, message = True, f"{df.count()} rows (no SQL)"
        except Exception as exc:  # noqa: BLE001
            ok, message = False, f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:40s} {time.time() - start:6.2f}s {message}", flush=True)
        spark.catalog.clearCache()
    print(f"{len(todo) - bad}/{len(todo)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
