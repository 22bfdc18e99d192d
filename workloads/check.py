"""Run queries against their SQL answers: ``python -m workloads.check [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from payloom.session import build_session
from workloads import QUERIES_AND_ORACLES


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (a != a and b != b) or abs(a - b) <= 1e-9 * max(abs(a), abs(b))
    return a == b and type(a) is type(b)


def compare(spark, con, sf, name, fn, sql):
    start = time.time()
    df = fn(spark, sf)
    got = rows_of(df.columns, df.collect())
    took = time.time() - start
    if sql is None:
        return f"rows-only {len(got)}", took, True
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    want = rows_of(columns, res.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}", took, False
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}; got {got[:2]} want {want[:2]}", took, False
    for g, w in zip(got, want):
        if not all(map(same, g, w)):
            return f"first difference\n   got  {g}\n   want {w}", took, False
    return f"ok {len(got)}", took, True


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    queries, oracles = QUERIES_AND_ORACLES()
    names = argv[1:] or list(queries)
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = 0
    for name in names:
        try:
            note, took, ok = compare(spark, con, sf, name, queries[name], oracles.get(name))
        except Exception as error:  # keep going, report at the end
            note, took, ok = f"error {str(error)[:600]}", 0.0, False
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {name} {took:.2f}s {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
