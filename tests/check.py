"""Compare registered queries with their SQL on DuckDB: ``python tests/check.py [sf] [names]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    names, rows = df.columns, [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return f"rows={len(rows)} spark={t1 - t0:.1f}s (no SQL)", len(rows) > 0
    rel = con.execute(sql)
    want_names = [d[0] for d in rel.description]
    want = rel.fetchall()
    t2 = time.time()
    note = f"rows={len(rows)} spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s"
    if sorted(names) != sorted(want_names):
        return f"{note} COLUMNS {sorted(names)} vs {sorted(want_names)}", False
    a, b = canon_rows(names, rows), canon_rows(want_names, want)
    if a == b:
        return note, len(a) > 0
    extra, lacking = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"{note} want={len(b)}\n   columns {sorted(names)}\n   spark {extra}\n   duck  {lacking}", False


def main(argv):
    import __spark_entry__ as entry
    from cairn.session import local_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    chosen = [n for n in queries if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    bad = 0
    for name in chosen:
        try:
            note, ok = compare(spark, con, sf_dir, queries[name], sqls.get(name))
        except Exception as e:  # report and go on
            note, ok = f"{type(e).__name__}: {str(e)[:1500]}", False
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{len(chosen)} queries, {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
