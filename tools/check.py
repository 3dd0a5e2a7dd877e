"""Compare registered queries with their SQL checks: check.py [--sf DIR] [--no-sql] [name-prefix ...]"""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def norm(v):
    if isinstance(v, float):
        return ("nan" if math.isnan(v) else float(v), "f")
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, int):
        return v
    return repr(v)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--area")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    import duckdb

    from rfspark.session import local_session

    if args.area:
        mods = [importlib.import_module(f"rfspark.plans.{a}") for a in args.area.split(",")]
        queries, oracle = {}, {}
        for m in mods:
            queries |= m.QUERIES
            oracle |= m.ORACLE
    else:
        from rfspark.plans import registry

        queries, oracle = registry.queries(), registry.oracle_sql()
    spark = local_session("8", "check")
    bad = 0
    for name, fn in queries.items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        t0 = time.time()
        try:
            df = fn(spark, args.sf)
            cols = sorted(df.columns)
            got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
            t1 = time.time()
            types = {f.name: f.dataType.simpleString() for f in df.schema}
            if name not in oracle:
                print(f"rows  {name}: {len(got)} rows {t1 - t0:.2f}s", flush=True)
                continue
            con = duckdb.connect()
            for t in TABLES:
                con.execute(f"create view {t} as select * from '{args.sf}/{t}.parquet'")
            cur = con.execute(oracle[name])
            names = [d[0] for d in cur.description]
            dtypes = {d[0]: str(d[1]) for d in cur.description}
            order = sorted(range(len(names)), key=lambda k: names[k])
            want = sorted((tuple(norm(r[k]) for k in order) for r in cur.fetchall()), key=repr)
            t2 = time.time()
            if sorted(names) != cols:
                bad += 1
                print(f"COLS  {name}: spark {cols} sql {sorted(names)}", flush=True)
            elif got != want:
                bad += 1
                gs, ws = set(got), set(want)
                print(f"DIFF  {name}: spark {len(got)} sql {len(want)} rows; {cols}")
                print("   only spark", sorted(gs - ws, key=repr)[:3])
                print("   only sql  ", sorted(ws - gs, key=repr)[:3], flush=True)
            else:
                odd = [(c, types[c], dtypes[c]) for c in cols if not _alike(types[c], dtypes[c])]
                print(f"ok    {name}: {len(got)} rows spark {t1 - t0:.2f}s sql {t2 - t1:.2f}s {odd or ''}", flush=True)
        except Exception as e:
            bad += 1
            print(f"FAIL  {name}: {str(e)[:1500]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print("bad:", bad)
    spark.stop()


def _alike(s, d):
    d = d.upper()
    return {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT"}.get(s) == d


if __name__ == "__main__":
    main()
