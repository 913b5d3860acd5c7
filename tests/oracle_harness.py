"""Run registered Spark plans against their DuckDB oracle SQL.

Used by ``tests/test_oracle.py`` and runnable as a script::

    python tests/oracle_harness.py [sf_dir] [query ...]

The comparison is order-insensitive: same column names, same row count and
the same multiset of rows (floats compared after rounding to 9 places; NaN
equals NaN).
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if math.isinf(v):
            return "Inf" if v > 0 else "-Inf"
        return round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
                 "array<string>": "VARCHAR[]", "float": "FLOAT", "smallint": "SMALLINT"}


def type_mismatches(sdf, description) -> list[str]:
    duck_types = {d[0]: str(d[1]) for d in description}
    out = []
    for f in sdf.schema.fields:
        st = f.dataType.simpleString()
        dt = duck_types.get(f.name)
        if SPARK_TO_DUCK.get(st, st.upper()) != dt:
            out.append(f"{f.name}: spark {st} vs duck {dt}")
    return out


def compare(spark, name: str, plan, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = plan(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    res = {"name": name, "spark_sec": round(t1 - t0, 2), "duck_sec": round(t2 - t1, 2),
           "rows": (len(s_rows), len(d_rows)),
           "types": type_mismatches(sdf, cur.description)}
    if sorted(s_cols) != sorted(d_cols):
        res["ok"] = False
        res["why"] = f"columns differ: spark={s_cols} duck={d_cols}"
        return res
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    res["ok"] = sc == dc
    if not res["ok"]:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        res["why"] = f"cols={order} spark_only={only_s} duck_only={only_d}"
    return res


def main(argv):
    from insight.session import local_session
    from insight.plans.registry import load_all
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    plans, sqls = load_all()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(plans):
        if name not in sqls:
            df = plans[name](spark, sf_dir)
            print(f"{name:40s} NO-ORACLE rows={df.count()}")
            continue
        try:
            r = compare(spark, name, plans[name], sqls[name], sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(f"{name:40s} {'OK ' if r['ok'] else 'BAD'} rows={r.get('rows')} "
              f"spark={r.get('spark_sec')}s duck={r.get('duck_sec')}s {r.get('why', '')}"
              + (f" TYPES {r['types']}" if r.get("types") else ""))
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
