"""Run registered queries next to their SQL and compare the rows.

usage: python tools/check.py [sf] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from revrank.registry import ORACLES, QUERIES  # noqa: E402
from revrank.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "FLOAT": "float",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return float(f"{v:.9g}") + 0.0
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    out = [tuple(canon(r[n]) for n in order) for r in rows]
    return sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = []
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            got = df.collect()
            took = time.time() - start
            if name not in ORACLES:
                print(f"{'rows' if got else 'EMPTY':6} {name:28} {len(got):8} {took:6.1f}s", flush=True)
                continue
            rel = con.execute(ORACLES[name])
            cols = [c[0] for c in rel.description]
            want = rel.fetchall()
            a, b = rows_of(df.columns, got), rows_of(cols, want)
            ok = a == b and sorted(df.columns) == sorted(cols)
            kinds = {c: t for c, t in df.dtypes}
            for c, t in zip(cols, [str(x[1]) for x in rel.description]):
                if KINDS.get(t, t) != kinds.get(c):
                    print(f"   type of {c}: {kinds.get(c)} / {t}")
            print(f"{'ok' if ok else 'DIFF':6} {name:28} {len(got):8} {took:6.1f}s", flush=True)
            if not ok:
                bad.append(name)
                print("   cols", sorted(df.columns), sorted(cols), len(got), len(want))
                for x, y in [(x, y) for x, y in zip(a, b) if x != y][:3]:
                    print("   spark", x, "\n   sql  ", y)
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"ERROR  {name:28} {str(e)[:700]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
