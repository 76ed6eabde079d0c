"""Run registered queries and compare each with its DuckDB SQL (sorted rows).

    python scripts/check_sql.py [sf_dir] [name ...]
    EXACT=1 python scripts/check_sql.py ...     # compare floats exactly

Floats are rounded to 6 decimals unless EXACT is set; columns are matched by
name, rows compared as sorted multisets.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from reportlake import get_session  # noqa: E402
from reportlake.plans.checks import CHECKS, SQL  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("EXACT") else round(v, 6)
    return v


def key(row):
    return tuple((0, "") if v is None else (1, str(norm(v))) for v in row)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(CHECKS)
    spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    ok_all = True
    for name in names:
        t0 = time.time()
        try:
            df = CHECKS[name](spark, sf_dir)
            cols = df.columns
            got = [tuple(norm(v) for v in r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            ok_all = False
            continue
        dt = time.time() - t0
        if name not in SQL:
            print(f"{name:24s} rows={len(got)} (no SQL) {dt:.1f}s")
            continue
        res = con.execute(SQL[name])
        ecols = [d[0] for d in res.description]
        exp = [tuple(norm(v) for v in r) for r in res.fetchall()]
        if sorted(cols) != sorted(ecols):
            print(f"{name:24s} COLUMNS differ spark={cols} sql={ecols}")
            ok_all = False
            continue
        idx = [ecols.index(c) for c in cols]
        exp = [tuple(r[i] for i in idx) for r in exp]
        g, e = sorted(got, key=key), sorted(exp, key=key)
        same = g == e
        ok_all &= same
        print(f"{name:24s} {'OK ' if same else 'DIFF'} rows={len(got)}/{len(exp)} {dt:.1f}s")
        if not same:
            shown = 0
            for a, b in zip(g, e):
                if a != b:
                    print("   spark", a, "\n   sql  ", b)
                    shown += 1
                    if shown >= 3:
                        break
    sys.exit(0 if ok_all else 1)


if __name__ == "__main__":
    main()
