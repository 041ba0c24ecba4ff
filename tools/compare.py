"""Run registered queries next to their oracle SQL and compare rows.

    python tools/compare.py [sf_dir] [name-prefix ...]
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textsignal.plans import ORACLES, QUERIES  # noqa: E402
from textsignal.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel(os.environ.get("LOG", "OFF"))
    bad = []
    for name in sorted(QUERIES):
        if prefixes and not name.startswith(prefixes):
            continue
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf)
            names = sorted(df.columns)
            rows = [tuple(cell(r[c]) for c in names) for r in df.collect()]
            types = {f.name: f.dataType.simpleString() for f in df.schema}
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: {str(e)[:600]}", flush=True)
            bad.append(name)
            continue
        t1 = time.time()
        if name not in ORACLES:
            print(f"rows  {name}: {len(rows)} rows {t1 - t0:.1f}s", flush=True)
            continue
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        try:
            res = con.execute(ORACLES[name])
            dnames = [d[0] for d in res.description]
            dtypes = {d[0]: str(d[1]) for d in res.description}
            order = [dnames.index(c) for c in names] if sorted(dnames) == names else None
            drows = [tuple(cell(r[i]) for i in order) for r in res.fetchall()] if order else None
        except Exception as e:  # noqa: BLE001
            print(f"SQL!  {name}: {str(e)[:500]}", flush=True)
            bad.append(name)
            continue
        t2 = time.time()
        if order is None:
            print(f"COLS  {name}: {names} vs {sorted(dnames)}", flush=True)
            bad.append(name)
            continue
        rows.sort()
        drows.sort()
        if rows == drows:
            print(f"ok    {name}: {len(rows)} rows spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s | {types} {list(dtypes.values())}" if os.environ.get("V") else f"ok    {name}: {len(rows)} rows spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s", flush=True)
        else:
            bad.append(name)
            print(f"DIFF  {name}: {len(rows)} vs {len(drows)} rows", flush=True)
            shown = 0
            rs, ds = set(rows), set(drows)
            a = [r for r in rows if r not in ds]
            b = [r for r in drows if r not in rs]
            print("   ", len(a), len(b))
            for x, y in zip(a[:3], b[:3]):
                for c, u, v in zip(names, x, y):
                    if u != v:
                        k = next((i for i, (p, q) in enumerate(zip(u, v)) if p != q), min(len(u), len(v)))
                        print(f"      {c}: {u[max(0, k - 30):k + 60]!r} | {v[max(0, k - 30):k + 60]!r}")
                shown += 1
            if not a or not b:
                print("      only one side:", (a or b)[:2])
    print("BAD:", bad)


if __name__ == "__main__":
    main()
