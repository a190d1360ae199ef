"""Dev helper: python tools_check.py [sf_dir] [name ...] -> oracle comparison per query."""
import sys, time, json
from candlewick.session import local_session
from candlewick.plans import catalog
from candlewick.plans.oracle_check import duckdb_connection, compare

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
catalog.load_all()
spark = local_session()
con = duckdb_connection(sf)
bad = 0
for n, fn in catalog.QUERIES.items():
    if names and n not in names:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if n in catalog.ORACLES:
            r = compare(df, con, catalog.ORACLES[n])
        else:
            r = {"rows_only": df.count()}
    except Exception as e:
        r = {"error": repr(e)[:600]}
    ok = r.get("match", "rows_only" in r)
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {n:28s} {time.time()-t:6.2f}s {json.dumps(r, default=str)[:1500]}", flush=True)
print("bad:", bad)
