"""Run every registered query against its oracle: python -m tests.run_oracle [sf_dir] [names...]"""

import sys
import time

from __spark_entry__ import oracle_sql, queries
from sojourn.session import get_session
from tests.harness import compare, duck

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = get_session()
con = duck(sf)
sql = oracle_sql()
bad = 0
for name, fn in queries().items():
    if only and name not in only:
        continue
    t0 = time.time()
    try:
        if name in sql:
            ok, msg = compare(fn(spark, sf), con, sql[name])
        else:
            ok, msg = True, f"{fn(spark, sf).count()} rows (no oracle)"
    except Exception as e:  # report and continue
        ok, msg = False, f"{type(e).__name__}: {str(e)[:300]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {name:24s} {msg}  [{time.time() - t0:.1f}s]", flush=True)
print("failures:", bad)
