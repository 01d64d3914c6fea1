"""Run every registered query against its oracle: python tests/run_oracle.py [sf_dir] [names...]"""

import sys
import time

sys.path.insert(0, ".")

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from eventide.session import build_session  # noqa: E402
from tests.oracle_harness import compare, duck  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(queries())
spark = build_session(master="local[8]")
con = duck(sf)
sqls = oracle_sql()
for name in names:
    t0 = time.time()
    df = queries()[name](spark, sf)
    if name in sqls:
        ok, msg = compare(df, sqls[name], sf, con)
    else:
        ok, msg = True, f"no oracle; {df.count()} rows"
    print(f"{'OK ' if ok else 'BAD'} {name}: {msg} ({time.time() - t0:.1f}s)", flush=True)
