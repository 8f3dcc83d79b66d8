"""Run every registered query against its oracle: python tests/run_oracles.py [sf_dir] [key ...]"""

import os
import sys
import time

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from leadflow.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = local_session(8)
if os.environ.get("ORACLE_TZ"):  # prove results do not depend on the session zone
    spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
con = duck(sf)
from leadflow.plans import catalog  # noqa: E402

catalog.load_all()
qs, orc = (catalog.QUERIES, catalog.ORACLES) if not os.environ.get("ORACLE_ALL") else (E.queries(), E.oracle_sql())
bad = 0
for k, fn in qs.items():
    if only and k not in only:
        continue
    t0 = time.time()
    try:
        df = fn(spark, sf)
        if k in orc:
            ok, msg = compare(df, con, orc[k])
        else:
            n = df.count()
            ok, msg = True, f"(no oracle) {n} rows"
    except Exception as e:  # noqa: BLE001
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {k:32s} {time.time()-t0:6.2f}s {msg}", flush=True)
print(f"{len(qs)} queries, {bad} bad")
