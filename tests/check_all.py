"""Run every registered query against its SQL: python tests/check_all.py [sf_dir] [name part ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
parts = sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    .config("spark.sql.session.timeZone", "UTC").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(sf_dir)
oracles, bad = oracle_sql(), 0
for name, fn in queries().items():
    if parts and not any(p in name for p in parts):
        continue
    start = time.time()
    try:
        if name in oracles:
            rows, diff = compare(spark, con, fn, oracles[name], sf_dir)
        else:
            rows, diff = fn(spark, sf_dir).count(), ""
    except Exception as exc:  # noqa: BLE001
        rows, diff = -1, f"{type(exc).__name__}: {exc}"[:1500]
    bad += bool(diff)
    print(f"{'BAD ' if diff else 'ok  '}{name} rows={rows} {time.time() - start:.2f}s {'' if name in oracles else '(no sql)'} {diff}", flush=True)
print("bad:", bad)
