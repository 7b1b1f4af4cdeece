"""Command line: python tests/run_oracles.py SF_DIR [query ...] compares queries with oracles."""

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry
import harness
from pyspark.sql import SparkSession

# one machine only: a temporary folder is shared by all tasks here
FOLDER = tempfile.mkdtemp(prefix="work-")

if __name__ == "__main__":
    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", FOLDER)
        .config("spark.checkpoint.dir", FOLDER)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = harness.connect(sf)
    qs, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                note = harness.difference(df, con, oracles[name]) or "ok"
            else:
                note = f"rows-only {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            note = "ERROR " + str(e)[:600]
        failed += note != "ok" and not note.startswith("rows-only")
        print(f"{name:28s} {time.time() - t:6.1f}s  {note}", flush=True)
    print("failed:", failed)
