"""Compare every registered query with its SQL twin: python tests/check_all.py [data folder] [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import connect, differences  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from usertide.catalog import ORACLES, QUERIES  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                found = differences(df, con, ORACLES[name])
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if found else 'ok  '} {kind} {time.time() - start:6.2f}s {name}", flush=True)
        for line in found[:4]:
            print("      ", line)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
