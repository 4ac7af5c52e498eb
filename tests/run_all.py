"""Run every query against its SQL twin: ``python tests/run_all.py <table folder> [name ...]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from checking import differences, duck  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "OFF")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = duck(sf_dir), oracle_sql()
    failed = 0
    for name, build in queries().items():
        if names and name not in names:
            continue
        begun = time.time()
        try:
            df = build(spark, sf_dir)
            if name in sql:
                problems = differences(df, connection, sql[name])
                outcome = "ok" if not problems else "; ".join(problems)
            else:
                problems, outcome = [], f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # report and go on to the next query
            problems = [str(error)]
            outcome = f"{type(error).__name__}: {str(error).splitlines()[0][:300]}"
        failed += bool(problems)
        print(f"{time.time() - begun:7.2f}s  {name:26s} {outcome}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
