"""Check every query against its SQL at one scale: ``python tests/run_checks.py FOLDER [NAME...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from catalog import ORACLES, QUERIES  # noqa: E402
from tests.compare import database, difference  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = database(folder)
    failed = 0
    for name in names or QUERIES:
        begun = time.time()
        try:
            result = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = difference(result, db.sql(ORACLES[name]))
            else:
                problem = None if result.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - begun:6.1f}s  {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
