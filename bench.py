"""Times the headline queries; prints one JSON line.

Each query is run to completion into a discarding sink: once to warm up, then three
times, and the median is reported.  ``BENCH_SF_DIR`` names the tables and
``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from catalog import QUERIES  # noqa: E402

HEADLINE = [
    "b08_sft_table",
    "b15_orpo_table",
    "c02_encode",
    "c06_packing",
    "e02_length_summary",
    "f02_corpus_bleu",
    "f03_rouge_n",
    "f04_rouge_l",
    "f05_rouge_lsum",
    "f07_bertscore",
    "g01_generation",
    "i01_moving_average",
    "i02_exponential_average",
    "i11_curve_table",
    "j01_dpo_metrics",
    "j02_orpo_metrics",
    "j03_token_metrics",
    "k01_live_log",
]
RUNS = 3


def timed(spark: SparkSession, name: str, folder: str) -> float:
    begun = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names or HEADLINE:
        timed(spark, name, folder)
        seconds[name] = round(median(timed(spark, name, folder) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
