"""Times the headline jobs and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES, Context  # noqa: E402
from tokenloom.settings import tune  # noqa: E402

HEADLINES = (
    "t1_seed_dictionary",
    "t7_preload",
    "t8_reconcile_summary",
    "q1_user_bulk_hit",
    "q1_user_bulk_miss",
    "q2_user_info_bulk_hit",
    "q3_user_bankcard_bulk_hit",
    "q4_user_product_bulk",
    "q5_application_bulk_hit",
    "q5_application_bulk_miss",
    "q6_loan_bulk",
    "q7_id_mapping",
    "q5_application_incremental",
    "q6_loan_incremental",
    "r4_debounce",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    tune(spark)
    context = Context(spark, folder)
    context.dictionary.count()  # the stored dictionary of real life

    seconds, rows_per_min = {}, {}
    for name in HEADLINES:
        started = time.time()
        counted = Observation(name)
        df = QUERIES[name][0](context).observe(counted, F.count(F.lit(1)).alias("rows"))
        df.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        rows_per_min[name] = round(counted.get["rows"] / seconds[name] * 60)
    print(
        json.dumps(
            {
                "metric": "bulk_and_incremental_sync_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_min": rows_per_min,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
