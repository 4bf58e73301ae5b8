"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_SHARED_DIR (folder
for stored steps, spark.checkpoint.dir; a temporary one by default).
Every query is run once to warm up and then timed; the result is consumed by the noop sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardledger import catalog  # noqa: E402
from cardledger.session import job_folder  # noqa: E402

HEADLINE = ["post_daily", "interest_calc", "transaction_report", "statements", "auth_sequential"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("cardledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="cardledger-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = catalog.load()
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    seconds: dict[str, float] = {}
    for name in chosen:
        for timed in (False, True):
            begin = time.perf_counter()
            with job_folder(spark):
                queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if timed:
                seconds[name] = round(time.perf_counter() - begin, 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
