"""Time every registered query: one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores), BENCH_QUERIES (comma separated).
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallgrass import build_session
from tallgrass.catalog import QUERIES


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM paths and the Python workers before anything is timed
    QUERIES["agg_merge_partials"](spark, folder).write.format("noop").mode("overwrite").save()
    QUERIES["ml_linear_score"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        begin = time.perf_counter()
        try:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begin, 3)
        except Exception as error:  # a failed query is reported, the others still run
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
        print(name, seconds.get(name, failed.get(name)), file=sys.stderr, flush=True)
    result = {
        "metric": "total seconds over all registered queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
