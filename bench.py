"""Times the headline queries and prints one JSON line.

Each query runs once to warm up, then ``BENCH_RUNS`` times; the best run counts.
Results are written to Spark's ``noop`` sink, so every row and column is computed.
"""

import json
import os
import time

from scorelake.queries import QUERIES
from scorelake.session import local_session

HEADLINE = [
    "silver_games",
    "games_by_console",
    "agg_brands",
    "agg_consoles",
    "distinct_rows",
    "source_slice",
    "dq_summary",
    "dq_coverage",
    "brand_chart",
    "console_chart",
    "bronze_scan",
    "partition_replace",
    "json_page_scan",
    "bronze_games",
    "land_and_load",
    "agg_brands_lines",
    "end_to_end_load",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "scorelake-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, folder)
        seconds[name] = round(min(run(spark, name, folder) for _ in range(runs)), 4)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
