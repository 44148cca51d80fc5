"""Times the headline SQL in DuckDB and the queries in Spark over repeated orders; prints one JSON line.

``BENCH_TIMES`` copies of the orders, with new keys, are written to a new folder first, in as
many row groups as copies; the other tables are read where they are. Both engines get
``BENCH_CPUS`` threads and run in one go. SQL is timed in two forms: lists unnested in SELECT, as
the checked SQL has them, and unnested in FROM. DuckDB answers into a temporary table, Spark
writes to its ``noop`` sink; the best of ``BENCH_RUNS`` runs after a warm-up counts.
"""

import json
import os
import tempfile
import time

import duckdb

from scorelake.oracle import ORACLE
from scorelake.queries import QUERIES
from scorelake.session import local_session

NAMES = [
    "games_by_console",
    "agg_brands",
    "agg_consoles",
    "dq_summary",
    "dq_coverage",
    "silver_games",
    "source_slice",
    "agg_brands_lines",
    "cast_date",
    "json_page_scan",
    "bronze_games",
    "partition_replace",
    "land_and_load",
    "end_to_end_load",
]
IN_SELECT = "SELECT game_id, metacritic_score, unnest(console_names) AS console_name FROM silver"
IN_FROM = "SELECT game_id, metacritic_score, u.name AS console_name FROM silver, unnest(console_names) AS u(name)"


def repeated(source: str, times: int) -> str:
    """A folder with the tables of ``source``, its orders ``times`` over."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for name in os.listdir(source):
        if name != "orders.parquet":
            os.symlink(os.path.join(source, name), os.path.join(folder, name))
    with duckdb.connect() as sql:
        sql.execute("SET preserve_insertion_order = false")
        (most,) = sql.execute(f"SELECT max(o_orderkey) + 1 FROM '{source}/orders.parquet'").fetchone()
        sql.execute(
            f"""COPY (SELECT * REPLACE (o_orderkey + n * {most} AS o_orderkey)
            FROM '{source}/orders.parquet', range({times}) AS copies(n))
            TO '{folder}/orders.parquet' (ROW_GROUP_SIZE 150000)"""
        )
    return folder


def best(work, runs: int) -> float:
    work()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    times, runs = int(os.environ.get("BENCH_TIMES", "60")), int(os.environ.get("BENCH_RUNS", "3"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(NAMES)).split(",")
    folder = repeated(source, times) if times > 1 else source
    spark = local_session(cpus, "scorelake-baseline")
    spark.sparkContext.setLogLevel("ERROR")
    sql = duckdb.connect()
    sql.execute(f"SET threads = {cpus}")
    for table in ("orders", "nation", "region", "lineitem", "supplier"):
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    seconds = {}
    for name in names:
        query = ORACLE[name]
        row = {
            "spark": best(lambda n=name: QUERIES[n](spark, folder).write.format("noop").mode("overwrite").save(), runs),
            "sql_in_select": best(lambda q=query: sql.execute(f"CREATE OR REPLACE TEMP TABLE answer AS {q}"), runs),
        }
        if IN_SELECT in query:
            other = query.replace(IN_SELECT, IN_FROM)
            row["sql_in_from"] = best(lambda q=other: sql.execute(f"CREATE OR REPLACE TEMP TABLE answer AS {q}"), runs)
        seconds[name] = row
    print(json.dumps({"unit": "sec", "cpus": cpus, "orders_times": times, "seconds": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
