"""Times the alternatives behind design choices and prints one JSON line.

Each works on a silver or bronze table written once, not on the feed, and the best of
``BENCH_RUNS`` runs after a warm-up counts.
"""

import json
import os
import time

from pyspark import StorageLevel
from pyspark.sql import functions as F

from scorelake import order_feed as feed
from scorelake.functions import percentage, round2
from scorelake.operators.games import games_by_console, to_silver
from scorelake.operators.marts import CONSOLE_KEYS, brand_mart, console_mart, highly_rated_id
from scorelake.session import local_session, work_folder
from scorelake.sources.tables import read_bronze, read_silver, write_months


def compute(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def direct_console_mart(by_console):
    high, games = F.count_distinct(highly_rated_id()), F.count_distinct("game_id")
    return by_console.groupBy(*CONSOLE_KEYS).agg(
        round2(F.avg("metacritic_score")).alias("avg_metacritic_score"),
        games.alias("number_of_games"),
        high.alias("number_of_highly_rated_games"),
        percentage(high, games).alias("percentage_of_highly_rated_games"),
    )


def both_marts(by_console, keep: bool) -> None:
    if keep:
        by_console = by_console.persist(StorageLevel.MEMORY_AND_DISK)
    compute(brand_mart(by_console))
    compute(console_mart(by_console))
    if keep:
        by_console.unpersist(blocking=True)


def names_by_lambda(bronze):
    return bronze.select(F.transform("game.platforms", lambda entry: entry["platform"]["name"]))


def names_by_path(bronze):
    return bronze.select("game.platforms.platform.name")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "scorelake-choices")
    spark.sparkContext.setLogLevel("ERROR")
    path = work_folder(spark, "choices")
    write_months(feed.games(spark, folder), f"{path}/bronze", compact=True)
    bronze = read_bronze(spark, f"{path}/bronze")
    write_months(to_silver(bronze), f"{path}/silver")
    silver = read_silver(spark, f"{path}/silver")
    by_console = games_by_console(silver, feed.console_mapping(spark, folder))
    choices = {
        "console mart, by game first": lambda: compute(console_mart(by_console)),
        "console mart, direct distinct counts": lambda: compute(direct_console_mart(by_console)),
        "both marts, recomputed": lambda: both_marts(by_console, keep=False),
        "both marts, persisted": lambda: both_marts(by_console, keep=True),
        "list names by path": lambda: compute(names_by_path(bronze)),
        "list names by lambda": lambda: compute(names_by_lambda(bronze)),
    }
    seconds = {}
    for name, choice in choices.items():
        choice()
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            choice()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(json.dumps({"unit": "sec", "choices": seconds, "folder": folder}))
    spark.stop()


if __name__ == "__main__":
    main()
