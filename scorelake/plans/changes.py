"""Marts and the uniqueness check kept up to date by the months that have changed.

What the months of bronze add to a mart is kept as sums by game: how often a game is listed on a
console, and how often by a brand with one score. When months are replaced, their old rows are taken
back and their new ones added, as one change. Only the keys of that change are looked up in what is
kept (``sources.runs``), and what they came to before and come to now moves the sums of the few
consoles and brands. The same goes for games by id: a key that comes to more than one row is no
longer unique, whatever months the rows are in.

So an update reads and shuffles in proportion to the months that changed, and merges kept runs now
and then. It is committed by one small file; an update that fails changes nothing. With another
mapping or threshold, or when the old rows of a month are gone, everything is built anew.
"""

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.functions import round2
from scorelake.operators.games import games_by_console, to_silver
from scorelake.operators.marts import CONSOLE_KEYS, highly_rated, with_share
from scorelake.schemas import BRONZE
from scorelake.seeds import HIGHLY_RATED_THRESHOLD
from scorelake.sources import snapshots, storage
from scorelake.sources.runs import BUCKETS, SumRuns, ordered

#: In place of a null among the keys, which must have a value.
NULL = "\x00"
#: In place of a game without a score.
NO_SCORE = -(2**31)
STATE = "_state"

STORES = {
    "games": ([("game_id", "string")], ["records"]),
    "consoles": (
        [("brand", "string"), ("console_name", "string"), ("is_handheld", "string"), ("game_id", "string")],
        ["listings", "score_sum", "scores", "high"],
    ),
    "brands": ([("brand", "string"), ("game_id", "string"), ("score", "int")], ["listings"]),
}
#: ``entries`` tells whether anything is left of a console or brand.
MART_SUMS = ["entries", "score_sum", "scores", "games", "high"]


@dataclass
class Kept:
    """What an update starts from: which version of each month is in it, and where the rest lies."""

    months: dict[str, str]
    levels: dict[str, list[list[str]]]
    tables: dict[str, str]
    #: Tables of the state before this one, which somebody may still read.
    retired: list[str]
    made_with: str

    @classmethod
    def nothing(cls, made_with: str) -> "Kept":
        return cls({}, {name: [] for name in STORES}, {}, [], made_with)


class KeptMarts:
    """Marts and repeated game ids of the bronze table at ``bronze``, kept below ``folder``."""

    def __init__(
        self,
        spark: SparkSession,
        bronze: str,
        folder: str,
        mapping: DataFrame,
        threshold: int = HIGHLY_RATED_THRESHOLD,
        buckets: int = BUCKETS,
    ):
        self.spark, self.bronze, self.folder = spark, bronze, folder
        self.mapping, self.threshold, self.buckets = mapping, threshold, buckets

    # State

    def _made_with(self) -> str:
        rows = sorted(map(str, self.mapping.collect()))  # the console mapping
        return hashlib.sha256(json.dumps([rows, self.threshold, self.buckets]).encode()).hexdigest()

    def kept(self) -> Kept | None:
        """The state committed last."""
        names = [name for name in storage.child_names(self.spark, f"{self.folder}/{STATE}") if name.endswith(".json")]
        if not names:
            return None
        text = storage.read_text(self.spark, f"{self.folder}/{STATE}/{names[-1]}", whole=True)
        return Kept(**json.loads(text))

    def _commit(self, kept: Kept) -> None:
        name = snapshots.new_version()
        path = f"{self.folder}/{STATE}"
        storage.write_text(self.spark, f"{path}/_{name}", json.dumps(vars(kept)))
        storage.move(self.spark, f"{path}/_{name}", f"{path}/{name}.json")
        for old in storage.child_names(self.spark, path):
            if old.endswith(".json") and old != f"{name}.json":
                storage.delete(self.spark, f"{path}/{old}")

    def store(self, name: str, kept: Kept) -> SumRuns:
        keys, sums = STORES[name]
        return SumRuns(self.spark, f"{self.folder}/{name}", keys, sums, kept.levels[name], self.buckets)

    # Updates

    def update(self) -> list[str]:
        """Take in what has changed in bronze; returns the months that have."""
        plain = snapshots.plain_months(self.spark, self.bronze)
        now = snapshots.current(self.spark, self.bronze)
        if not set(plain) <= set(now):
            raise ValueError(f"{self.bronze} has months without a version")
        now = {month: version for month, version in now.items() if version}
        made_with, last = self._made_with(), self.kept()
        kept = last
        if kept is None or kept.made_with != made_with or not self._old_rows_are_there(kept.months, now):
            kept = Kept.nothing(made_with)
        changed = sorted(month for month in {*kept.months, *now} if kept.months.get(month) != now.get(month))
        if not changed and last is not None:
            return []
        by_console, games = self._changes(kept.months, now, changed)
        stores = {name: self.store(name, kept) for name in STORES}
        console_rows, brand_rows = _console_rows(by_console, self.threshold), _brand_rows(by_console)
        with ordered(self.spark):
            tables = {
                "consoles": self._moved(stores["consoles"], kept, console_rows, CONSOLE_KEYS, _console_sums),
                "brands": self._moved(stores["brands"], kept, brand_rows, ["brand"], lambda when: _brand_sums(when, self.threshold)),
                "repeated": self._repeated(stores["games"], kept, games),
            }
        levels = {name: store.levels for name, store in stores.items()}
        self._commit(Kept(now, levels, tables, list(last.tables.values()) if last else [], made_with))
        for store in stores.values():
            store.drop_others()
        for table in last.retired if last else []:
            storage.delete(self.spark, table)
        return changed

    def _old_rows_are_there(self, before: Mapping[str, str], now: Mapping[str, str]) -> bool:
        return all(
            storage.exists(self.spark, snapshots.version_folder(self.bronze, version))
            for month, version in before.items()
            if now.get(month) != version
        )

    def _changes(self, before: Mapping[str, str], now: Mapping[str, str], months: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """Listed games, and games, of the changed months: new ones with ``sign`` 1, old ones with -1."""
        listed, games = [], []
        for versions, sign in ((now, 1), (before, -1)):
            wanted = {month: versions[month] for month in months if month in versions}
            silver = to_silver(snapshots.read_versions(self.spark, self.bronze, wanted, BRONZE))
            signed = F.lit(sign).cast("bigint").alias("sign")
            listed.append(games_by_console(silver, self.mapping).select("*", signed))
            games.append(silver.select("game_id", signed))
        return listed[0].unionAll(listed[1]), games[0].unionAll(games[1])

    def _moved(self, store: SumRuns, kept: Kept, rows: DataFrame, keys: Sequence[str], sums_of) -> str:
        """A mart's sums after a change: those from before, moved by what the keys of the change came to and come to."""
        change = store.write(store.summed(rows))
        before, after = sums_of("before"), sums_of("after")
        moves = store.before(change).select(*keys, *((after[name] - before[name]).alias(name) for name in MART_SUMS))
        name = store.folder.rsplit("/", 1)[1]
        if name in kept.tables:
            moves = moves.unionAll(self.spark.read.parquet(kept.tables[name]).select(*keys, *MART_SUMS))
        path = f"{self.folder}/tables/{name}-{uuid.uuid4().hex}"
        sums = moves.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in MART_SUMS))
        sums.filter("entries > 0").write.parquet(path)
        store.place(change)
        return path

    def _repeated(self, store: SumRuns, kept: Kept, games: DataFrame) -> str:
        """Game ids that come to more than one row; those of the change are judged again."""
        rows = games.filter(F.col("game_id").isNotNull()).withColumnRenamed("sign", "records")
        change = store.write(store.summed(rows))
        judged = store.before(change).select("game_id", F.col("after_records").alias("records"))
        found = judged.filter("records > 1")
        if "repeated" in kept.tables:
            others = self.spark.read.parquet(kept.tables["repeated"])
            found = found.unionAll(others.join(store.read(change).select("game_id"), "game_id", "left_anti"))
        path = f"{self.folder}/tables/repeated-{uuid.uuid4().hex}"
        found.write.parquet(path)
        store.place(change)
        return path

    # What readers get

    def _table(self, name: str) -> DataFrame:
        kept = self.kept()
        if kept is None or name not in kept.tables:
            raise LookupError(f"no update has been made in {self.folder}")
        return self.spark.read.parquet(kept.tables[name])

    def console_mart(self) -> DataFrame:
        """As ``operators.marts.console_mart`` of all months."""
        return self._mart("consoles", CONSOLE_KEYS)

    def brand_mart(self) -> DataFrame:
        """As ``operators.marts.brand_mart`` of all months."""
        return self._mart("brands", ["brand"])

    def _mart(self, name: str, keys: Sequence[str]) -> DataFrame:
        return with_share(
            self._table(name).select(
                *(_unmarked(key) for key in keys),
                round2(F.try_divide(F.col("score_sum"), F.col("scores"))).alias("avg_metacritic_score"),
                F.col("games").alias("number_of_games"),
                F.col("high").alias("number_of_highly_rated_games"),
            )
        )

    def repeated_games(self) -> DataFrame:
        """As ``operators.quality.repeated_values`` of all months' game ids."""
        return self._table("repeated").select(F.col("game_id").alias("value"), "records")


def _marked(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NULL)).alias(column)


def _unmarked(column: str) -> Column:
    text = F.when(F.col(column) != NULL, F.col(column))
    return text.cast("boolean" if column == "is_handheld" else "string").alias(column)


def _console_rows(by_console: DataFrame, threshold: int) -> DataFrame:
    sign, score = F.col("sign"), F.col("metacritic_score")
    zero = F.lit(0).cast("bigint")
    return by_console.select(
        *map(_marked, (*CONSOLE_KEYS, "game_id")),
        sign.alias("listings"),
        F.coalesce(sign * score, zero).cast("bigint").alias("score_sum"),
        F.when(score.isNull(), zero).otherwise(sign).alias("scores"),
        F.when(highly_rated(threshold), sign).otherwise(zero).alias("high"),
    )


def _console_sums(when: str) -> dict:
    """What a console's game adds to the console: its scores, and itself once, once more if any is high."""
    has_id = F.col("game_id") != NULL
    return {
        "entries": (F.col(f"{when}_listings") > 0).cast("bigint"),
        "score_sum": F.col(f"{when}_score_sum"),
        "scores": F.col(f"{when}_scores"),
        "games": (has_id & (F.col(f"{when}_listings") > 0)).cast("bigint"),
        "high": (has_id & (F.col(f"{when}_high") > 0)).cast("bigint"),
    }


def _brand_rows(by_console: DataFrame) -> DataFrame:
    return by_console.select(
        *map(_marked, ("brand", "game_id")),
        F.coalesce("metacritic_score", F.lit(NO_SCORE)).alias("score"),
        F.col("sign").alias("listings"),
    )


def _brand_sums(when: str, threshold: int) -> dict:
    """What a game of one score adds to the brand, however many of its consoles list it."""
    there = (F.col(f"{when}_listings") > 0).cast("bigint")
    scored = F.when(F.col("score") != NO_SCORE, there).otherwise(0)
    counted = F.when(F.col("game_id") != NULL, there).otherwise(0)
    high = F.col("score") >= threshold
    return {
        "entries": there,
        "score_sum": scored * F.col("score"),
        "scores": scored,
        "games": counted,
        "high": F.when(high, counted).otherwise(0),
    }
