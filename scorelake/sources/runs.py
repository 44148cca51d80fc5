"""Sums and maxima by key that change a little at a time, kept in levelled runs.

A run is a table with a row for each key, dealt into a fixed number of buckets by key and sorted
inside. What a key comes to are the sums, and maxima, of its rows in all runs. A change is a run of its
own: it is joined with the other runs to find what its keys came to before and come to now, and put
on level 0. When a level has ``fan`` runs, they are merged into one on the next level, so that there
are no more runs than grows with the logarithm of the number of changes.

All runs of a store have the same buckets, so joining and merging them moves no row: bucket meets
bucket, and both are read in their order. Only the change itself is shuffled, once, when it is written.
"""

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.sources import storage

BUCKETS = 16
#: Spark reads the files' order only when told to; it needs one file for each bucket.
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


class SumRuns:
    """Runs below ``folder``: key columns ``(name, type)``, and ``sums`` and ``maxima``, which are bigints.

    ``levels`` has the runs' names by level, the oldest first in each. Keys are not null. A row
    whose sums are all 0 is as good as none.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        keys: Sequence[tuple[str, str]],
        sums: Sequence[str],
        levels: Sequence[Sequence[str]] = (),
        buckets: int = BUCKETS,
        maxima: Sequence[str] = (),
        fan: int = 2,
    ):
        self.spark, self.folder, self.buckets, self.fan = spark, folder, buckets, fan
        self.kinds, self.keys = list(keys), [name for name, _ in keys]
        self.sums, self.maxima = list(sums), list(maxima)
        self.values = [*self.sums, *self.maxima]
        self.levels = [list(level) for level in levels]

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def read(self, run: str) -> DataFrame:
        """A run as a bucketed table; its files lie in the store's folder, whatever the session."""
        name = f"run_{run}"
        if not self.spark.catalog.tableExists(name):
            by = ", ".join(f"`{key}`" for key in self.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({self._columns()}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by})"
                f" INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{run}'"
            )
        return self.spark.table(name)

    def _columns(self) -> str:
        return ", ".join([f"`{key}` {kind}" for key, kind in self.kinds] + [f"`{one}` bigint" for one in self.values])

    def write(self, rows: DataFrame) -> str:
        """Rows with one for each key, as a run that is in no level yet."""
        # Spark deals buckets out by this hash, so each task writes the one file of its bucket.
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets))
        return self._written(rows.select(*self.keys, *self.values).repartitionById(self.buckets, bucket))

    def _written(self, rows: DataFrame) -> str:
        run = uuid.uuid4().hex
        bucketed = rows.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        bucketed.option("path", f"{self.folder}/{run}").saveAsTable(f"run_{run}")
        return run

    def summed(self, rows: DataFrame) -> DataFrame:
        """Rows of a change as one for each key; keys that it does not change are left out."""
        maxima = (F.max(one).alias(one) for one in self.maxima)
        return rows.groupBy(*self.keys).agg(*(F.sum(one).alias(one) for one in self.sums), *maxima).filter(self._any())

    def _any(self):
        return F.greatest(*(F.abs(F.col(one)) for one in self.sums), F.lit(0)) > 0

    def before(self, change: str) -> DataFrame:
        """For each key of the change its sums as ``before_*``, without the change, and ``after_*``, with it."""
        found = self.read(change)
        zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
        changes = [F.col(one).alias(f"change_{one}") for one in self.values]
        nothing = [(zero if one in self.sums else none).alias(f"before_{one}") for one in self.values]
        found = found.select(*self.keys, *changes, *nothing)
        for run in self.runs():
            known = self.read(run).hint("merge")
            both = [self._both(one, f"before_{one}", one).alias(f"before_{one}") for one in self.values]
            found = found.join(known, self.keys, "left").select(*self.keys, *(f"change_{one}" for one in self.values), *both)
        after = [self._both(one, f"before_{one}", f"change_{one}").alias(f"after_{one}") for one in self.values]
        return found.select(*self.keys, *(f"before_{one}" for one in self.values), *after)

    def _both(self, name: str, one: str, two: str) -> Column:
        if name in self.maxima:
            return F.greatest(one, two)  # of what is not null
        return F.coalesce(one, F.lit(0)) + F.coalesce(two, F.lit(0))

    def merged(self, one: str, two: str) -> DataFrame:
        """What the keys of two runs come to in both; a key that comes to nothing is left out."""
        other = self.read(two).hint("merge")
        other = other.select(*self.keys, *(F.col(name).alias(f"other_{name}") for name in self.values))
        both = [self._both(name, name, f"other_{name}").alias(name) for name in self.values]
        return self.read(one).join(other, self.keys, "full").select(*self.keys, *both).filter(self._any())

    def place(self, change: str) -> None:
        """Put a change on level 0, and merge levels that are full."""
        level, run = 0, change
        while True:
            if len(self.levels) <= level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fan:
                return
            full, self.levels[level] = self.levels[level], []
            run, level = reduce(self.write_merged, full), level + 1

    def write_merged(self, one: str, two: str) -> str:
        """Two runs as one. The rows are in their buckets already, so they are written as they are read."""
        with ordered(self.spark):
            return self._written(self.merged(one, two))

    def total(self) -> DataFrame:
        """All keys and what they come to; this reads and groups everything."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], self._columns())
        # Read as plain files: a union of bucketed scans is taken for bucketed, and then grouped by file.
        return self.summed(self.spark.read.schema(self._columns()).parquet(*(f"{self.folder}/{run}" for run in runs)))

    def drop_others(self) -> None:
        """Delete runs that are in no level: merged ones, and those of changes that were never placed."""
        for run in set(storage.child_names(self.spark, self.folder)) - set(self.runs()):
            self.spark.sql(f"DROP TABLE IF EXISTS run_{run}")
            storage.delete(self.spark, f"{self.folder}/{run}")


class ordered:
    """Scans of buckets that are planned inside know the order of their files."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(ORDERED)
        self.spark.conf.set(ORDERED, "true")

    def __exit__(self, *_) -> None:
        self.spark.conf.set(ORDERED, self.before)
