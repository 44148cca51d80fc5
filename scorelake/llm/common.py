"""What the operators share: intermediate tables, row numbers, small batches, character classes."""

import re
import sys
import unicodedata
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path
from weakref import WeakKeyDictionary

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import scorelake
from scorelake.session import work_folder
from scorelake.sources import storage

#: Low bits of ``monotonically_increasing_id``: the row's place in its partition.
PLACE_BITS = (1 << 33) - 1
CHUNK_BYTES = 4 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, as ``--py-files`` would, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(scorelake.__file__).parent
        archive = Path(SparkFiles.getRootDirectory(), "package", f"{package.name}.zip")
        archive.parent.mkdir(exist_ok=True)
        with zipfile.ZipFile(archive, "w") as file:
            for module in sorted(package.rglob("*.py")):
                file.write(module, module.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)


def arrow_map(frame: DataFrame, run: Callable, schema) -> DataFrame:
    """``frame.mapInArrow(run, schema)`` on executors that have this package."""
    ship(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go when the query ends, not when the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def saved(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the folder all executors share, and read back.

    This cuts the lineage: a lost executor costs no more than reading the table again. What was
    shuffled for it is deleted at once; ``forget`` deletes the table when nothing needs it any more.
    """
    spark = frame.sparkSession
    folder = work_folder(spark, name)
    with shuffles_dropped(spark):
        frame.write.parquet(f"{folder}/table")
    table = spark.read.schema(frame.schema).parquet(f"{folder}/table")
    _FOLDERS[table] = folder
    return table


def forget(*tables: DataFrame) -> None:
    """Deletes tables that ``saved`` has returned; frames made of them must be written by now."""
    for table in tables:
        if folder := _FOLDERS.pop(table, None):
            storage.delete(table.sparkSession, folder)


def numbered(frame: DataFrame, order: list[str], into: str, name: str) -> tuple[DataFrame, int]:
    """Rows with a gapless number from 0 in the given order, and how many there are.

    A range sort deals the rows out; rows that are equal in ``order`` are told apart by where
    they were read, so a value that a third of all rows share is spread like any other. Only
    one count for each partition is brought together. Keep ``frame`` narrow: it is written before
    it is sorted, as a range sort reads its input twice.
    """
    told_apart = saved(frame.withColumn("_tie", F.monotonically_increasing_id()), f"{name}-rows")
    keys = [*order, "_tie"]
    placed = saved(
        told_apart.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(PLACE_BITS)),
        name,
    )
    forget(told_apart)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    # One row for each partition of the sort.
    rows = placed.join(F.broadcast(starts), "_part")
    total = placed.count()
    return rows.withColumn(into, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start"), total


def chunks(batches: Iterable[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` has about ``most`` bytes in each, and a row at least."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start, size = 0, 0
        for row, length in enumerate(lengths):
            if row > start and size + length > most:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if start < len(lengths):
            yield batch.slice(start)


def map_chunks(frame: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str) -> DataFrame:
    """``work`` on small Arrow batches of every partition; memory does not follow the partition."""

    def run(batches):
        for chunk in chunks(batches, column):
            yield work(chunk)

    return arrow_map(frame, run, schema)


@lru_cache(maxsize=8)
def class_of(first: str, last: int = sys.maxunicode) -> str:
    """The code points up to ``last`` whose general category begins with ``first``, for a regex class."""
    ranges: list[list[int]] = []
    for point in range(last + 1):
        if unicodedata.category(chr(point)).startswith(first):
            if ranges and ranges[-1][1] == point - 1:
                ranges[-1][1] = point
            else:
                ranges.append([point, point])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges)
