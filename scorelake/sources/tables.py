"""Parquet tables by month, marts and the CSV dimension."""

import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.schemas import BRONZE, MAPPING, SILVER
from scorelake.sources import snapshots, storage

# More groups even out large months, but leave small ones in more files.
SPREAD = 8
#: Parquet bytes that a task sorts.
TASK_BYTES = 128 << 20


def read_months(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A month-partitioned table, columns in the order of ``schema``; one with snapshots as it is now."""
    if snapshots.is_versioned(spark, path):
        return snapshots.read(spark, path, schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType = BRONZE) -> DataFrame:
    return read_months(spark, path, schema)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return read_months(spark, path, SILVER)


def read_in_order(
    spark: SparkSession,
    path: str,
    first_month: str,
    last_month: str,
    order: Sequence[str],
    kept: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    schema: T.StructType = SILVER,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Rows of the months from first to last, sorted by ``order``, which sorts by month before anything else.

    The folders' names tell the order of months and their sizes how many fit into a task, so no
    range sort has to read the rows before it can deal them out: neighbouring months are read and
    sorted in one task and follow each other without a shuffle. Only a month larger than a task is
    range-sorted, by itself. ``kept`` filters the rows before they are sorted.
    """
    months = sorted(m for m in snapshots.plain_months(spark, path) if first_month <= m <= last_month)
    sizes = {month: storage.size(spark, f"{path}/date={month}") for month in months}
    parts = 2 * spark.sparkContext.defaultParallelism
    bound = max(1, min(task_bytes, -(-sum(sizes.values()) // parts)))
    groups: list[list[str]] = []
    held = bound
    for month in months:
        if held + sizes[month] > bound:
            groups.append([])
            held = 0
        groups[-1].append(month)
        held += sizes[month]
    frames = []
    for group in groups:
        folders = [f"{path}/date={month}" for month in group]
        rows = kept(spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names))
        large = sum(sizes[month] for month in group) > task_bytes
        frames.append(rows.orderBy(*order) if large else rows.coalesce(1).sortWithinPartitions(*order))
    return reduce(DataFrame.unionAll, frames) if frames else spark.createDataFrame([], schema)


def write_months(table: DataFrame, path: str, compact: bool = False) -> None:
    """Write ``table`` below ``path/date=YYYY-MM``, replacing the months it has rows for.

    ``compact`` shuffles rows of a month together first, for input scattered over many
    tasks; input already laid out by month needs no shuffle. A new folder is written
    plainly; only an existing one needs the overwrite that looks at each month. A table with
    snapshots gets a new version of those months.
    """
    rows = by_month(table) if compact else table
    if snapshots.is_versioned(table.sparkSession, path):
        version = snapshots.new_version()
        landed = snapshots.write(rows, path, version)
        snapshots.place(table.sparkSession, path, version, landed, landed)
        return
    writer = rows.write.partitionBy("date")
    if storage.child_names(table.sparkSession, path):
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def by_month(table: DataFrame) -> DataFrame:
    """Rows of a month in few tasks, however large the month.

    The task a row comes from spreads a month over ``SPREAD`` groups; it stays the same
    when a task runs again, unlike a random number. The rebalance lets adaptive execution
    split groups that are still too big and join small ones.
    """
    spread = F.pmod(F.spark_partition_id(), F.lit(SPREAD))
    return table.withColumn("spread", spread).hint("rebalance", "date", "spread").drop("spread")


@contextmanager
def staging(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder below ``path`` to write to, gone afterwards whatever happens."""
    # Spark does not read folders whose names start with an underscore.
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    try:
        yield staged
    finally:
        storage.delete(spark, staged)


def publish_months(spark: SparkSession, staged: str, path: str, months: Sequence[str]) -> None:
    """Put the month folders of ``staged`` in the place of ``path``'s; a listed month without one goes.

    A month whose new folder cannot be put in place gets its old one back, and the error
    is raised when all months have been tried.
    """
    replaced = f"{path}/_replaced-{uuid.uuid4().hex}"
    landed = set(storage.child_names(spark, staged))

    def swap(month: str) -> None:
        folder = f"date={month}"
        had = storage.exists(spark, f"{path}/{folder}")
        if had:
            storage.move(spark, f"{path}/{folder}", f"{replaced}/{folder}")
        if folder in landed:
            try:
                storage.move(spark, f"{staged}/{folder}", f"{path}/{folder}")
            except Exception:
                storage.delete(spark, f"{path}/{folder}")
                if had:
                    storage.move(spark, f"{replaced}/{folder}", f"{path}/{folder}")
                raise

    # A move is a copy on an object store, so months are swapped side by side.
    with ThreadPoolExecutor(max_workers=16) as pool:
        errors = [error for error in pool.map(_error_of(swap), sorted(set(months))) if error]
    if errors:
        raise errors[0]
    storage.delete(spark, replaced)


def _error_of(work: Callable[[str], None]) -> Callable[[str], Exception | None]:
    def run(month: str) -> Exception | None:
        try:
            work(month)
        except Exception as error:
            return error
        return None

    return run


def replace_months(
    spark: SparkSession, table: DataFrame, path: str, months: Sequence[str]
) -> list[str]:
    """Make ``months`` of the plain table at ``path`` hold exactly ``table``; return those with rows.

    This is for tables that others read by their folders alone; between the two moves of a
    month they find it missing. ``snapshots.replace_months`` leaves no such gap. The new rows are written aside in full before any month is touched, so a failing
    load leaves the table as it was. A month without new rows is removed; months not
    listed stay. The folders moved are one per month; should the driver be lost between
    two of them, loading the same months again completes the work.
    """
    months = sorted(set(months))
    with staging(spark, path) as staged:
        write_months(table.filter(table["date"].isin(*months)), staged, compact=True)
        landed = set(storage.child_names(spark, staged))
        publish_months(spark, staged, path, months)
    return [month for month in months if f"date={month}" in landed]


def write_mart(mart: DataFrame, gold: str, name: str) -> None:
    """Write a finished mart; adaptive execution joins a small one into a file, a large one stays spread."""
    mart.hint("rebalance").write.mode("overwrite").parquet(f"{gold}/{name}")


def read_mart(spark: SparkSession, gold: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{gold}/{name}")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The console dimension from CSV with a header."""
    return (
        spark.read.schema(MAPPING)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_mapping(mapping: DataFrame, path: str) -> None:
    mapping.select(*MAPPING.names).hint("rebalance").write.mode("overwrite").option(
        "header", True
    ).csv(path)
