"""Month tables whose months change in one commit, for readers that must never find one missing.

Below the table's folder lie

    _versions/version=V/part=rows/date=M/   rows of month M as the load V wrote them
    _snapshots/V.json                       which months the load V has put in place

A load writes a version of its own and is seen by nobody until its small commit file, one line
for each month, is there. Which version a month is read in is settled by the commit that names it
last. Nothing is moved or deleted meanwhile, so a reader finds the old rows or the new ones, of all
months of a load at once; versions that no reader needs any more are deleted later. Loads of
different months do not get into each other's way; of one month, the later commit counts.

Months that lie plainly in the folder, as ``write_months`` leaves them, are read as they are until
a commit names them.
"""

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.sources import storage

VERSIONS, SNAPSHOTS, ROWS = "_versions", "_snapshots", "rows"
#: How the name of a version tells when it was started.
STARTED = "%Y%m%dT%H%M%S%f"
#: Commit files beyond this many are folded into one.
MOST_COMMITS = 32


def new_version() -> str:
    return f"{datetime.now(timezone.utc):{STARTED}}-{uuid.uuid4().hex[:8]}"


def version_folder(path: str, version: str) -> str:
    return f"{path}/{VERSIONS}/version={version}"


def _commits(spark: SparkSession, path: str) -> list[str]:
    names = storage.child_names(spark, f"{path}/{SNAPSHOTS}")
    return [name for name in names if name.endswith(".json") and not name.startswith((".", "_"))]


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_commits(spark, path))


def current(spark: SparkSession, path: str) -> dict[str, str | None]:
    """The version of each month that a commit names, None where the month has no rows."""
    while True:
        found = _merged(spark, path, _commits(spark, path))
        if found is not None:
            return found


def _merged(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, str | None] | None:
    """What these commits come to, in the order of their times; None when one has just been folded."""
    found: dict[str, str | None] = {}
    for name in names:
        text = storage.read_text(spark, f"{path}/{SNAPSHOTS}/{name}", whole=True)
        if text is None:
            return None
        for line in text.splitlines():
            entry = json.loads(line)
            found[entry["month"]] = entry["version"]
    return found


def commit(spark: SparkSession, path: str, months: Mapping[str, str | None]) -> None:
    """Put each month's version in place, or none: all of them are seen at once, or none is."""
    if not months:
        return
    folder = f"{path}/{SNAPSHOTS}"
    _put(spark, folder, months, new_version())
    names = _commits(spark, path)
    folded = _merged(spark, path, names) if len(names) > MOST_COMMITS else None
    if folded is not None:
        # The fold sorts beside the last commit it holds, so that later ones still count.
        _put(spark, folder, folded, f"{names[-1].removesuffix('.json')}-{uuid.uuid4().hex[:8]}")
        for name in names:
            storage.delete(spark, f"{folder}/{name}")


def _put(spark: SparkSession, folder: str, months: Mapping[str, str | None], name: str) -> None:
    lines = (json.dumps({"month": month, "version": version}) for month, version in sorted(months.items()))
    # Written aside first: a reader never finds half a commit.
    storage.write_text(spark, f"{folder}/_{name}", "\n".join(lines))
    storage.move(spark, f"{folder}/_{name}", f"{folder}/{name}.json")


def plain_months(spark: SparkSession, path: str) -> list[str]:
    names = storage.child_names(spark, path)
    return [name.removeprefix("date=") for name in names if name.startswith("date=")]


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as it is now; what is committed later does not change the frame."""
    placed = current(spark, path)
    found = read_versions(spark, path, {month: version for month, version in placed.items() if version}, schema)
    plain = [f"{path}/date={month}" for month in plain_months(spark, path) if month not in placed]
    if not plain:
        return found
    rows = spark.read.schema(schema).option("basePath", path).parquet(*plain).select(*schema.names)
    return found.unionAll(rows) if any(placed.values()) else rows


def read_versions(spark: SparkSession, path: str, versions: Mapping[str, str], schema: T.StructType) -> DataFrame:
    """The given months as the given versions have them, in one scan."""
    folders = [f"{version_folder(path, version)}/part={ROWS}/date={month}" for month, version in versions.items()]
    if not folders:
        return spark.createDataFrame([], schema)
    wide = T.StructType([*schema.fields, T.StructField("version", T.StringType()), T.StructField("part", T.StringType())])
    rows = spark.read.schema(wide).option("basePath", f"{path}/{VERSIONS}").parquet(*folders)
    return rows.select(*schema.names)


def write(table: DataFrame, path: str, version: str) -> list[str]:
    """Write rows as a version, ``table`` having a column ``part`` or not; returns the months with rows.

    What is written is not seen before it is committed; a write that fails leaves nothing.
    """
    spark = table.sparkSession
    folder = version_folder(path, version)
    if "part" not in table.columns:
        table = table.withColumn("part", F.lit(ROWS))
    try:
        table.write.partitionBy("part", "date").parquet(folder)
    except Exception:
        storage.delete(spark, folder)
        raise
    return plain_months(spark, f"{folder}/part={ROWS}")


def replace_months(
    spark: SparkSession,
    table: DataFrame,
    path: str,
    months: Sequence[str],
    gathered: Callable[[DataFrame], DataFrame] = lambda table: table,
) -> list[str]:
    """Make ``months`` of the table at ``path`` hold exactly ``table``; returns those with rows.

    A month without new rows holds none from then on; months not listed stay. ``gathered``
    brings rows of a month together before they are written.
    """
    months = sorted(set(months))
    version = new_version()
    landed = write(gathered(table.filter(table["date"].isin(*months))), path, version)
    place(spark, path, version, months, landed)
    return [month for month in months if month in landed]


def place(spark: SparkSession, path: str, version: str, months: Sequence[str], landed: Sequence[str]) -> None:
    """Commit ``months`` in a version; one that is not ``landed`` has no rows then."""
    had = {*current(spark, path), *plain_months(spark, path)}
    new = {month: version if month in landed else None for month in months if month in landed or month in had}
    commit(spark, path, new)


def drop_old_versions(
    spark: SparkSession, path: str, unused_for: timedelta = timedelta(days=1)
) -> list[str]:
    """Delete versions, and plain months, that commits have replaced at least ``unused_for`` ago.

    Whoever began to read before may go on for that long. A version that nobody has committed
    goes when it was started that long ago: its load has failed. Returns what was deleted.
    """
    limit = f"{datetime.now(timezone.utc) - unused_for:{STARTED}}"
    placed, names = current(spark, path), _commits(spark, path)
    old: list[str] = []
    # A month's version is out of use since the first commit after it that names the month.
    last_change = max((name.removesuffix(".json") for name in names), default="")
    used = {version for version in placed.values() if version}
    for name in storage.child_names(spark, f"{path}/{VERSIONS}"):
        version = name.removeprefix("version=")
        if version not in used and version < limit and last_change < limit:
            old.append(f"{VERSIONS}/{name}")
    if last_change < limit:
        old += [f"date={month}" for month in plain_months(spark, path) if month in placed]
    for name in old:
        storage.delete(spark, f"{path}/{name}")
    return old
