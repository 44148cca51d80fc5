"""Raw pages: JSON objects ``{downloaded_at, results: [game, ...]}`` in month folders."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.schemas import GAME, PAGE
from scorelake.seeds import PAGE_SIZE
from scorelake.sources import storage
from scorelake.sources.tables import by_month, publish_months, staging

CORRUPT = "_corrupt_record"
#: Beside the pages of a month: how they are stored. Spark does not read such files.
FORM_FILE = "_form"


class PageFormError(Exception):
    """Raised when pages are to be read in another form than the one they were written in."""


@dataclass(frozen=True)
class PageFormat:
    """How pages are stored: one per line, or one per file, indented or not.

    Without ``lines`` each month is read as its folder records, and one that records
    nothing, as downloads do, as a page per file.
    """

    lines: bool | None = None
    file_pattern: str = "*.json"
    game: T.StructType = GAME


AS_RECORDED = PageFormat()
ONE_PER_FILE = PageFormat(lines=False)
ONE_PER_LINE = PageFormat(lines=True)


def raw_months(spark: SparkSession, raw: str) -> list[str]:
    """The months that raw has folders for."""
    names = storage.child_names(spark, raw)
    return [name.removeprefix("date=") for name in names if name.startswith("date=")]


def read_pages(
    spark: SparkSession,
    raw: str,
    months: Sequence[str] | None = None,
    form: PageFormat = AS_RECORDED,
) -> DataFrame:
    """Pages under ``raw/date=YYYY-MM``; a page that does not fit the schema raises.

    Only the folders of ``months`` are listed; a month without a folder has no pages.
    """
    complaint = F.raise_error(F.concat(F.lit("MALFORMED_RECORD: a page of "), F.col("date")))
    results = F.when(F.col("bad"), complaint.cast(PAGE["results"].dataType)).otherwise(F.col("results"))
    return marked_pages(spark, raw, months, form).select(
        "downloaded_at", results.alias("results"), "documents", "date"
    )


def marked_pages(
    spark: SparkSession,
    raw: str,
    months: Sequence[str] | None = None,
    form: PageFormat = AS_RECORDED,
) -> DataFrame:
    """Pages with ``bad``: no JSON, no list of results, or a game that does not fit the schema.

    ``documents`` has each game's own JSON text, with the fields outside the schema, and
    ``games`` says how many there are.
    """
    found, mismatched = page_folders(spark, raw, months, form)
    if mismatched:
        listed = ", ".join(f"{month} are stored as one per {kind}" for month, kind in mismatched.items())
        raise PageFormError(f"pages of {listed}")
    pages = scan_pages(spark, raw, found, form)
    read = pages.withColumn("read", F.transform("results", lambda text: read_game(text, form)))
    bad = (
        F.col(CORRUPT).isNotNull()
        | F.col("results").isNull()
        | F.exists("read", lambda one: one.isNull() | one[CORRUPT].isNotNull())
    )
    return read.select(
        "downloaded_at",
        F.transform("read", lambda one: one.dropFields(CORRUPT)).alias("results"),
        F.col("results").alias("documents"),
        F.coalesce(F.array_size("results"), F.lit(0)).cast("bigint").alias("games"),
        F.coalesce(bad, F.lit(True)).alias("bad"),
        "date",
    )


def read_game(text: Column, form: PageFormat = AS_RECORDED) -> Column:
    """A game from its JSON text; one that does not fit the schema has its text in ``CORRUPT`` as well."""
    checked = T.StructType([*form.game.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def page_folders(
    spark: SparkSession, raw: str, months: Sequence[str] | None, form: PageFormat
) -> tuple[dict[bool, list[str]], dict[str, str]]:
    """Month folders by whether they have a page per line, and months recorded in another form than asked for."""
    there = raw_months(spark, raw)
    found: dict[bool, list[str]] = {}
    mismatched: dict[str, str] = {}
    for month in there if months is None else sorted(set(there) & set(months)):
        recorded = storage.read_text(spark, f"{raw}/date={month}/{FORM_FILE}")
        lines = recorded == "line" if form.lines is None else form.lines
        if recorded is not None and lines != (recorded == "line"):
            mismatched[month] = recorded
        else:
            found.setdefault(lines, []).append(f"{raw}/date={month}")
    return found, mismatched


def scan_pages(
    spark: SparkSession, raw: str, folders: Mapping[bool, Sequence[str]], form: PageFormat = AS_RECORDED
) -> DataFrame:
    """Rows ``(downloaded_at, results, file, date)``, results as the games' own texts; no other column is decoded.

    A file of one page, or a packed one, that cannot be read gives no rows; ``file_outcomes``
    tells of it. Of plain files with a page per line an error in reading them is an error.
    """
    scans = []
    for lines, paths in folders.items():
        if not lines or packed_files(form):
            whole = _scan(spark, raw, paths, lines, form, unreadable_is_empty=True)
            scans.append(whole.filter(packed(F.col("name"))) if lines else whole)
        if lines:
            plain = _scan(spark, raw, paths, lines, form, unreadable_is_empty=False)
            scans.append(plain.filter(~packed(F.col("name"))) if packed_files(form) else plain)
    if not scans:
        # Without any folder of raw at all this names the path that is missing.
        scans = [_scan(spark, raw, [raw], True, form, False).filter("false")]
    return reduce(DataFrame.unionByName, scans).drop("name")


def packed_files(form: PageFormat) -> bool:
    """Whether the pattern may take in compressed files."""
    return not form.file_pattern.lower().endswith(".json")


def packed(name: Column) -> Column:
    return F.lower(name).rlike(r"\.(gz|gzip|bz2|deflate|snappy|lz4|zst)$")


def _scan(
    spark: SparkSession, raw: str, folders: Sequence[str], lines: bool, form: PageFormat, unreadable_is_empty: bool
) -> DataFrame:
    schema = "downloaded_at timestamp, results array<string>, date string"
    pages = (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", not lines)
        .option("ignoreCorruptFiles", unreadable_is_empty)
        .option("basePath", raw)
        .option("pathGlobFilter", form.file_pattern)
        .json(list(folders))
    )
    return pages.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"))


def raw_files(
    spark: SparkSession, raw: str, folders: Mapping[bool, Sequence[str]], form: PageFormat = AS_RECORDED
) -> DataFrame:
    """The files of the folders that hold anything: file, date, length, whether it has a page per line, and whether it can be ``read``.

    They are listed, not opened, but for packed files with a page per line: of one that ends too
    early the first pages would be read, so each of these is read to its end.
    """
    listed = []
    for lines, paths in folders.items():
        files = (
            spark.read.format("binaryFile")
            .option("basePath", raw)
            .option("pathGlobFilter", form.file_pattern)
            .load(list(paths))
            .select(
                F.col("_metadata.file_path").alias("file"),
                F.substring(F.col("date").cast("string"), 1, 7).alias("date"),
                "length",
                F.lit(lines).alias("lines"),
            )
        )
        if lines and packed_files(form):
            sound = (
                spark.read.option("ignoreCorruptFiles", True)
                .option("pathGlobFilter", form.file_pattern)
                .text(list(paths), wholetext=True)
                .filter(packed(F.col("_metadata.file_name")) & (F.octet_length("value") >= 0))
                .select(F.col("_metadata.file_path").alias("file"), F.lit(True).alias("sound"))
            )
            files = files.join(sound, "file", "left").withColumn("read", F.col("sound") | ~packed(F.col("file"))).drop("sound")
            files = files.withColumn("read", F.coalesce("read", F.lit(False)))
        else:
            files = files.withColumn("read", F.lit(True))
        listed.append(files)
    if not listed:
        return spark.createDataFrame([], "file string, date string, length bigint, lines boolean, read boolean")
    return reduce(DataFrame.unionByName, listed)


def paginate(
    games: DataFrame, downloaded_at: datetime | None = None, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Pack rows ``(game, date)`` into pages of one month, ordered by release.

    Rows are numbered inside their own partition and cut every ``page_size`` numbers,
    so a page never gathers more than that, however many games a month has. The whole
    game breaks ties, so a task that runs again numbers its rows alike.
    """
    stamp = F.current_timestamp() if downloaded_at is None else F.lit(downloaded_at)
    ordered = games.sortWithinPartitions("date", "game.released", "game.id", "game")
    numbered = ordered.withColumn("row", F.monotonically_increasing_id())
    return (
        numbered.groupBy("date", F.expr(f"row div {page_size}").alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("row", "game"))).alias("entries"))
        .select(
            stamp.cast("timestamp").alias("downloaded_at"),
            F.col("entries.game").alias("results"),
            "date",
        )
    )


def write_pages(
    pages: DataFrame,
    raw: str,
    form: PageFormat = ONE_PER_LINE,
    months: Sequence[str] | None = None,
) -> list[str]:
    """Make the months of ``pages``, or the given ones, hold just these; returns those with pages.

    One page per line of larger files, with pages of a month brought together first, so
    that files stay few and can be split on reading; or one indented page per file. The
    form is recorded beside the pages of each month.
    """
    lines = form.lines is not False
    if months is not None:
        pages = pages.filter(F.col("date").isin(*months))
    writer = (
        (by_month(pages) if lines else pages)
        .write.option("ignoreNullFields", False)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
        .partitionBy("date")
    )
    if not lines:
        writer = writer.option("maxRecordsPerFile", 1).option("pretty", True)
    with staging(pages.sparkSession, raw) as staged:
        writer.json(staged)
        landed = raw_months(pages.sparkSession, staged)
        for month in landed:
            path = f"{staged}/date={month}/{FORM_FILE}"
            storage.write_text(pages.sparkSession, path, "line" if lines else "file")
        publish_months(pages.sparkSession, staged, raw, landed if months is None else months)
    return landed


def game_counts(pages: DataFrame) -> DataFrame:
    """How many games the marked pages of each month hold; their fields are not looked at."""
    return pages.groupBy(F.col("date").alias("month")).agg(F.sum("games").alias("games"))
