"""Line dedup on levelled sorted runs of line hashes.

A store holds runs: tables of (line hash, documents that have the line, largest of them), dealt into
a fixed number of buckets by hash and sorted inside. A batch of documents becomes such a run. It is
merge-joined with the store's runs, bucket by bucket and in their order, so that no run is shuffled or
sorted again: the batch learns which of its lines ``LEAST_DOCS`` documents or more have by now.
(A plain anti-join would drop lines that one document before has; runs carry numbers instead.) Then
the run is put on level 0. When a level has ``FAN`` runs, they are merged in their order into one on
the next level, so a line's numbers are written again only once per level.

A frequent line is dropped from every document but the largest that has it. Numbers only grow, so
what a batch drops stays dropped; later batches can make more of its lines frequent. A line's
last batch sees its final numbers, hence ``dedup`` joins what all look-ups found in a final pass,
which holds every document against all others without merging the runs.

A line's key is the line stripped of ASCII white space with A-Z in lower case; only keys of at
least ``LEAST_POINTS`` code points count. Keys are compared by two 64-bit hashes. A hot line is
counted in every task before it is shuffled, and the join that looks it up can be split; only
narrow rows take part in either, and each text is shuffled once if it loses lines.

Defined results: a null or empty text is one empty line and stays (null as null); a line that a
document repeats counts once for it, and rows that share a doc_id are one document; a null
doc_id is a document smaller than all others; repeated rows are each returned; an empty table
gives no rows; in the pipeline other columns are kept whatever their names.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm.common import documents, forget, saved
from scorelake.session import work_folder
from scorelake.sources.runs import SumRuns, ordered

LEAST_POINTS = 40
LEAST_DOCS = 5
BATCHES = 4
FAN = 2
#: Buckets of a run at least, and lines for each beyond that.
BUCKETS = 16
BUCKET_LINES = 1 << 20
SPACE = " \t\n\x0b\x0c\r"
NO_ID = -(2**63)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(text: Column) -> Column:
    """The long lines of a text as structs of two hashes and their number."""

    def hashed(line, number):
        key = key_of(line)
        return F.when(
            (F.char_length(line) >= LEAST_POINTS) & (F.char_length(key) >= LEAST_POINTS),
            F.struct(
                F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"), number.alias("number")
            ),
        )

    return F.filter(F.transform(lines_of(text), hashed), lambda line: line.isNotNull())


class LineRuns:
    """The levelled runs, in the shared folder until they are dropped."""

    def __init__(self, spark: SparkSession, buckets: int = BUCKETS, fan: int = FAN):
        folder = work_folder(spark, "line-runs")
        self.store = SumRuns(spark, folder, [("a", "bigint"), ("b", "bigint")], ["docs"], (), buckets, ["last"], fan)

    def take(self, lines: DataFrame, least_docs: int) -> DataFrame:
        """Looks a batch's lines (a, b, doc) up and adds them. No document may be in two batches.

        Returns those (a, b, last) of its lines that ``least_docs`` documents of this and the
        batches before have.
        """
        own = self.store.write(numbers_of(lines))
        with ordered(lines.sparkSession):
            known = self.store.before(own).filter(F.col("after_docs") >= least_docs)
            frequent = saved(known.select("a", "b", F.col("after_last").alias("last")), "batch-frequent")
        self.store.place(own)
        self.store.drop_others()
        return frequent

    def drop(self) -> None:
        self.store.levels = []
        self.store.drop_others()


def numbers_of(lines: DataFrame) -> DataFrame:
    """For each (a, b) the number of documents, and the largest, of lines (a, b, doc)."""
    per_document = lines.groupBy("a", "b", "doc").agg(F.lit(1).alias("one"))
    return per_document.groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last"))


def dropped_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """Per document that loses lines: doc, text hash ``mark`` and the sorted ``numbers`` of the lines."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    lines = (
        docs.select(doc.alias("doc"), F.xxhash64("text").alias("mark"), F.explode(line_hashes(F.col("text"))).alias("line"))
        .select("doc", "mark", "line.*")
        .withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int"))
    )
    lines = saved(lines, "lines")
    store = LineRuns(docs.sparkSession, max(BUCKETS, -(-lines.count() // BUCKET_LINES)))
    found = [store.take(lines.filter(F.col("batch") == batch), least_docs) for batch in range(batches)]
    store.drop()
    every = reduce(DataFrame.unionAll, found)
    # Both sides are tables, so that adaptive execution can split the rows of a hot line.
    frequent = saved(every.groupBy("a", "b").agg(F.max("last").alias("last")), "frequent-lines")
    forget(*found)
    found = lines.join(frequent, ["a", "b"]).filter(F.col("doc") < F.col("last"))
    return found.groupBy("doc", "mark").agg(F.array_sort(F.collect_set("number")).alias("numbers"))


def without(lines: Column, numbers: Column) -> Column:
    """The lines between the given sorted line numbers, in time linear in both."""
    ends = F.concat(numbers, F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(0)), F.transform(numbers, lambda number: number + 1))
    stretches = F.zip_with(starts, ends, lambda start, end: F.slice(lines, start + 1, end - start))
    return F.flatten(stretches)


def dedup(docs: DataFrame, least_docs: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """The rows as ``row`` with the ``kept`` text (null stays null), ``n_lines`` and ``n_dropped``."""
    drops = dropped_lines(docs, least_docs, batches)
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("mark"),
    )
    joined = rows.join(drops, ["doc", "mark"], "left")
    lines, numbers = lines_of(F.col("row.text")), F.col("numbers")
    left = F.array_join(without(lines, numbers), "\n")
    return joined.select(
        "row",
        F.when(numbers.isNull(), F.col("row.text")).otherwise(left).alias("kept"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(numbers), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op9_line_runs(spark, sf_dir):
    return dedup(documents(spark, sf_dir).select("doc_id", "text")).select(
        "row.doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS number FROM d
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), j AS (
  SELECT k.doc_id, k.number, k.line, f.last IS NOT NULL AND k.doc_id < f.last AS gone
  FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
