"""Fixity audit of WARC replicas by Merkle trees.

A page is a WARC record; records lie in files, in order, at offsets. Of each record only its
address, length and digest are kept. Each replica is laid out from its own records, so behind a
lost or cut record its positions and offsets are others than in the first one. Trees are
therefore aligned by page_id: a leaf covers the records of one id, a node above covers a fixed
range of ``FAN`` times as many ids, which in either archive is an unbroken range of offsets. A loss
changes the nodes above its id and no others.

A node has two hashes: ``placed`` over files and offsets as they are, and ``hash`` over how far each
offset is from the end of the records before it in its file. Nodes differ if both do: a record
that stays where it was is in place, and so is one that moved up only because its file did. The
audit compares the tops of two trees and goes down only below nodes that differ, level by level.
Records of an id that differs are paired with equal ones first, others in their order.

Ids may be sparse: the trees have a level for each power of ``FAN`` in the span of ids, sixteen at
most, each with no more nodes than the one below; where ids are dense, a sixteenth. A node never
has more than ``FAN`` children, and the records of an id are added up as numbers, in each task
first, so no group is hot.

Defined results: null addresses and bodies count as empty; pages that are equal in all columns
are records of their own; pages without id come first, as one leaf; two empty archives agree; a
record that only one side has is ``lost`` or ``extra``; ``position``, ``file`` and ``offset`` are those
in the first archive, for extra records in the second; other columns are not looked at.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.common import numbered, saved

FAN_BITS = 4
FAN = 1 << FAN_BITS
#: Below all ids: the leaf of records without one, unless ids begin higher.
NO_ID = -(2**63)
#: Records of a file: a node two levels above the leaves.
FILE_RECORDS = FAN * FAN


def record_bytes(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a page's WARC record."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def digests(pages: DataFrame, **bodies: Column) -> DataFrame:
    """page_id and, for each named body, its record's ``<name>_length`` and ``<name>_sha256``."""
    columns = [F.col("page_id").cast("long").alias("page_id")]
    for name, body in bodies.items():
        record = record_bytes(F.col("page_id"), F.col("url"), body)
        columns += [F.octet_length(record).cast("long").alias(f"{name}_length"), F.sha2(record, 256).alias(f"{name}_sha256")]
    return pages.select(*columns)


def laid_out(rows: DataFrame, length: str) -> DataFrame:
    """Adds ``position`` in the archive's order by page_id, and ``file``, ``offset``."""
    placed, _ = numbered(rows, [name for name in rows.columns], "position", "archive")
    placed = placed.withColumn("file", F.floor(F.col("position") / FILE_RECORDS).cast("long"))
    # A file holds FILE_RECORDS records at most.
    before = Window.partitionBy("file").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum(length).over(before), F.lit(0)))


def leaf_hashes(records: DataFrame) -> DataFrame:
    """Adds each record's hash ``packed`` by its distance from the records before it in its file,
    and ``placed`` by its file and offset."""
    # A file holds FILE_RECORDS records at most.
    before = Window.partitionBy("file").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    slack = F.col("offset") - F.coalesce(F.sum("length").over(before), F.lit(0))
    of = lambda *parts: F.sha2(F.concat_ws(":", *parts).cast("binary"), 256)
    return records.withColumn("packed", of(slack, "length", "sha256")).withColumn("placed", of("file", "offset", "length", "sha256"))


def _summed(name: str) -> Column:
    """The sum of all hashes of a group, in pieces of 60 bits; no order, no list."""
    pieces = [F.conv(F.substring(name, 1 + 15 * n, 15), 16, 10).cast("decimal(20,0)") for n in range(4)]
    return F.sha2(F.concat_ws(":", F.count(F.lit(1)), *(F.sum(piece) for piece in pieces)).cast("binary"), 256)


def tree(records: DataFrame, levels: int, no_id: int = NO_ID) -> list[DataFrame]:
    """The levels (node, hash, placed) from the leaves upward of records (page_id, position, file, offset, length, sha256)."""
    by_id = leaf_hashes(records).groupBy(F.coalesce("page_id", F.lit(no_id)).alias("node"))
    leaves = by_id.agg(_summed("packed").alias("hash"), _summed("placed").alias("placed"))
    nodes = [saved(leaves, "tree-0")]
    for level in range(1, levels + 1):
        children = F.array_sort(F.collect_list(F.struct("node", "hash", "placed")))  # FAN at most

        def spelled(name, children=children):
            parts = F.transform(children, lambda child: F.concat_ws(":", child["node"].cast("string"), child[name]))
            return F.sha2(F.array_join(parts, ",").cast("binary"), 256).alias(name)

        above = nodes[-1].groupBy(_parent().alias("parent")).agg(spelled("hash"), spelled("placed"))
        nodes.append(saved(above.withColumnRenamed("parent", "node"), f"tree-{level}"))
    return nodes


def _parent() -> Column:
    return F.shiftright("node", FAN_BITS)


def levels_over(first: int, last: int) -> int:
    """Levels above the leaves until one or two neighbours at the top cover all ids."""
    levels = 1
    while (last >> FAN_BITS * levels) - (first >> FAN_BITS * levels) > 1 and levels < 64 // FAN_BITS:
        levels += 1
    return levels


def levels_for(records: int) -> int:
    levels, reach = 1, FAN
    while reach < records:
        levels, reach = levels + 1, reach * FAN
    return levels


def differing(left: list[DataFrame], right: list[DataFrame]) -> DataFrame:
    """The leaves that differ, as ``node``, found from the tops downward."""
    bad = None
    for one, two in zip(reversed(left), reversed(right), strict=True):
        if bad is not None:
            below = bad.withColumnRenamed("node", "parent")
            one, two = (
                side.withColumn("parent", _parent()).join(below, "parent", "left_semi").drop("parent") for side in (one, two)
            )
        both = one.select("node", F.struct("hash", "placed").alias("one")).join(
            two.select("node", F.struct("hash", "placed").alias("two")), "node", "full"
        )
        agree = F.col("one.hash").eqNullSafe(F.col("two.hash")) | F.col("one.placed").eqNullSafe(F.col("two.placed"))
        bad = saved(both.filter(~agree).select("node"), "differing")
        if not bad.limit(1).count():
            break
    return bad


def audit(good: DataFrame, other: DataFrame) -> DataFrame:
    """Records of ``good`` and ``other`` (page_id, position, file, offset, length, sha256) that differ.

    Each side's layout is its own. Returns position, page_id, file, offset, length, state,
    expected_sha256 and found_sha256.
    """
    spans = [side.select(F.min("page_id"), F.max("page_id")).first() for side in (good, other)]
    first = min((low for low, _ in spans if low is not None), default=0)
    last = max((high for _, high in spans if high is not None), default=0)
    no_id = max(first - 1, NO_ID)
    levels = levels_over(no_id, last)
    bad = differing(tree(good, levels, no_id), tree(other, levels, no_id))
    at = ["page_id", "file", "offset", "length", "sha256", "packed", "placed"]

    def suspects(side, name):
        of_bad = leaf_hashes(side).withColumn("node", F.coalesce("page_id", F.lit(no_id))).join(bad, "node", "left_semi")
        nth = F.row_number().over(Window.partitionBy("node", "sha256").orderBy("position"))
        return of_bad.select("node", F.col("sha256").alias("same"), nth.alias("nth"), F.struct("position", *at).alias(name))

    # Equal records of an id first; what is left of either side is paired in order.
    equal = saved(suspects(good, "a").join(suspects(other, "b"), ["node", "same", "nth"], "full"), "suspects")

    def left(name, missing):
        rank = F.row_number().over(Window.partitionBy("node").orderBy(f"{name}.position"))
        return equal.filter(F.col(missing).isNull()).select("node", name, rank.alias("nth"))

    in_place = (F.col("a.packed") == F.col("b.packed")) | (F.col("a.placed") == F.col("b.placed"))
    moved = equal.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & ~in_place).select("a", "b")
    both = moved.unionAll(left("a", "b").join(left("b", "a"), ["node", "nth"], "full").select("a", "b"))
    state = F.when(F.col("b").isNull(), "lost").when(F.col("a").isNull(), "extra").otherwise("altered")

    def place(name):
        return F.when(F.col("a").isNull(), F.col(f"b.{name}")).otherwise(F.col(f"a.{name}")).alias(name)

    return both.select(
        *map(place, ["position", *at[:4]]),
        state.alias("state"),
        F.col("a.sha256").alias("expected_sha256"),
        F.col("b.sha256").alias("found_sha256"),
    )


def damaged(html: Column, page_id: Column) -> Column:
    """What the query's second replica has in place of some bodies: a changed letter, a cut end."""
    return (
        F.when(page_id % 101 == 7, F.concat(F.lit("~"), F.substring(html, 2, 2**31 - 1)))
        .when(page_id % 307 == 19, F.substring(html, 1, 100))
        .otherwise(html)
    )


def op4_merkle_fixity(spark, sf_dir):
    """The pages' archive against a replica with some bodies damaged and every 211th record lost,
    which is laid out from what it has."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    html = F.coalesce(F.col("html"), F.lit(""))
    both = saved(digests(pages, good=html, other=damaged(html, F.col("page_id"))), "digests")
    here = {"good": F.lit(True), "other": F.coalesce(F.col("page_id") % 211 != 13, F.lit(True))}

    def replica(name):
        length, sha256 = F.col(f"{name}_length").alias("length"), F.col(f"{name}_sha256").alias("sha256")
        return saved(laid_out(both.filter(here[name]).select("page_id", length, sha256), "length"), f"records-{name}")

    return audit(replica("good"), replica("other"))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html,
    CASE WHEN page_id % 101 = 7 THEN '~' || substr(coalesce(html, ''), 2)
      WHEN page_id % 307 = 19 THEN substr(coalesce(html, ''), 1, 100) ELSE coalesce(html, '') END AS other
  FROM pages
), r AS (
  SELECT page_id,
    'WARC/1.0' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:page:' || page_id || '>' || e
      || 'WARC-Target-URI: ' || coalesce(url, '') || e || 'Content-Type: text/html' || e || 'Content-Length: ' AS head,
    e || e AS gap, html, other
  FROM p, (SELECT chr(13) || chr(10) AS e)
), w AS (
  SELECT page_id, head || strlen(html) || gap || html || gap AS a, head || strlen(other) || gap || other || gap AS b FROM r
), n AS (
  SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS position, strlen(a) AS length,
    sha256(a) AS expected_sha256, CASE WHEN page_id % 211 <> 13 THEN sha256(b) END AS found_sha256
  FROM w
), o AS (
  SELECT *, position // 256 AS file FROM n
), f AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM o
)
SELECT position, page_id, file, "offset", length, CASE WHEN found_sha256 IS NULL THEN 'lost' ELSE 'altered' END AS state,
  expected_sha256, found_sha256
FROM f WHERE found_sha256 IS DISTINCT FROM expected_sha256
"""
