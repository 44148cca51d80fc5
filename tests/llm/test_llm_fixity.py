import hashlib
import random

from llm_rows import CLASHING
from pyspark.sql import functions as F

from scorelake.llm import fixity
from scorelake.llm.queries import QUERIES

AT = "page_id long, position long, file long, offset long, length long, sha256 string"


def archive(spark, hashes):
    rows = [(n, n, n // 256, 10 * n, 10, h) for n, h in hashes.items()]
    return spark.createDataFrame(rows, AT)


def found(good, other):
    return {r.position: (r.state, r.expected_sha256, r.found_sha256) for r in fixity.audit(good, other).collect()}


def test_every_difference_and_no_other_is_found(spark):
    rng = random.Random(1)
    for records in (1, 16, 17, 300):
        good = {n: f"h{n % 7}" for n in range(records)}
        other = dict(good)
        expected = {}
        for n in rng.sample(range(records), min(records, 6)):
            if rng.random() < 0.5:
                other[n] = "bad"
                expected[n] = ("altered", good[n], "bad")
            else:
                del other[n]
                expected[n] = ("lost", good[n], None)
        other[records + 40] = "new"
        expected[records + 40] = ("extra", None, "new")
        assert found(archive(spark, good), archive(spark, other)) == expected


def test_equal_and_empty_archives_agree(spark):
    good = archive(spark, {n: "same" for n in range(40)})
    assert found(good, good.repartition(3)) == {}
    empty = archive(spark, {})
    assert found(empty, empty) == {}
    assert len(found(good, empty)) == 40


def test_swapped_records_and_moved_offsets_differ(spark):
    good = archive(spark, {n: f"h{n}" for n in range(40)})
    swapped = archive(spark, {n: f"h{ {3: 4, 4: 3}.get(n, n) }" for n in range(40)})
    assert found(good, swapped).keys() == {3, 4}
    moved = good.withColumn("offset", F.expr("offset + IF(position = 9, 1, 0)"))
    assert found(good, moved).keys() == {9}


def test_only_nodes_above_differences_differ(spark):
    good = archive(spark, {n: f"h{n}" for n in range(300)})
    other = archive(spark, {n: f"h{n}" if n != 77 else "bad" for n in range(300)})
    levels = fixity.levels_for(300)
    for level, (one, two) in enumerate(zip(fixity.tree(good, levels), fixity.tree(other, levels), strict=True)):
        bad = one.join(two.withColumnRenamed("hash", "other"), "node").filter("hash <> other").collect()
        assert [r.node for r in bad] == [77 // fixity.FAN**level]
        assert one.count() == -(-300 // fixity.FAN**level)


def laid(spark, pages):
    rows = spark.createDataFrame(pages, "page_id long, length long, sha256 string")
    return fixity.laid_out(rows, "length")


def states(good, other):
    return sorted(((r.page_id, r.state, r.position) for r in fixity.audit(good, other).collect()), key=str)


def test_replicas_laid_out_by_themselves(spark):
    pages = [(3 * n, 10 + n % 5, f"h{n}") for n in range(600)]
    good = laid(spark, pages)
    other = laid(spark, [p for p in pages if p[0] != 6])
    assert states(good, other) == [(6, "lost", 2)]
    # Only the branch of the lost record is visited: one leaf of each level's one node.
    levels = fixity.levels_over(0, 3 * 599)
    assert [r.node for r in fixity.differing(fixity.tree(good, levels), fixity.tree(other, levels)).collect()] == [6]
    cut = [(i, 3, "cut") if i == 30 else (i, n, h) for i, n, h in pages if i != 6] + [(7, 9, "new")]
    assert states(good, laid(spark, cut)) == [(30, "altered", 10), (6, "lost", 2), (7, "extra", 2)]


def test_records_that_share_an_id_or_have_none(spark):
    ids = [None] * 40 + [-1, -1, -1, 0, 5, 5, 5]
    pages = [(i, 10, f"h{n % 45}") for n, i in enumerate(ids)]
    other = laid(spark, [page for n, page in enumerate(pages) if n not in (17, 40, 45)])
    assert [(i, state) for i, state, _ in states(laid(spark, pages), other)] == [(-1, "lost"), (5, "lost"), (None, "lost")]


def test_records_of_odd_pages(spark):
    rows = [(None, None, None), (1, "u", "é"), (1, "u", "é"), (2, None, ""), (3, "v", "x" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in CLASHING:
        pages = pages.selectExpr("*", f"1 AS `{name}`")
    placed = fixity.laid_out(fixity.digests(pages, good=F.col("html")), "good_length").orderBy("position").collect()
    offset = 0
    for row, (page_id, url, html) in zip(placed, rows, strict=True):
        body = (html or "").encode()
        raw = (
            f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\n"
            f"WARC-Target-URI: {url or ''}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
        ).encode() + body + b"\r\n\r\n"
        assert (row.page_id, row.offset, row.good_length) == (page_id, offset, len(raw))
        assert row.good_sha256 == hashlib.sha256(raw).hexdigest()
        offset += len(raw)


def test_query(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    bad = {p.page_id: "lost" if p.page_id % 211 == 13 else "altered" for p in pages if p.page_id % 211 == 13 or p.page_id % 101 == 7 or p.page_id % 307 == 19}
    rows = QUERIES["op4_merkle_fixity"](spark, "/root/testdata/sf0.01").collect()
    assert {r.page_id: r.state for r in rows} == bad
