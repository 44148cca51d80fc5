import math
import random
from collections import Counter

import numpy as np
from llm_rows import CLASHING
from pyspark.sql import functions as F

from scorelake.llm import topk
from scorelake.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>"


def expected(rows, every, top):
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in kept:
        if i % every == 0:
            scores = [(-sum(map(int.__mul__, q, v)), j) for j, v in kept if j != i and len(v) == len(q)]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


def got(spark, rows, every=3, top=5):
    frame = spark.createDataFrame(rows, VECTORS)
    for name in CLASHING:
        frame = frame.selectExpr("*", f"1 AS `{name}`")
    values = topk.quantised(frame)
    return sorted(tuple(r) for r in topk.search(values, values.filter(f"vec_id % {every} = 0"), top).collect())


def vectors(rng, count, dims, spread=1.0):
    return [(n, [rng.gauss(0, spread) for _ in range(dims)]) for n in range(count)]


def test_scores_and_ties(spark):
    rng = random.Random(1)
    rows = vectors(rng, 130, 16)
    rows += [(200 + n, list(rows[0][1])) for n in range(9)]  # ties
    rows += [(300, [0.0] * 16), (301, [-5.0] * 16), (302, [1e4] * 16), (303, [-1e4] + [3e3] * 15)]
    assert got(spark, rows) == expected(rows, 3, 5)
    assert got(spark, rows, every=50, top=1) == expected(rows, 50, 1)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(random.Random(2), 20, 3)
    rows += [(None, [1.0] * 3), (30, None), (33, [1.0, None, 1.0]), (36, [nan, 0.0, 0.0]), (39, [inf, 0.0, 0.0]), (42, [-inf, 0.0, 0.0])]
    rows += [(45, []), (46, []), (48, [1.0, 2.0]), (51, [2.0, 1.0]), (54, [1.0] * 3), (54, [1.0] * 3)]
    assert got(spark, rows) == expected(rows, 3, 5)


def test_few_or_no_candidates(spark):
    assert got(spark, [(0, [1.0])]) == []
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]


def test_many_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 37)
    monkeypatch.setattr(topk, "GROUP", 5)
    rows = vectors(random.Random(3), 400, 8, 0.2)
    assert got(spark, rows, every=7) == expected(rows, 7, 5)


def test_shapes_of_the_grid():
    assert topk.grid(0, 0, 0, 24) == (1, 1)
    assert topk.grid(6, 17, 1 << 20, 24) == (6, 4)
    assert topk.grid(1, 100, 1 << 20, 24) == (1, 24)
    assert topk.grid(1000, 3, 1 << 20, 24) == (8, 3)
    rows, columns = topk.grid(10**5, 10**4, 10**11, 4000)
    assert columns >= 10**11 / topk.HELD and rows >= 1
    for blocks, groups in ((61_000, 30_000), (244_000, 120_000)):
        # Copies of a block, and of a group, do not grow with the table.
        assert max(topk.grid(blocks, groups, 1 << 20, 4096)) <= 65


def test_every_block_meets_every_group_once(spark):
    blocks = spark.createDataFrame([((part << 33) + n, 2, 1, b"", b"", b"") for part in range(5) for n in range(3)], topk.BLOCKS)
    groups = spark.createDataFrame([((part << 33) + n, 2, b"", b"") for part in range(4) for n in range(2)], topk.GROUPS)
    cells = topk.dealt(blocks, groups, 4, 3)
    text = cells._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange") == 1
    rows = cells.select("cell", "kind", F.spark_partition_id().alias("task")).collect()
    assert {(row.cell, row.task) for row in rows} == {(n, n) for n in range(12)}
    counts = Counter((row.cell, row.kind) for row in rows)
    assert sum(counts[cell, 0] * counts[cell, 1] for cell in range(12)) == 15 * 8
    assert max(counts[cell, 1] for cell in range(12)) <= 4


def test_bitmap_sums_and_choice():
    rng = np.random.default_rng(4)
    for dims, rows in ((1, 5), (9, 64), (20, 300)):
        matrix = rng.integers(-300, 300, (rows, dims))
        least, slices = topk.bit_slices(matrix)
        block = topk.Block(dims, rows, np.arange(rows).tobytes(), least.tobytes(), slices.tobytes())
        assert (block.values(np.arange(rows)) == matrix).all()
        query = rng.integers(-50, 50, dims)
        total = topk.added(block.upper, block.inverse, query)
        bits = [np.unpackbits(s.view(np.uint8), bitorder="little")[:rows].astype(np.int64) if s is not None else 0 for s in total]
        sums = sum(b << place for place, b in enumerate(bits)) + np.zeros(rows, np.int64)
        upper = (matrix - least) >> block.low
        full = (1 << block.upper.shape[1]) - 1
        assert (sums == np.where(query > 0, upper * query, (full - upper) * -query).sum(axis=1)).all()
        there = block.bitmap(np.arange(rows) % 3 > 0)
        some = np.sort(sums[np.arange(rows) % 3 > 0])[::-1]
        for wanted in (1, 2, len(some)):
            limit = topk.largest(total, there, wanted)
            assert limit == some[wanted - 1]
            chosen = topk.at_least(total, there, limit)
            assert int(np.bitwise_count(chosen).sum()) == (some >= limit).sum()


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    found = QUERIES["op3_bit_sliced_topk"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == expected(rows, 50, 5)
