"""Exact top-k inner products on a bit-sliced index.

Each component x is floor(256 * x). A block of vectors is stored as bitmaps: for every dimension
and bit, the rows that have that bit (above the block's smallest value). A query adds up the
bitmaps, each as often as its own component says, with full adders on whole bitmaps, so the sums
of all rows are made at once and are bit slices again. Only the upper bits of the index are
added; what the lower ones can add is bounded by the query. From the most significant slice of
the sums downward, the rows of the k largest are found; all rows that the bound leaves a chance
are the boundary, and for these the exact product is taken from all the bits.

Blocks and groups of queries meet on a grid. Blocks are dealt to its rows and groups to its columns;
each block goes to all cells of its row, each group to all cells of its column, so that what is
shuffled grows with the root of the number of cells, not with blocks times groups. A task has a cell:
it holds the cell's groups and takes its blocks one after the other. There are so many columns that
the groups of a cell fit into ``HELD`` bytes. What tasks return is k rows for each query and block.

Defined results: a vector that is null, or holds a null, a NaN or an infinity, takes no part, nor
does a row without vec_id; only vectors of the same length are compared; a query is not matched
with rows of its own vec_id; repeated rows are candidates, and queries, of their own; ties go to
the smaller vec_id; fewer candidates than k give fewer rows; other columns are not looked at.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.common import arrow_map, saved

TOP = 5
EVERY = 50
SCALE = 256
#: Rows of a block, and components it may hold; queries of a group.
BLOCK_ROWS = 16_384
BLOCK_VALUES = 1 << 22
GROUP = 64
#: Bits that the first sums leave out.
LOWER_BITS = 3
#: Cells of the grid at least, if there are as many blocks and groups, and bytes of a cell's groups.
CELLS = 24
HELD = 64 << 20

BLOCKS = "block long, dims int, rows int, ids binary, least binary, slices binary"
GROUPS = "chunk long, dims int, ids binary, vectors binary"


def quantised(vectors: DataFrame, name: str = "embedding") -> DataFrame:
    """(vec_id, values): whole numbers, of the vectors that take part."""
    usable = F.forall(
        name, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    )
    values = F.transform(name, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(name).alias(name))
    return rows.filter(F.col("vec_id").isNotNull() & F.col(name).isNotNull() & usable).select("vec_id", values.alias("values"))


def _parts(batches, most: int, values: int):
    """(number, ids, matrix) of rows of one length each, in order; the number is one of a kind."""
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        lists = batch.column("values")
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        sizes = np.array(lists.value_lengths().to_pylist(), dtype=np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            step = max(1, min(most, values // max(int(size), 1)))
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                where = (ends[part] - size)[:, None] + np.arange(size)
                yield number, ids[part], flat[where].reshape(len(part), size)
                number += 1


def bit_slices(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least value of each dimension, and the bitmaps [dimension, bit, word] above it."""
    rows, dims = matrix.shape
    least = matrix.min(axis=0)
    above = np.zeros((-(-rows // 64) * 64, dims), np.int64)
    above[:rows] = matrix - least
    bits = max(1, int(above.max(initial=0)).bit_length())
    slices = np.empty((dims, bits, len(above) // 8), np.uint8)
    for bit in range(bits):
        slices[:, bit] = np.packbits((above.T >> bit) & 1, axis=1, bitorder="little")
    return least, slices


def indexed(values: DataFrame) -> DataFrame:
    """Blocks of rows as bit slices."""

    def run(batches):
        for number, ids, matrix in _parts(batches, BLOCK_ROWS, BLOCK_VALUES):
            least, slices = bit_slices(matrix)
            row = {
                "block": number, "dims": matrix.shape[1], "rows": len(ids),
                "ids": ids.tobytes(), "least": least.tobytes(), "slices": slices.tobytes(),
            }
            yield pa.RecordBatch.from_pylist([row], SCHEMAS[0])

    return arrow_map(values, run, BLOCKS)


def grouped(queries: DataFrame) -> DataFrame:
    """Groups of query vectors of one length."""

    def run(batches):
        for number, ids, matrix in _parts(batches, GROUP, BLOCK_VALUES):
            row = {"chunk": number, "dims": matrix.shape[1], "ids": ids.tobytes(), "vectors": matrix.tobytes()}
            yield pa.RecordBatch.from_pylist([row], SCHEMAS[1])

    return arrow_map(queries, run, GROUPS)


SCHEMAS = (
    pa.schema([("block", pa.int64()), ("dims", pa.int32()), ("rows", pa.int32())] + [(n, pa.binary()) for n in ("ids", "least", "slices")]),
    pa.schema([("chunk", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())]),
)


def added(slices: np.ndarray, inverse: np.ndarray, query: np.ndarray) -> list:
    """Bit slices, least significant first, of the rows' sums; a None is all zeros.

    A component below zero adds the complement of its bitmaps, which shifts all sums alike.
    """
    waiting: list[list[np.ndarray]] = []
    for dim, factor in enumerate(query.tolist()):
        maps, factor = (slices[dim], factor) if factor > 0 else (inverse[dim], -factor)
        for shift in range(factor.bit_length()):
            if factor >> shift & 1:
                while len(waiting) < shift + len(maps):
                    waiting.append([])
                for bit, bitmap in enumerate(maps):
                    waiting[shift + bit].append(bitmap)
    total: list = []
    place = 0
    while place < len(waiting):
        maps = waiting[place]
        if len(maps) > 1 and place + 1 == len(waiting):
            waiting.append([])
        while len(maps) > 2:
            a, b, c = maps.pop(), maps.pop(), maps.pop()
            either = a ^ b
            maps.insert(0, either ^ c)
            waiting[place + 1].append((a & b) | (either & c))
        if len(maps) == 2:
            a, b = maps
            maps[:] = [a ^ b]
            waiting[place + 1].append(a & b)
        total.append(maps[0] if maps else None)
        place += 1
    return total


def largest(total: list, there: np.ndarray, wanted: int) -> int:
    """The ``wanted``-th largest sum among the rows ``there``, found from the top slice down."""
    sure, maybe, value = 0, there, 0
    for place in range(len(total) - 1, -1, -1):
        bitmap = total[place]
        having = maybe & bitmap if bitmap is not None else np.zeros_like(maybe)
        count = int(np.bitwise_count(having).sum())
        if sure + count >= wanted:
            maybe, value = having, value | 1 << place
        else:
            sure += count
            maybe = maybe & ~having
    return value


def at_least(total: list, there: np.ndarray, limit: int) -> np.ndarray:
    """The rows ``there`` whose sum is ``limit`` or more."""
    more, equal = np.zeros_like(there), there
    for place in range(len(total) - 1, -1, -1):
        bitmap = total[place] if total[place] is not None else np.zeros_like(there)
        if limit >> place & 1:
            equal = equal & bitmap
        else:
            more = more | (equal & bitmap)
            equal = equal & ~bitmap
    return more | equal


class Block:
    def __init__(self, dims: int, rows: int, ids: bytes, least: bytes, slices: bytes):
        self.ids, self.least = np.frombuffer(ids, np.int64), np.frombuffer(least, np.int64)
        words = -(-rows // 64)
        self.all = np.frombuffer(slices, np.uint8).reshape(dims, -1, words * 8) if dims else np.zeros((0, 1, words * 8), np.uint8)
        low = min(LOWER_BITS, self.all.shape[1] - 1)
        self.low = low
        self.upper = self.all.view(np.uint64)[:, low:]
        self.inverse = ~self.upper
        self.rows, self.words = rows, words

    def bitmap(self, rows: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.words * 64, bool)
        padded[: self.rows] = rows
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def values(self, rows: np.ndarray) -> np.ndarray:
        bits = (self.all[:, :, rows >> 3] >> (rows & 7).astype(np.uint8)) & 1
        places = np.int64(1) << np.arange(self.all.shape[1], dtype=np.int64)
        return (bits * places[:, None]).sum(axis=1).T + self.least

    def best(self, own: int, query: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the block's ``top`` rows."""
        there = self.bitmap(self.ids != own)
        wanted = min(top, int(np.bitwise_count(there).sum()))
        if not wanted:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        total = added(self.upper, self.inverse, query)
        # What the lower bits can add to a sum, in units of the sums.
        slack = int(np.abs(query).sum()) * ((1 << self.low) - 1) >> self.low
        limit = largest(total, there, wanted) - slack
        chance = at_least(total, there, limit) if limit > 0 else there
        rows = np.flatnonzero(np.unpackbits(chance.view(np.uint8), bitorder="little"))
        scores, ids = self.values(rows) @ query, self.ids[rows]
        order = np.lexsort((ids, -scores))[:top]
        return ids[order], scores[order]


def grid(blocks: int, groups: int, group_bytes: int, cells: int = CELLS, held: int = HELD) -> tuple[int, int]:
    """Rows and columns: about ``cells`` cells, as square as that goes, more columns where groups are many."""
    columns = max(1, -(-group_bytes // held))
    columns = max(columns, min(groups, max(math.isqrt(cells), -(-cells // max(blocks, 1)))))
    rows = min(max(blocks, 1), max(1, -(-cells // columns)))
    return rows, columns


def dealt(blocks: DataFrame, groups: DataFrame, rows: int, columns: int) -> DataFrame:
    """Each block in all cells of its row and each group in all of its column, groups first in a cell."""
    # Numbers are (task << 33) + a running number: neighbours go to different rows or columns.
    number = lambda name: F.shiftright(name, 33) + F.col(name).bitwiseAND((1 << 33) - 1)
    row, column = F.pmod(number("block"), F.lit(rows)), F.pmod(number("chunk"), F.lit(columns))
    none = F.lit(None)
    of_blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))).select(
        (row * columns + F.col("other")).cast("int").alias("cell"), F.lit(1).alias("kind"), "dims", "rows",
        none.cast("long").alias("chunk"), "ids", "least", F.col("slices").alias("content"),
    )
    of_groups = groups.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).select(
        (F.col("other") * columns + column).cast("int").alias("cell"), F.lit(0).alias("kind"), "dims", none.cast("int").alias("rows"),
        "chunk", "ids", none.cast("binary").alias("least"), F.col("vectors").alias("content"),
    )
    cells = of_blocks.unionAll(of_groups).repartitionById(rows * columns, "cell")
    return cells.sortWithinPartitions("cell", "kind")


def search(values: DataFrame, queries: DataFrame, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query's ``top`` candidates."""

    def run(batches):
        cell, held = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                [row] = batch.slice(at, 1).to_pylist()
                if row["cell"] != cell:
                    cell, held = row["cell"], []
                if row["kind"] == 0:
                    own = np.frombuffer(row["ids"], np.int64)
                    held.append((row["chunk"], row["dims"], own, np.frombuffer(row["content"], np.int64).reshape(len(own), row["dims"])))
                    continue
                block = Block(row["dims"], row["rows"], row["ids"], row["least"], row["content"])
                for chunk, dims, own, vectors in held:
                    if dims == row["dims"]:
                        yield found_by(block, chunk, own, vectors)

    def found_by(block, chunk, own, vectors) -> pa.RecordBatch:
        out = []
        for place, (query_id, query) in enumerate(zip(own.tolist(), vectors, strict=True)):
            for vec_id, score in zip(*block.best(query_id, query, top), strict=True):
                out.append((chunk, place, query_id, int(vec_id), int(score)))
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["chunk", "place", "query_id", "vec_id", "score"]
    blocks, groups = saved(indexed(values), "bit-slices"), saved(grouped(queries), "query-groups")
    size = groups.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("vectors")), F.lit(0)).alias("bytes")).first()
    rows, columns = grid(blocks.count(), size["n"], size["bytes"], cells)
    found = arrow_map(dealt(blocks, groups, rows, columns), run, ", ".join(f"{name} long" for name in names))
    order = Window.partitionBy("chunk", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_bit_sliced_topk(spark, sf_dir):
    values = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    cells = max(CELLS, 4 * spark.sparkContext.defaultParallelism)
    return search(values, values.filter(F.col("vec_id") % EVERY == 0), cells=cells)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
