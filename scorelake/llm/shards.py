"""Sharding by a permutation of row numbers that anybody can compute.

Rows get a gapless number in the order of their keys. A Feistel network over two mixed-radix
halves permutes the numbers; a result outside the range is walked on along its cycle until it
is inside. Place ``p`` means shard ``p mod shards`` and slot ``p div shards``, so shards differ
by one row at most, slots have no gaps, and where row ``i`` goes follows from ``i``, the number
of rows and the seed alone. ``row_at`` is the way back.

The halves have ``ceil(sqrt(n))`` and ``ceil(n / that)`` values, so fewer than ``sqrt(n) + 1``
values lie outside and a walk is at most that long; it is worked out in full, never cut off.
All of it is built-in functions.

Defined results: no rows give no rows; equal rows each get a place of their own; null keys
sort first; null texts have no bytes and the checksum of the empty text; other columns are
not looked at.
"""

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import numbered

SHARDS = 24
SEED = 20_240_607
ROUNDS = 8
#: A row's own cost besides its text.
ROW_BYTES = 8


def halves(rows: int) -> tuple[int, int]:
    left = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    return left, max(1, -(-rows // left))


def _keys(seed: int, back: bool) -> Column:
    def key(number: int) -> int:
        digest = hashlib.sha256(f"{seed}:{number}".encode()).digest()
        return int.from_bytes(digest[:8], "little", signed=True)

    numbers = reversed(range(ROUNDS)) if back else range(ROUNDS)
    return F.array(
        *(F.struct(F.lit(n % 2 == 0).alias("on_left"), F.lit(key(n)).cast("long").alias("key")) for n in numbers)
    )


def _once(value: Column, rows: int, seed: int, back: bool = False) -> Column:
    """One pass of the network over ``left x right`` values."""
    left, right = halves(rows)
    low = value % right

    def turn(half, other, size, key):
        by = F.pmod(F.xxhash64(key, other), F.lit(size).cast("long"))
        return F.pmod(half - by if back else half + by, F.lit(size).cast("long"))

    def round_of(state, step):
        a, b, key = state["a"], state["b"], step["key"]
        return F.struct(
            F.when(step["on_left"], turn(a, b, left, key)).otherwise(a).alias("a"),
            F.when(step["on_left"], b).otherwise(turn(b, a, right, key)).alias("b"),
        )

    start = F.struct(((value - low) / right).cast("long").alias("a"), low.cast("long").alias("b"))
    return F.aggregate(_keys(seed, back), start, round_of, lambda state: state["a"] * right + state["b"])


def permuted(frame: DataFrame, number: str, into: str, rows: int, seed: int = SEED, back: bool = False) -> DataFrame:
    """``into``: the place of row ``number`` among ``rows``, or with ``back`` the row at a place."""
    left, right = halves(rows)
    outside = left * right - rows
    walk = F.aggregate(
        F.sequence(F.lit(0), F.lit(outside)),
        F.col(into),
        lambda value, _: F.when(value < rows, value).otherwise(_once(value, rows, seed, back)),
    )
    once = frame.withColumn(into, _once(F.col(number).cast("long"), rows, seed, back))
    return once.withColumn(into, F.when(F.col(into) < rows, F.col(into)).otherwise(walk))


def assign(frame: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Every row of a narrow frame with ``shard`` and ``slot``; ``order`` gives the row numbers."""
    rows, total = numbered(frame, order, "_row", "shards")
    placed = permuted(rows, "_row", "_place", total, seed)
    shard = F.col("_place") % shards
    return placed.select(
        *frame.columns,
        shard.cast("int").alias("shard"),
        ((F.col("_place") - shard) / shards).cast("long").alias("slot"),
    )


def row_at(frame: DataFrame, rows: int, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Adds ``row_number``: which row of ``rows`` lies at the frame's ``shard`` and ``slot``."""
    place = frame.withColumn("_place", F.col("slot") * shards + F.col("shard"))
    return permuted(place, "_place", "row_number", rows, seed, back=True).drop("_place")


def described(docs: DataFrame) -> DataFrame:
    """What sharding needs to know of each document, so that texts are not sorted."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, text_crc32, shard, slot. Row numbers follow doc_id."""
    return assign(described(docs), ["doc_id", "text_crc32", "size"], shards, seed)


def write_shards(rows: DataFrame, path: str) -> None:
    """Rows with shard and slot as a folder for each shard, its files in the order of slots."""
    ordered = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)


def op10_feistel_shards(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_documents(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
