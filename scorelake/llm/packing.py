"""Packing token sequences by exact complements, then best fit.

Each document becomes its ids and an end id; what is longer than a sequence is cut into full
pieces, of which the first one in the text may be shorter. Which pieces share a sequence depends
on lengths alone, so it is planned on the number of pieces of each length: at most ``capacity``
numbers, however many documents there are.

The plan goes from the longest length down. For the gap that a piece leaves, an index of the
sums of one, two and three available lengths (a bit for each sum) tells whether some combination
fills it exactly; the combination is used as often as its lengths are available, and a length
that runs out leaves the index. Pieces that nothing fills exactly are placed best fit, longest
first, whole groups of equal sequences at a time. Each step uses up a length or a group, so the
plan's size is bounded by the capacity too.

Pieces then find their place in parallel: a piece's rank among those of its length picks the
sequence and the offset from the plan. Ranks come from counts for each task and length.

Defined results: a null text is an empty one, which is the end id alone; equal rows are packed
as pieces of their own; an empty table has no pieces; other columns are not looked at.
"""

import re
import zlib
from array import array
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.bpe import SPACE, VOCABULARY, vocabulary
from scorelake.llm.common import arrow_map, chunks, documents, saved

CAPACITY = 2048
END_ID = 0
PIECES = """doc_id long, piece int, start long, length int, ids_crc32 long, ids binary,
part int, at long"""


class Encoder:
    """The ids of the vocabulary file, by a library that runs its merges natively.

    The pattern's look-ahead only parts a run of white space from the one character of it that
    goes with the next word. Cutting the text there first allows a pattern without it, which
    the library runs without backtracking.
    """

    def __init__(self, path: str):
        words = vocabulary(path)
        order = sorted((turn, number) for number, turn in enumerate(words.turn) if turn >= 0)
        if [number for _, number in order] != sorted(number for _, number in order):
            raise ValueError("ids must follow the order of merges")
        special = set(words.special.values())
        ranks = {token: number for number, token in enumerate(words.tokens) if token and number not in special}
        pattern = public_tokenizers.PATTERN.replace(r"\s+(?!\S)|", "")
        self.run = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special, self.cut = words.special, words.cut
        # The pattern's own class of white space, which is not Python's.
        self.gap = re.compile(f"(?<=[{SPACE}])(?=[{SPACE}][^{SPACE}])")

    def ids(self, text: str) -> list[int]:
        if self.cut is not None and self.cut.search(text):
            return [n for part in self.cut.split(text) for n in self._part(part)]
        return self._plain(text)

    def _part(self, part: str) -> list[int]:
        return [self.special[part]] if part in self.special else self._plain(part)

    def _plain(self, text: str) -> list[int]:
        if self.gap.search(text):
            return [n for part in self.gap.split(text) for n in self.run(part)]
        return self.run(text)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """The pieces of every document, numbered within task and length by ``part`` and ``at``."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encode = encoder(path).ids
        for chunk in chunks(batches, "text"):
            rows = []
            for doc, text in zip(chunk.column("doc_id").to_pylist(), chunk.column("text").to_pylist(), strict=True):
                ids = array("I", encode(text or ""))
                ids.append(END_ID)
                first = len(ids) % capacity or capacity
                begins = [0, *range(first, len(ids), capacity)]
                for piece, begin in enumerate(begins):
                    end = first if piece == 0 else begin + capacity
                    raw = ids[begin:end].tobytes()
                    length = end - begin
                    rows.append((doc, piece, begin, length, zlib.crc32(raw), raw if with_ids else None, part, int(seen[length])))
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)],
                names=[column.split()[0] for column in PIECES.split(",")],
            )

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, PIECES)


class Sums:
    """Which sums one, two or three available lengths can have, as bits of three integers."""

    def __init__(self, counts: list[int], capacity: int):
        self.counts, self.within = counts, (1 << (capacity + 1)) - 1
        self.refresh()

    def refresh(self) -> None:
        lengths = [length for length, count in enumerate(self.counts) if count and length]
        self.one = sum(1 << length for length in lengths)
        self.two = self.three = 0
        for length in lengths:
            self.two |= self.one << length
        self.two &= self.within
        for length in lengths:
            self.three |= self.two << length
        self.three &= self.within

    def fills(self, gap: int):
        """Combinations of one to three lengths with this sum, those with the longest length first."""
        if self.one >> gap & 1:
            yield (gap,)
        if self.two >> gap & 1:
            yield from self._pairs(gap)
        if self.three >> gap & 1:
            for last in range(gap - 2, 0, -1):
                if self.one >> last & 1 and self.two >> (gap - last) & 1:
                    yield from ((last, *pair) for pair in self._pairs(gap - last) if pair[0] <= last)

    def _pairs(self, gap: int):
        for long in range(gap - 1, (gap - 1) // 2, -1):
            if self.one >> long & 1 and self.one >> (gap - long) & 1:
                yield (long, gap - long)


def exact_groups(counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Groups of full sequences, as (lengths, how many); ``counts`` keeps what is left over."""
    groups, index = [], Sums(counts, capacity)
    if counts[capacity]:
        groups.append(((capacity,), counts[capacity]))
        counts[capacity] = 0
        index.refresh()
    for length in range(capacity - 1, 0, -1):
        while counts[length]:
            for fill in index.fills(capacity - length):
                lengths = (length, *fill)
                times = min(counts[one] // lengths.count(one) for one in set(lengths))
                if times:
                    break
            else:
                break
            groups.append((lengths, times))
            for one in lengths:
                counts[one] -= times
            if not all(counts[one] for one in lengths):
                index.refresh()
    return groups


def best_fit_groups(counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, of all pieces that are left; equal sequences move as a group."""
    by_gap: dict[int, list] = {}
    gaps: list[int] = []

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(lengths)
        if gap not in by_gap:
            by_gap[gap] = []
            gaps.insert(bisect_left(gaps, gap), gap)
        by_gap[gap].append((lengths, times))

    for length in range(capacity, 0, -1):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                full, rest = divmod(left, capacity // length)
                if full:
                    put((length,) * (capacity // length), full)
                if rest:
                    put((length,) * rest, 1)
                break
            gap = gaps[at]
            lengths, times = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap], gaps[at]
            taken = min(left, times)
            if times > taken:
                put(lengths, times - taken)
            put((*lengths, length), taken)
            left -= taken
    return [group for gap in gaps for group in by_gap[gap]]


def plan(counts: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """Where pieces go, by length and rank: rows (length, first rank, sequence, offset, together).

    From the first rank on, ``together`` pieces at a time lie side by side in one sequence, the
    next ones in the sequence after it.
    """
    left = list(counts)
    groups = exact_groups(left, capacity) + best_fit_groups(left, capacity)
    ranks, places, sequence = [0] * (capacity + 1), [], 0
    for lengths, times in groups:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            together = lengths.count(length)
            places.append((length, ranks[length], sequence, offset, together))
            ranks[length] += together * times
            offset += together * length
        sequence += times
    return np.array(sorted(places), dtype=np.int64).reshape(-1, 5), sequence


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``. ``cut`` is a table that was written once."""
    in_task = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = in_task.select("part", "length", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    counts = [0] * (capacity + 1)
    # At most one row for each length.
    for row in cut.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    places, _ = plan(counts, capacity)
    keys = places[:, 0] << 44 | places[:, 1]

    def find(batches):
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = pc.add(batch.column("at"), batch.column("_start")).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, lengths << 44 | rank, side="right") - 1
            _, first, sequence, offset, together = places[at].T
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence + (rank - first) // together), pa.array(offset + (rank - first) % together * lengths)],
                names=[*names, "sequence_id", "offset"],
            )

    names = [name for name in cut.columns if name not in ("part", "at")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema if f.name in names)
    ranked = cut.join(starts, ["part", "length"])
    return arrow_map(ranked, find, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves: sequence_id and the ids of its pieces in their order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` ids
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda ids, part: F.concat(ids, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset."""
    cut = pieces(docs, capacity, path, with_ids)
    return pack(saved(cut if with_ids else cut.drop("ids"), "pieces"), capacity)


def op7_exact_complement_packing(spark, sf_dir):
    packed = pack_documents(documents(spark, sf_dir))
    return packed.withColumn("length", F.col("length").cast("long"))
