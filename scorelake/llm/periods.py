"""Runs of repeated words: all maximal periodic stretches of a text, and the text without repeats.

A run is a stretch of consecutive words with smallest period q (words q apart are the same) and a
length of 2 q and ``LEAST`` or more, which no neighbouring word extends with that period. Words
are what lies between ASCII white space.

Finding them is internal pattern matching, on some megabytes of whole texts together:

1. Names. The blocks of 2^k words that begin at each word get names by prefix doubling, for every
   k until all names differ; a name is where the block's interval in the suffix array begins.
   Words of different texts count as different, so nothing is found across texts. Names tell how
   far two places agree, ahead or behind, exactly and in as many steps as there are levels.
2. Wavelet tree over the suffix array, which tells the next occurrence of a block after a place:
   the smallest suffix in its interval that is not before the place (range successor).
3. Blocks. A run of period q, 2L-1 <= q <= 4L-2 for a power of two L, holds in its first q words a
   block of L words that begins at a multiple of L, and holds it again q words later. So for every
   such block the occurrences in the window from 2L-1 to 4L-2 words further on are candidates:
   all periods fall into the window of one level.
4. Progressions. Occurrences that overlap by half or more are an arithmetic progression whose
   difference is the block's own period. It is told from its first two members and how far the
   period goes; its members are candidates, unless the block lies in the same periodic stretch
   (then they are multiples of that period).
5. Each candidate is extended in both directions. Of those with the same ends the smallest period
   is the run's.

Each text is worked on in one task and whole; a text of n words takes some 10 log2(n) bytes a word.
Nothing is shuffled.

Defined results: a null or empty text, or one of white space, has no words, no runs and an empty
collapsed text; equal rows get equal results; an empty table gives no rows; other columns are kept
in ``row`` whatever their names. Collapsed texts have one space between words.
"""

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.llm.common import arrow_map, chunks, documents

#: Words that a run has at least.
LEAST = 12
#: Bytes of text worked on together; a longer text is worked on alone.
AT_ONCE = 2 << 20


class Names:
    """Names of all blocks of 2^k words, and the suffix array."""

    def __init__(self, words: np.ndarray):
        count = len(words)
        self.count = count
        self.order = np.argsort(words, kind="stable")
        new = np.flatnonzero(np.diff(words[self.order], prepend=-1))
        sizes = np.diff(np.append(new, count))
        name = np.empty(count, np.int64)
        name[self.order] = np.repeat(new, sizes)
        self.levels: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        active = self.order[np.repeat(sizes, sizes) > 1]
        while len(active):
            self.levels.append(name.astype(np.int32))
            self.sizes.append(np.bincount(name, minlength=count).astype(np.int32))
            name, active = self._doubled(name, active, 1 << (len(self.levels) - 1))

    def _doubled(self, name: np.ndarray, active: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of blocks twice as long; only blocks that share their name are sorted again."""
        after = active + width
        second = np.where(after < self.count, name[np.minimum(after, self.count - 1)] + 1, 0)
        first = name[active]
        key = first * (self.count + 1) + second
        sorting = np.argsort(key, kind="stable")
        active, first, key = active[sorting], first[sorting], key[sorting]
        at = np.arange(len(active))
        group = np.maximum.accumulate(np.where(np.diff(first, prepend=-1) != 0, at, 0))
        begins = np.diff(key, prepend=-1) != 0
        equal = np.maximum.accumulate(np.where(begins, at, 0))
        self.order[first + at - group] = active
        name = name.copy()
        name[active] = first + equal - group
        alone = begins & np.append(begins[1:], True)
        return name, active[~alone]

    def ahead(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many words from ``one`` on are the same as from ``two`` on (which is further on)."""
        same = np.zeros(len(one), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            names = self.levels[level]
            at = two + same
            equal = (at < self.count) & (names[np.minimum(at, self.count - 1)] == names[np.minimum(one + same, self.count - 1)])
            same += equal.astype(np.int64) << level
        return same

    def behind(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many words before ``one`` are the same as before ``two`` (which is further on)."""
        same = np.zeros(len(one), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            names = self.levels[level]
            at = one - same - (1 << level)
            equal = (at >= 0) & (names[np.maximum(at, 0)] == names[np.maximum(at + two - one, 0)])
            same += equal.astype(np.int64) << level
        return same


class Wavelet:
    """Wavelet tree, its nodes of one depth side by side: how many zeros precede each place."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one, dtype=np.int32)]).astype(np.int32))
            values = np.concatenate([values[~one], values[one]])

    def less(self, low: np.ndarray, high: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values in places [low, high) are below ``limit``."""
        total = np.where(limit >> self.bits > 0, high - low, 0)
        for depth, zeros in enumerate(self.zeros):
            one = (limit >> (self.bits - 1 - depth) & 1).astype(bool)
            low_zeros, high_zeros = zeros[low], zeros[high]
            total = total + np.where(one & (limit >> self.bits == 0), high_zeros - low_zeros, 0)
            low = np.where(one, zeros[-1] + low - low_zeros, low_zeros)
            high = np.where(one, zeros[-1] + high - high_zeros, high_zeros)
        return total

    def nth(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value with that rank, from 0, in places [low, high)."""
        value = np.zeros(len(low), np.int64)
        for depth, zeros in enumerate(self.zeros):
            low_zeros, high_zeros = zeros[low], zeros[high]
            here = high_zeros - low_zeros
            one = rank >= here
            rank = np.where(one, rank - here, rank)
            value |= one.astype(np.int64) << (self.bits - 1 - depth)
            low = np.where(one, zeros[-1] + low - low_zeros, low_zeros)
            high = np.where(one, zeros[-1] + high - high_zeros, high_zeros)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The smallest value that is ``limit`` or more in places [low, high); -1 where there is none."""
        rank = self.less(low, high, limit)
        value = self.nth(low, high, np.minimum(rank, high - low - 1))
        return np.where(rank < high - low, value, -1)


def candidates(names: Names, tree: Wavelet, starts: np.ndarray, text: np.ndarray, level: int):
    """Yields (place, period) of the blocks of 2^level words: their occurrences in the window behind.

    ``starts`` has where each text begins, ``text`` the text of each word.
    """
    length = 1 << level
    name, size = names.levels[level], names.sizes[level]
    block = np.arange(0, names.count, length)
    block = block[size[name[block]] > 1]
    begin = starts[text[block]]
    low = name[block].astype(np.int64)
    high = low + size[low]
    from_here, until = block - begin + 2 * length - 1, block - begin + 4 * length - 2
    last = np.full(len(block), -1)
    while len(block):
        found = tree.successor(low, high, from_here)
        there = (found >= 0) & (found <= until)
        block, begin, low, high, until, found, last = (
            values[there] for values in (block, begin, low, high, until, found, last)
        )
        yield block, found + begin - block
        step = found - last
        # Of two occurrences in a row that overlap by half, the distance is the block's period.
        row = (last >= 0) & (2 * step <= length)
        from_here = found + 1
        if row.any():
            at, step = block[row], step[row]
            first = last[row] + begin[row]
            periodic = names.ahead(first, first + step)
            members = np.maximum((periodic + step - length) // step, 1)
            members = np.minimum(members, (until[row] + begin[row] - first) // step)
            same = ((first - at) % step == 0) & (names.ahead(at, at + step) >= first - at)
            more = np.where(same, 0, members - 1)
            which = np.repeat(np.arange(len(at)), more)
            number = np.arange(len(which)) - np.repeat(np.cumsum(more) - more, more) + 2
            yield at[which], first[which] + number * step[which] - at[which]
            from_here[row] = first + members * step - begin[row] + 1
            found = found.copy()
            found[row] = -1
        last = found


def runs_in(words: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs (place, length, period) of texts that lie one behind the other, by place and period.

    ``words`` are the numbers of the words, ``sizes`` how many words each text has.
    """
    none = np.zeros(0, np.int64)
    if not len(words):
        return none, none, none
    text = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    names = Names(text * (int(words.max()) + 1) + words)
    tree = Wavelet(names.order - starts[text[names.order]])
    places, lengths, periods = [none], [none], [none]
    longest = int(sizes.max())
    for level in range(len(names.levels)):
        if (4 << level) - 2 > longest:
            break
        for at, period in candidates(names, tree, starts, text, level):
            back = names.behind(at, at + period)
            length = back + names.ahead(at, at + period) + period
            good = length >= np.maximum(least, 2 * period)
            places.append((at - back)[good])
            lengths.append(length[good])
            periods.append(period[good])
    place, length, period = map(np.concatenate, (places, lengths, periods))
    order = np.lexsort((period, length, place))
    place, length, period = place[order], length[order], period[order]
    new = (np.diff(place, prepend=-1) != 0) | (np.diff(length, prepend=-1) != 0)
    place, length, period = place[new], length[new], period[new]
    order = np.lexsort((period, place))
    return place[order], length[order], period[order]


def kept_words(count: int, place: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words lie in no run behind its first period."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, place + period, 1)
    np.add.at(change, place + length, -1)
    return np.cumsum(change[:-1]) == 0


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic(texts: list[bytes | None], least: int = LEAST) -> tuple[pa.Array, pa.Array]:
    """For each text its runs, and the text without what repeats in them."""
    split = [(text or b"").split() for text in texts]
    sizes = np.array([len(words) for words in split], np.int64)
    known: dict[bytes, int] = {}
    flat = list(chain.from_iterable(split))
    words = np.fromiter((known.setdefault(word, len(known)) for word in flat), np.int64, len(flat))
    place, length, period = runs_in(words, sizes, least)
    keep = kept_words(len(flat), place, length, period)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    cuts = np.searchsorted(place, np.append(starts, len(flat)))
    where = np.searchsorted(ends, place, side="right")
    items = pa.StructArray.from_arrays(
        [pa.array(values, pa.int64()) for values in (place - starts[where], length, period)], names=["start", "length", "period"]
    )
    runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), items)
    collapsed = []
    for own, start, first, last in zip(split, starts, cuts, cuts[1:]):
        if last > first:
            own = [word for word, stays in zip(own, keep[start : start + len(own)].tolist(), strict=True) if stays]
        collapsed.append(b" ".join(own))
    return runs, pa.array(collapsed, pa.binary())


def collapse(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows as ``row``, the ``runs`` of their texts, and the ``collapsed`` texts."""

    def run(batches):
        for chunk in chunks(batches, "_text", AT_ONCE):
            runs, collapsed = periodic(chunk.column("_text").to_pylist(), least)
            yield pa.RecordBatch.from_arrays([chunk.column("row"), runs, collapsed], names=["row", "runs", "collapsed"])

    others = [F.col(f"`{name}`") for name in docs.columns if name.lower() != "text"]
    rows = docs.select(
        F.struct(*(others or [F.lit(None).cast("int").alias("none")])).alias("row"), F.col("text").cast("binary").alias("_text")
    )
    added = T.StructType.fromDDL("runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    found = arrow_map(rows, run, T.StructType([rows.schema["row"], *added]))
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """The documents (doc_id, text), a tenth of them with words that repeat to the end, by their id's checksum."""
    check = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    rest = F.expr("check div 10")
    made = docs.select("doc_id", "text", check.alias("check"), F.when(check % 10 == 0, words).alias("words"))
    made = made.select("doc_id", "text", "words", rest.alias("g"), F.size("words").cast("long").alias("n"))
    made = made.withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0L, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return made.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_dyadic_runs(spark, sf_dir):
    found = collapse(with_repeats(documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda run: F.struct(run["length"].alias("length"), (-run["start"]).alias("before"), (-run["period"]).alias("shorter"))))
    lines = F.transform("runs", lambda run: F.format_string("%d,%d,%d\n", run["start"], run["length"], run["period"]))
    found = found.select("row.doc_id", "runs", "collapsed", best.alias("best"), F.array_join(lines, "").alias("lines"))
    found = found.withColumn("length", F.col("best.length")).withColumn("period", -F.col("best.shorter"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        "length",
        "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
