"""Importance resampling towards a target's distribution of words and pairs of words.

Features are words (A-Z lowered) and pairs of neighbouring words, hashed by CRC-32 into
``BUCKETS``. A bucket's gain tells how much more often the target's features fall into it than the
corpus's, a text's weight is the mean gain of its features, and texts are drawn without replacement
by their weight plus Gumbel noise from a hash of the id.

A vocabulary of two parts makes bucket numbers cheap and keeps them exact:

- Head. All words of the corpus are counted; the most frequent ones are broadcast with their CRC
  states, of the word and of the word with the blank behind it. The pairs of the most frequent of
  these are counted too, and the buckets of the frequent pairs are broadcast as a table.
- Tail. Any other word's CRC is taken directly; any other pair's by carrying on from the state of
  its first word.

Both parts give the same numbers as hashing the feature's own bytes, so bucket totals and weights
do not depend on where the head ends. What is broadcast is bounded: ``HEAD`` words of ``LONGEST``
bytes at most, ``PAIR_WORDS`` squared buckets, ``BUCKETS`` gains; the driver gets no more than
that. Words are counted in every task before they are shuffled, so a hot word is one row for each
task; ranks come from a range sort in which equal rows are told apart.

Defined results: a null or empty text has no words, no features and weight 0; words are runs of
ASCII letters and digits and of all characters beyond ASCII; a null doc_id counts as an empty one
in the noise and comes last among ties; repeated rows are each scored and ranked; without a
document of ``LEAST_WORDS`` words none is drawn; an empty table gives no rows, an empty target
equal gains for equal buckets; other columns are not looked at.
"""

import hashlib
import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import arrow_map, chunks, documents, numbered, saved

BUCKETS = 10_000
#: Words of the head and their bytes at most; words whose pairs may be in the head, and how many pairs.
HEAD = 1 << 16
LONGEST = 32
PAIR_WORDS = 1024
HEAD_PAIRS = 1 << 17
#: Different words that a task holds before it hands their counts on.
HELD = 1 << 17
LEAST_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes | None) -> list[bytes]:
    # In UTF-8 all bytes of characters beyond ASCII are beyond 0x7F.
    return WORD.findall(text.lower()) if text else []


def texts_of(frame: DataFrame) -> DataFrame:
    return frame.select(F.col("text").cast("binary").alias("text"))


def word_counts(frame: DataFrame) -> DataFrame:
    """(word, n) of words that are short enough for the head."""

    def run(batches):
        held: Counter = Counter()
        for chunk in chunks(batches, "text"):
            held.update(chain.from_iterable(map(words_of, chunk.column("text").to_pylist())))
            if len(held) > HELD:
                yield told(held)
                held = Counter()
        yield told(held)

    def told(held: Counter) -> pa.RecordBatch:
        short = [(word, n) for word, n in held.items() if len(word) <= LONGEST]
        columns = [pa.array([word for word, _ in short], pa.binary()), pa.array([n for _, n in short], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    return arrow_map(texts_of(frame), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows with the highest ``n``, ``most`` of them or fewer: whole levels, a sixteenth of a power of two each.

    Levels are counted instead of sorting the rows, which might bring all of them into one task.
    """
    level = F.floor(16 * F.log2("n")).cast("int").alias("level")
    sizes = counts.groupBy(level).agg(F.count(F.lit(1)).alias("rows")).collect()  # some hundred levels at most
    least, rows = None, 0
    for size in sorted(sizes, reverse=True):
        rows += size["rows"]
        if rows > most:
            break
        least = size["level"]
    if least is None:
        return counts.limit(0)
    return counts.filter(F.floor(16 * F.log2("n")) >= least)


@dataclass
class Head:
    """Frequent words with their CRC states, and the buckets of frequent pairs (-1 for other pairs)."""

    words: list[bytes]
    pairs: np.ndarray

    def __post_init__(self):
        self.number = {word: at for at, word in enumerate(self.words)}
        self.own = np.array([zlib.crc32(word) for word in self.words], np.uint32)
        self.open = np.array([zlib.crc32(word + b" ") for word in self.words], np.uint32)

    def __reduce__(self):
        return Head, (self.words, self.pairs)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Each word's number in the head, -1 in the tail."""
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))

    def buckets(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all words, buckets of all pairs by their second word (-1 where a text begins), words of each text."""
        split = [words_of(text) for text in texts]
        sizes = np.array([len(words) for words in split], np.int64)
        words = list(chain.from_iterable(split))
        number = self.numbers(words)
        tail = np.flatnonzero(number < 0)
        own, state = np.zeros(len(words), np.uint32), np.zeros(len(words), np.uint32)
        known = number >= 0
        own[known], state[known] = self.own[number[known]], self.open[number[known]]
        others = [words[at] for at in tail.tolist()]
        own[tail] = np.fromiter(map(zlib.crc32, others), np.uint32, len(others))
        state[tail] = np.fromiter(map(zlib.crc32, repeat(b" "), own[tail].tolist()), np.uint32, len(others))
        pair = np.full(len(words), -1, np.int64)
        follows = np.ones(len(words), bool)
        follows[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
        second = np.flatnonzero(follows)
        one, two = number[second - 1], number[second]
        frequent = (one >= 0) & (two >= 0) & (one < PAIR_WORDS) & (two < PAIR_WORDS)
        pair[second[frequent]] = self.pairs[one[frequent], two[frequent]]
        direct = second[pair[second] < 0]
        found = map(zlib.crc32, [words[at] for at in direct.tolist()], state[direct - 1].tolist())
        pair[direct] = np.fromiter(found, np.int64, len(direct)) % BUCKETS
        return own.astype(np.int64) % BUCKETS, pair, sizes


def head_of(docs: DataFrame) -> Head:
    """The head of the corpus's vocabulary."""
    counts = saved(word_counts(docs), "word-counts")
    rows = most_frequent(counts, HEAD).collect()
    words = [bytes(row["word"]) for row in sorted(rows, key=lambda row: (-row["n"], row["word"]))]
    head = Head(words, np.full((PAIR_WORDS, PAIR_WORDS), -1, np.int16))
    known = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        total = np.zeros(PAIR_WORDS * PAIR_WORDS, np.int64)
        for chunk in chunks(batches, "text"):
            # A text's last word and the next one's first are parted by a number that no pair has.
            split = [[*words_of(text), b""] for text in chunk.column("text").to_pylist()]
            number = known.value.numbers(list(chain.from_iterable(split)))
            number[number >= PAIR_WORDS] = -1
            there = (number[:-1] >= 0) & (number[1:] >= 0)
            total += np.bincount((number[:-1] * PAIR_WORDS + number[1:])[there], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["pair", "n"])

    pairs = arrow_map(texts_of(docs), run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    for row in most_frequent(saved(pairs, "pair-counts"), HEAD_PAIRS).collect():
        one, two = divmod(row["pair"], PAIR_WORDS)
        head.pairs[one, two] = zlib.crc32(words[two], int(head.open[one])) % BUCKETS
    known.destroy()
    return head


def bucket_totals(frame: DataFrame, head: Head) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    known = frame.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for chunk in chunks(batches, "text"):
            own, pair, _ = known.value.buckets(chunk.column("text").to_pylist())
            total += np.bincount(own, minlength=BUCKETS) + np.bincount(pair[pair >= 0], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    totals = np.zeros(BUCKETS, np.int64)
    counted = arrow_map(texts_of(frame), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in counted.collect():  # a row for each bucket at most
        totals[row["bucket"]] = row["n"]
    known.destroy()
    return totals


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths, floored."""
    total, wanted = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [
            math.floor(1000 * math.log((float(t) + 1) * total / ((float(s) + 1) * wanted)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise_of(doc_id, seed: int) -> int:
    """Gumbel noise in thousandths, floored, from a hash of the id."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    draw = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((draw + 0.5) / 4294967296)))


def weighed(docs: DataFrame, head: Head, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    known = docs.sparkSession.sparkContext.broadcast((head, gains))
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches):
        head, gains = known.value
        for chunk in chunks(batches, "text"):
            own, pair, sizes = head.buckets(chunk.column("text").to_pylist())
            sums = np.concatenate([[0], np.cumsum(gains[own] + np.where(pair >= 0, gains[pair], 0))])
            ends = np.cumsum(sizes)
            features = np.maximum(2 * sizes - 1, 0)
            weight = (sums[ends] - sums[ends - sizes]) // np.maximum(features, 1)
            noise = np.array([noise_of(doc_id, seed) for doc_id in chunk.column("doc_id").to_pylist()], np.int64)
            columns = [chunk.column("doc_id"), *map(pa.array, (sizes, features, weight, weight + noise))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return arrow_map(rows, run, ", ".join(f"{name} long" for name in names))


def drawn(rows: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Weighed rows with their ``rank``, null for those that are not drawn."""
    rows = saved(rows, "weighed")
    may = rows.filter(F.col("n_words") >= least_words)
    keyed = may.withColumn("_low", -F.col("score")).withColumn("_none", F.col("doc_id").isNull())
    placed, total = numbered(keyed, ["_low", "_none", "doc_id"], "rank", "resampled")
    rank = F.col("rank") + 1
    ranked = placed.select(*rows.columns, F.when(rank <= percent * total // 100, rank).alias("rank"))
    others = rows.filter(F.col("n_words") < least_words)
    return ranked.unionAll(others.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, seed: int = SEED, percent: int = DRAWN_PERCENT) -> DataFrame:
    """Every document's weight, score and rank for texts like the target's."""
    head = head_of(docs)
    gains = gains_of(bucket_totals(docs, head), bucket_totals(target, head))
    return drawn(weighed(docs, head, gains, seed), percent)


def op11_head_tail_resampling(spark, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample(documents(spark, sf_dir), target).select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 by its shift register, one bit a step.
ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, row_number() OVER () AS place, true AS is_doc,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
  UNION ALL
  SELECT item_id, row_number() OVER (), false,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark
), lists AS (
  SELECT doc_id, place, is_doc, len(words) AS n,
    list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS features
  FROM texts
), counted AS (
  SELECT place, is_doc, feature, count(*) AS times
  FROM (SELECT place, is_doc, unnest(features) AS feature FROM lists) GROUP BY ALL
), steps AS (
  -- Eight steps for each byte: the byte comes in with the first, each shifts one bit out.
  SELECT feature, list_reduce(
      list_transform(range(8 * octet_length(encode(feature))), lambda i:
        CASE WHEN i % 8 = 0 THEN ('0x' || substr(hex(encode(feature)), i // 4 + 1, 2))::BIGINT ELSE 0 END),
      lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT) AS state
  FROM (SELECT DISTINCT feature FROM counted)
), buckets AS (
  SELECT feature, xor(state, 4294967295) % 10000 AS bucket FROM steps
), hits AS (
  SELECT place, is_doc, bucket, sum(times) AS times FROM counted JOIN buckets USING (feature) GROUP BY ALL
), totals AS (
  SELECT bucket, coalesce(sum(times) FILTER (is_doc), 0)::DOUBLE AS s, coalesce(sum(times) FILTER (NOT is_doc), 0)::DOUBLE AS t
  FROM hits GROUP BY bucket
), sums AS (SELECT sum(s) + 10000 AS ss, sum(t) + 10000 AS tt FROM totals),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ss / ((s + 1) * tt)))::BIGINT AS gain FROM totals, sums
), weights AS (
  SELECT place, sum(times * gain) AS total FROM hits JOIN gains USING (bucket) WHERE is_doc GROUP BY place
), scored AS (
  SELECT doc_id, n, greatest(2 * n - 1, 0) AS n_features,
    CASE WHEN n = 0 THEN 0 ELSE floor(total / (2 * n - 1)) END::BIGINT AS weight,
    ('0x' || sha256('7:' || doc_id)[1:8])::BIGINT AS h
  FROM lists LEFT JOIN weights USING (place) WHERE is_doc
), final AS (
  SELECT doc_id, n, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM scored
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS may FROM final WHERE n >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * may // 100 THEN rank END AS rank
FROM final LEFT JOIN ranked USING (doc_id)
"""
