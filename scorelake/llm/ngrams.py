"""Scoring by an interpolated modified Kneser-Ney model of word pairs.

Tokens are words (between ASCII white space, A-Z lowered) and an end for each text; the first one
follows a begin. With c the counts in the training texts, f_i(u) how many different tokens follow
u just i times, and k(w) how many different tokens w follows:

    p(w | u) = max(c(uw) - D_c(uw), 0) / c(u) + (D_1 f_1(u) + D_2 f_2(u) + D_3 f_3+(u)) / c(u) * p(w)
    p(w)     = max(k(w) - E_k(w), 0) / sum of k + (E_1 m_1 + E_2 m_2 + E_3 m_3+) / sum of k / (V + 1)

D and E are the modified discounts, from how many pairs occur one to four times, and how many
words follow one to four tokens. The V + 1-st token is the unknown one; behind a token that the
training texts don't have, p(w) alone counts.

How it is built and used; everything is counted, nothing is cut off:

1. Words are counted by 64-bit hash. Words so frequent that their pairs would make a shard too
   large are told from these counts; their pairs are spread over several groups.
2. Pairs are counted in blocks of whole texts, and each block's pairs are dealt to shards by the
   first word's group. A shard, some ``SHARD_TOKENS`` tokens at most, merges its runs, writes the
   pairs and their counts to the shared folder, and hands on f_i and k.
3. These are summed by word. Words are range-sorted by hash and written as sorted arrays of some
   ``WORD_ROWS`` with their counts, remaining weights and p(w).
4. Each shard maps the word arrays and turns its counts into gains: by how much the logarithm of
   p(w | u) is over that of what remains behind u times p(w). It writes the sorted array of pair hashes
   with their gains.
5. A block of texts maps the word arrays and looks its sorted words up, which gives the score as if
   no pair were known. Its sorted pairs go to the shards with the texts they are in; the task that
   has a shard maps its arrays, looks all up at once, and returns the sum of gains for each text.

Nothing of the model is broadcast or held in memory whole: a task maps one array at a time. The
driver gets the totals above, the first hash of each word array, and the very frequent words (four
for each shard at most). For scoring, each different pair of a block is shuffled once.

Hashes of different words, or pairs, are taken as different: among 10^9 of them, two are the same
with a probability of 3 %, which would give these two the sum of their counts.

Defined results: a null or empty text, or one of white space, is its end alone; repeated rows
count and are scored each; a null doc_id counts as an empty one where the training texts are
chosen; with no training text the model gives every token 1, an empty table gives no rows; other
columns are not looked at.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm.arrays import from_planes, has_array, in_planes, read_array, steps, write_array
from scorelake.llm.common import arrow_map, chunks, documents, forget, saved, ship
from scorelake.session import work_folder
from scorelake.sources import storage

#: Tokens for each shard of the pairs, rows of a word array, bytes of text in a block.
SHARD_TOKENS = 1 << 20
WORD_ROWS = 1 << 20
BLOCK_BYTES = 6 << 20
MOST_TASKS = 1 << 16
BEGIN, END = (np.uint64(xxhash.xxh64_intdigest(name)) for name in (b" begin", b" end"))
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_FOLLOWERS = ["f1", "f2", "f3", "f4", "more"]


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * _MIX
    return value ^ (value >> np.uint64(29))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(first * _STEP) + second)


class Block:
    """The tokens of some whole texts: numbers of each token and of the one before it.

    Number 0 is the begin, 1 the end, words follow; ``hashes`` has the hash of each.
    """

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        flat = split.flatten()
        there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        own = np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy())[there]
        coded = flat.filter(pa.array(there)).dictionary_encode()
        words = coded.indices.to_numpy()
        self.sizes = np.bincount(own, minlength=len(texts)) + 1  # tokens of each text
        ends = np.cumsum(self.sizes)
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), self.sizes)
        self.token = np.ones(len(self.text), np.int32)
        inside = np.ones(len(self.text), bool)
        inside[ends - 1] = False
        self.token[inside] = words + 2
        self.before = np.zeros_like(self.token)
        self.before[1:] = self.token[:-1]
        self.before[ends - self.sizes] = 0
        known = coded.dictionary.cast(pa.binary()).to_pylist()
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
        self.hashes = np.concatenate([np.array([BEGIN, END]), hashes])

    def codes(self) -> np.ndarray:
        """Each token's pair, as one number."""
        return self.before.astype(np.int64) << 32 | self.token

    def of_codes(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.hashes[codes >> 32], self.hashes[codes & 0xFFFFFFFF]


@dataclass
class Shards:
    """Which shard has a pair: by its first word, or where that is very frequent by both."""

    count: int
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    parts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    def of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        group = _mixed(first)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, first), len(self.hot) - 1)
            split = self.hot[at] == first
            part = _mixed(second[split] * _STEP) % self.parts[at[split]]
            group[split] = _mixed(group[split] + part * _STEP)
        return ((group >> np.uint64(32)) * np.uint64(self.count) >> np.uint64(32)).astype(np.int64)


@dataclass
class Model:
    """Where the arrays are, and the totals. Word arrays go by name and first hash."""

    folder: str
    shards: Shards
    tokens: int
    types: int
    discounts: list[float]
    unknown: float
    names: list[str]
    firsts: np.ndarray

    def of_words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, remaining weight behind it, and p of each of the ascending hashes."""
        count, rest = np.zeros(len(hashes), np.int64), np.ones(len(hashes))
        likely = np.full(len(hashes), self.unknown)
        which = np.searchsorted(self.firsts, hashes, side="right") - 1
        borders = np.searchsorted(which, np.arange(len(self.firsts) + 1))
        for number, file in enumerate(self.names):
            here = slice(borders[number], borders[number + 1])
            wanted = hashes[here]
            if not len(wanted):
                continue
            known = read_array(self.folder, f"words-{file}-hashes")
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            there = known[at] == wanted
            for values, name in ((count, "counts"), (rest, "rests"), (likely, "likely")):
                found = read_array(self.folder, f"words-{file}-{name}")[at[there]]
                values[here][there] = found
        return count, rest, likely

    def gains(self, shard: int, keys: np.ndarray) -> np.ndarray:
        """Gains of the pairs of a shard, 0 for those it does not have."""
        if not has_array(self.folder, f"pairs-{shard}-hashes"):
            return np.zeros(len(keys))
        known = read_array(self.folder, f"pairs-{shard}-hashes")
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        there = known[at] == keys
        found = np.zeros(len(keys))
        found[there] = read_array(self.folder, f"pairs-{shard}-gains")[at[there]]
        return found


def discounts_of(numbers: list[int]) -> list[float]:
    """The modified discounts for counts of 0 to 3 and more, from how many occur one to four times."""
    one, two, three, four = numbers
    if not (one and two):
        return [0.0, 0.5, 0.5, 0.5]
    share = one / (one + 2 * two)
    found = [1 - 2 * share * two / one, 2 - 3 * share * three / two, 3 - 4 * share * four / three if three else 1.5]
    return [0.0, *(min(max(value, 0.0), count + 1.0) for count, value in enumerate(found))]


def discounted(counts: np.ndarray, discounts: list[float]) -> np.ndarray:
    return np.maximum(counts - np.array(discounts)[np.minimum(counts, 3)], 0.0)


def texts_of(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, F.col("text").cast("string").alias("text"))


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def word_counts(docs: DataFrame) -> DataFrame:
    """(hash, n) of all tokens, ends included."""

    def run(batches):
        for chunk in chunks(batches, "text", BLOCK_BYTES):
            block = Block(chunk.column("text"))
            counts = np.bincount(block.token, minlength=len(block.hashes))
            yield pa.RecordBatch.from_arrays([signed(block.hashes[1:]), pa.array(counts[1:])], names=["hash", "n"])

    counts = arrow_map(texts_of(docs), run, "hash long, n long")
    return counts.filter("n > 0").groupBy("hash").agg(F.sum("n").alias("n"))


def shards_of(counts: DataFrame, tokens: int, shard_tokens: int) -> Shards:
    """As many shards as the tokens take, and the words that are too frequent for one group."""
    count = max(1, -(-tokens // shard_tokens))
    many = shard_tokens // 4
    rows = counts.filter(F.col("n") > many).collect()  # fewer than four for each shard
    # As many texts begin as end.
    hot = sorted((np.uint64(row["hash"] % 2**64) if row["hash"] != int(END.view(np.int64)) else BEGIN, row["n"]) for row in rows)
    return Shards(count, np.array([word for word, _ in hot], np.uint64), np.array([-(-n // many) for _, n in hot], np.uint64))


def pair_runs(docs: DataFrame, shards: Shards) -> DataFrame:
    """For each block and shard the different pairs: first words, how many follow each, these, and counts."""

    def run(batches):
        for chunk in chunks(batches, "text", BLOCK_BYTES):
            block = Block(chunk.column("text"))
            codes, counts = np.unique(block.codes(), return_counts=True)
            first, second = block.of_codes(codes)
            shard = shards.of(first, second)
            order = np.argsort(shard, kind="stable")  # within a shard, pairs of one first word stay together
            first, second, shard, counts = first[order], second[order], shard[order], counts[order].astype(np.uint32)
            rows = []
            for start, end in _stretches(shard):
                own = first[start:end]
                new = np.flatnonzero(_begins(own))
                fans = np.diff(np.append(new, end - start)).astype(np.uint32)
                packed = (own[new], fans, second[start:end], counts[start:end])
                rows.append((int(shard[start]), *map(in_planes, packed)))
            yield _batch(rows, "shard:int32 first fans second counts")

    return arrow_map(texts_of(docs), run, "shard int, first binary, fans binary, second binary, counts binary")


def _begins(values: np.ndarray) -> np.ndarray:
    """Where a stretch of equal values begins."""
    begins = np.ones(len(values), bool)
    begins[1:] = values[1:] != values[:-1]
    return begins


def _stretches(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each stretch of equal values."""
    borders = [*np.flatnonzero(_begins(values)).tolist(), len(values)]
    return list(zip(borders, borders[1:]))


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    """A batch of columns ``name:type``, binary where no type is given."""
    fields = [(name, kind or "binary") for name, _, kind in (column.partition(":") for column in names.split())]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    kinds = {"binary": pa.binary(), "int32": pa.int32(), "int64": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kinds[kind]) for values, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields]
    )


def merged_shards(runs: DataFrame, folder: str) -> DataFrame:
    """Writes each shard's pairs; returns by word hash how many tokens follow it one to four times and more, and k."""

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        runs = {name: table.column(name).to_pylist() for name in ("first", "fans", "second", "counts")}
        fans = [from_planes(raw, np.uint32) for raw in runs["fans"]]
        first = np.concatenate([np.repeat(from_planes(raw, np.uint64), fan) for raw, fan in zip(runs["first"], fans, strict=True)])
        second = np.concatenate([from_planes(raw, np.uint64) for raw in runs["second"]])
        counts = np.concatenate([from_planes(raw, np.uint32) for raw in runs["counts"]]).astype(np.int64)
        del runs, fans
        keys = pair_hashes(first, second)
        order = np.argsort(keys)
        new = np.flatnonzero(_begins(keys[order]))
        counts = np.add.reduceat(counts[order], new)
        first, second = first[order[new]], second[order[new]]
        order = np.argsort(first)
        first, second, counts = first[order], second[order], counts[order]
        begins = np.flatnonzero(_begins(first))
        fans = np.diff(np.append(begins, len(first)))
        kind = np.uint32 if counts.max() < 2**32 else np.int64
        for name, values in (("first", first[begins]), ("fans", fans), ("second", second), ("counts", counts.astype(kind))):
            write_array(folder, f"{shard}-{name}", values)
        times = np.minimum(counts, 5)
        followers = [np.add.reduceat((times == n).astype(np.int64), begins) for n in range(1, 6)]
        words, follows = np.unique(second, return_counts=True)
        columns = [signed(np.concatenate([first[begins], words]))]
        columns += [pa.array(np.concatenate([values, np.zeros(len(words), np.int64)])) for values in followers]
        columns.append(pa.array(np.concatenate([np.zeros(len(begins), np.int64), follows])))
        return pa.Table.from_arrays(columns, names=["hash", *_FOLLOWERS, "k"])

    ship(runs.sparkSession)
    return runs.groupBy("shard").applyInArrow(merge, "hash long, f1 long, f2 long, f3 long, f4 long, more long, k long")


def write_gains(spark: SparkSession, model: Model, counted: str) -> None:
    """From each shard's counts in the folder ``counted`` its arrays of pair hashes and gains."""

    def run(batches):
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                if has_array(counted, f"{shard}-first"):
                    write(shard)
            yield pa.RecordBatch.from_arrays([batch.column("id")], names=["shard"])

    def write(shard: int) -> None:
        fans = read_array(counted, f"{shard}-fans")
        heads, second = read_array(counted, f"{shard}-first"), read_array(counted, f"{shard}-second")
        c, rest, _ = model.of_words(heads)
        words, which = np.unique(second, return_inverse=True)
        left = np.repeat(rest * c, fans) * model.of_words(words)[2][which]
        counts = discounted(read_array(counted, f"{shard}-counts"), model.discounts)
        gains = np.log10(1 + counts / np.maximum(left, 1e-300))
        keys = pair_hashes(np.repeat(heads, fans), second)
        order = np.argsort(keys)
        write_array(model.folder, f"pairs-{shard}-hashes", keys[order])
        write_array(model.folder, f"pairs-{shard}-gains", gains[order].astype(np.float32))

    shards = spark.range(0, model.shards.count, 1, min(model.shards.count, MOST_TASKS))
    arrow_map(shards, run, "shard long").agg(F.max("shard")).collect()


def fitted(docs: DataFrame, shard_tokens: int = SHARD_TOKENS, word_rows: int = WORD_ROWS) -> Model:
    """A model of all the texts, its arrays in the shared folder."""
    spark = docs.sparkSession
    folder, counted = work_folder(spark, "ngrams"), work_folder(spark, "ngram-counts")
    counts = saved(word_counts(docs), "word-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    shards = shards_of(counts, total["tokens"], shard_tokens)
    parts = saved(merged_shards(pair_runs(docs, shards), counted), "word-parts")
    zeros = [F.lit(0).cast("long").alias(name) for name in (*_FOLLOWERS, "k")]
    every = parts.select("hash", F.lit(0).cast("long").alias("n"), *_FOLLOWERS, "k").unionAll(counts.select("hash", "n", *zeros))
    words = saved(every.groupBy("hash").agg(*(F.sum(name).alias(name) for name in ("n", *_FOLLOWERS, "k"))), "words")
    forget(parts, counts)
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("f1", "f2", "f3", "f4", "k")]
    numbers = [F.count(F.when(F.col("k") == n, 1)).alias(f"k{n}") for n in range(1, 5)]
    many = F.count(F.when(F.col("k") >= 3, 1)).alias("many")
    texts = F.coalesce(F.max(F.when(F.col("hash") == int(END.view(np.int64)), F.col("n"))), F.lit(0)).alias("texts")
    row = words.agg(*sums, *numbers, many, texts).first()
    of_pairs = discounts_of([row["f1"], row["f2"], row["f3"], row["f4"]])
    of_words = discounts_of([row[f"k{n}"] for n in range(1, 5)])
    follows, types = max(row["k"], 1), total["types"]
    left = of_words[1] * row["k1"] + of_words[2] * row["k2"] + of_words[3] * row["many"]
    unknown = left / follows / (types + 1) if row["k"] else 1.0


    def arrays(table: pa.Table) -> dict[str, np.ndarray]:
        values = {column: table.column(column).to_numpy() for column in ("hash", "n", *_FOLLOWERS, "k")}
        hashes = values["hash"].view(np.uint64)
        n = np.where(hashes == BEGIN, row["texts"], values["n"])  # as many texts begin as end
        several = values["f3"] + values["f4"] + values["more"]
        rest = of_pairs[1] * values["f1"] + of_pairs[2] * values["f2"] + of_pairs[3] * several
        likely = discounted(values["k"], of_words) / follows + unknown
        return {"hashes": hashes, "counts": n, "rests": rest / np.maximum(n, 1), "likely": likely}

    written = write_words(words, folder, word_rows, arrays)
    forget(words)
    firsts = np.array([first for first, _ in written], np.uint64)
    model = Model(folder, shards, total["tokens"], types, of_pairs, unknown, [name for _, name in written], firsts)
    write_gains(spark, model, counted)
    storage.delete(spark, counted)
    return model


def write_words(words: DataFrame, folder: str, word_rows: int, arrays) -> list[tuple[int, str]]:
    """Writes word arrays in the order of unsigned hashes; returns the first hash and the name of each."""

    def run(batches):
        part, number, waiting, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            if held >= word_rows:
                yield written(waiting, f"{part}-{number}")
                number, waiting, held = number + 1, [], 0
        if held:
            yield written(waiting, f"{part}-{number}")

    def written(waiting: list[pa.RecordBatch], name: str) -> pa.RecordBatch:
        made = arrays(pa.Table.from_batches(waiting))
        for kind, values in made.items():
            write_array(folder, f"words-{name}-{kind}", values)
        return pa.RecordBatch.from_arrays([pa.array([name]), signed(made["hashes"][:1].copy())], names=["name", "first"])

    # Signed order has the upper half of the hashes first.
    ordered = words.withColumn("half", (F.col("hash") < 0).cast("int")).repartitionByRange("half", "hash")
    ordered = ordered.sortWithinPartitions("half", "hash").drop("half")
    rows = arrow_map(ordered, run, "name string, first long").collect()  # a row for each ``word_rows`` words or task
    return sorted((row["first"] % 2**64, row["name"]) for row in rows)


_FACTS = np.dtype([("doc_id", "<i8"), ("has_id", "?"), ("tokens", "<i8"), ("known", "<i8"), ("base", "<f8"), ("score", "<f8")])
_REQUEST = "shard int, block long, keys binary, times binary, texts binary, facts binary"
_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def requests(docs: DataFrame, model: Model) -> DataFrame:
    """For each block and shard the pairs to look up, and for each block what its texts' words give."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        model = known.value
        for chunk in chunks(batches, "text", BLOCK_BYTES):
            block = Block(chunk.column("text"))
            rows = _asked(block, chunk.column("doc_id").to_pylist(), model, part << 32 | number)
            yield _batch(rows, "shard:int32 block:int64 keys times texts facts")
            number += 1

    return arrow_map(texts_of(docs, F.col("doc_id").cast("long").alias("doc_id")), run, _REQUEST)


def _asked(block: Block, ids: list, model: Model, name: int) -> list[tuple]:
    order = np.argsort(block.hashes)
    count, rest, likely = (np.empty(len(order), kind) for kind in (np.int64, float, float))
    count[order], rest[order], likely[order] = model.of_words(block.hashes[order])
    known, behind = count > 0, np.where(count > 0, rest, 1.0)
    base = np.log10((count + 1) / (model.tokens + model.types + 1))
    alone, left = (np.log10(np.maximum(values, 1e-300)) for values in (likely, behind))
    facts = np.zeros(len(ids), _FACTS)
    facts["doc_id"] = [doc_id or 0 for doc_id in ids]
    facts["has_id"] = [doc_id is not None for doc_id in ids]
    facts["tokens"] = block.sizes
    for kind, values in (("known", known[block.token]), ("base", base[block.token]), ("score", alone[block.token] + left[block.before])):
        facts[kind] = np.bincount(block.text, weights=values, minlength=len(ids))
    rows = [(name % model.shards.count, name, None, None, None, facts.tobytes())]
    # No pair with an unknown token is known.
    ask = np.flatnonzero(known[block.token] & known[block.before])
    texts = block.text[ask].astype(np.uint32)
    first, second = block.hashes[block.before[ask]], block.hashes[block.token[ask]]
    shard, keys = model.shards.of(first, second), pair_hashes(first, second)
    del first, second, ask
    # By shard and key; keys that differ in their lowest bits alone may come in any order.
    order = np.argsort(shard.astype(np.uint64) << np.uint64(44) | keys >> np.uint64(20))
    shard, keys, texts = shard[order], keys[order], texts[order]
    for start, end in _stretches(shard):
        own = keys[start:end]
        new = np.flatnonzero(_begins(own))
        times = np.diff(np.append(new, end - start)).astype(np.uint32)
        rows.append((int(shard[start]), name, *map(in_planes, (steps(own[new]), times, texts[start:end])), None))
    return rows


def answered(asked: DataFrame, model: Model) -> DataFrame:
    """For each block and shard the sums of gains of the block's texts; facts go on as they are."""
    known = asked.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = known.value
        for batch in batches:
            for at in range(batch.num_rows):
                [row] = batch.slice(at, 1).to_pylist()
                texts = sums = None
                if row["facts"] is None:
                    gains = model.gains(row["shard"], np.cumsum(from_planes(row["keys"], np.uint64)))
                    texts = from_planes(row["texts"], np.uint32)
                    found = np.bincount(texts, weights=np.repeat(gains, from_planes(row["times"], np.uint32)))
                    texts = np.flatnonzero(np.bincount(texts))
                    texts, sums = in_planes(texts.astype(np.uint32)), in_planes(found[texts])
                yield _batch([(row["block"], row["shard"], texts, sums, row["facts"])], "block:int64 shard:int32 texts sums facts")

    # A task has a shard, or few.
    dealt = asked.repartition(min(model.shards.count, MOST_TASKS), "shard")
    return arrow_map(dealt, run, "block long, shard int, texts binary, sums binary, facts binary")


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row; scores are log10 of probabilities."""
    names = [column.split()[0] for column in _SCORES.split(", ")]

    def total(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda row: (row["facts"] is None, row["shard"]))
        facts = np.frombuffer(rows[0]["facts"], _FACTS)
        score = facts["score"].copy()
        for row in rows[1:]:
            score[from_planes(row["texts"], np.uint32)] += from_planes(row["sums"], np.float64)
        kept = [pa.array(facts[name].copy()) for name in ("tokens", "known", "base")]
        return pa.Table.from_arrays([pa.array(facts["doc_id"].copy(), mask=~facts["has_id"]), *kept, pa.array(score)], names=names)

    return answered(requests(docs, model), model).groupBy("block").applyInArrow(total, _SCORES)


def perplexity(score, n_tokens):
    """Of a text with that log10 probability."""
    return F.pow(F.lit(10.0), -score / n_tokens)


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def op12_kneser_ney_scores(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = fitted(docs.filter(~held_out(F.col("doc_id"))))
    return scored(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"),
    )
