"""Language identification by interpolated Kneser-Ney models of characters.

Each language has a model of the letters of its words, up to five at a time, with marks for a
word's begin and end. Counts come from a sample of labelled rows of bounded size (``SAMPLE``
documents for each language, drawn by a hash of the id, taken whole, ``SAMPLE_BYTES`` bytes of them
and one document more at most, of the ``LANGUAGES`` most frequent languages); Spark counts words,
then the sequences in them, and works out all shares and weights. A sequence's probability is its discounted share after its context plus
the context's remaining weight times the probability one letter shorter; below the longest
order a count is the number of different letters a sequence follows.

The models of all languages share sorted arrays: for every order the hashes of known sequences
with a row of discounted shares, and the hashes of contexts with a row of weights. Scoring looks
up the different words of a small batch in these arrays by binary search. The driver gets hashes
and numbers alone, some twenty bytes for each different sequence of the sample and language. The prediction is the
language of the lowest cross-entropy for each letter; ``score`` is that language's share of the
likelihood, worked out on ``SURE`` letters at most, so that it stays a graded number.

Rejection looks at the cross-entropy with each word in the language that suits it best, so that a
quotation in another language does no harm. Part of the sample is left out of the counts; its
values give a centre and a spread for each language. A text is rejected if it has no letters, or
is over the centre by more than ``FAR`` spreads and ``MARGIN`` nats, and more than that the fewer
letters it has: only text that is far from every language goes.

Defined results: a null text, or one without letters, is ``und`` with score 0; with no labelled
row at all every text is; equal rows are judged alike, ties go to the first language in order;
null labels are not learned from; a null doc_id is not held out; other columns are not used.
"""

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.llm.common import arrow_map, chunks, class_of, documents, forget, saved

ORDER = 5
SAMPLE = 600
SAMPLE_BYTES = 16 << 20
LANGUAGES = 256
#: Every ``APART``-th document of the sample sets the limits instead of being counted.
APART = 5
SURE = 30
#: Words scored together; each letter takes some hundred bytes meanwhile.
AT_ONCE = 16_384
FAR = 8.0
MARGIN = 1.0
BEGIN, END = "\x02", "\x03"
UNKNOWN = "und"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    """Runs of letters, in texts of the basic plane and in all, that no digit touches."""
    return re.compile(rf"\b[{class_of('L', 0xFFFF)}]+\b"), re.compile(rf"\b[{class_of('L')}]+\b")


_BEYOND = re.compile("[\U00010000-\U0010ffff]")


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    basic, every = _patterns()
    text = text.lower()
    words = (every if _BEYOND.search(text) else basic).findall(text)
    # Letters among digits, as in keys, say little; they count where there is nothing else.
    return words or re.findall(f"[{class_of('L')}]+", text)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


def sequence_hashes(points: np.ndarray, order: int) -> np.ndarray:
    """The hash of the ``order`` code points that end at each position (rubbish before that)."""
    total = np.zeros(len(points), np.uint64)
    with np.errstate(over="ignore"):
        for back in range(order):
            shifted = np.zeros(len(points), np.uint64)
            shifted[back:] = points[: max(len(points) - back, 0)]
            total = total * MULTIPLIER + shifted + np.uint64(1)
        return _mixed(total + np.uint64(order))


def text_hash(text: str) -> np.uint64:
    return sequence_hashes(np.array([ord(c) for c in text], np.uint64), len(text))[-1]


@dataclass
class Model:
    """Sorted hash arrays for each order from 1, with a column for each language."""

    languages: list[str]
    letters: int
    known: list[np.ndarray]
    shares: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The log-likelihood of each word, a column for each language."""
        parts = [self._scores(words[at : at + AT_ONCE]) for at in range(0, len(words), AT_ONCE)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)))

    def _scores(self, words: list[str]) -> np.ndarray:
        marked = "".join(f"{BEGIN}{word}{END}" for word in words)
        points = np.frombuffer(marked.encode("utf-32-le"), "<u4").astype(np.uint64)
        lengths = np.array([len(word) + 2 for word in words])
        begins = np.cumsum(lengths) - lengths
        place = np.arange(len(points)) - np.repeat(begins, lengths)
        likely = np.full((len(points), len(self.languages)), 1.0 / self.letters)
        context = None
        for order in range(1, len(self.known) + 1):
            rows = np.flatnonzero(place >= order - 1)
            hashes = sequence_hashes(points, order)
            if order == 1:
                weight = np.broadcast_to(self.weights[0][0], (len(rows), len(self.languages)))
            else:
                weight = _found(self.contexts[order - 1], self.weights[order - 1], context[rows - 1], 1.0)
            share = _found(self.known[order - 1], self.shares[order - 1], hashes[rows], 0.0)
            likely[rows] = share + weight * likely[rows]
            context = hashes
        logs = np.log(likely)
        logs[begins] = 0.0  # the mark of the begin is given
        return np.add.reduceat(logs, begins, axis=0)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per letter of each text in every language, that of its words each in the
        best one, and its number of letters."""
        known: dict[str, int] = {}
        ids, counts, letters = [], [], []
        for text in texts:
            words = words_of(text)
            ids.extend([known.setdefault(word, len(known)) for word in words])
            counts.append(len(words))
            letters.append(sum(map(len, words)))
        total = np.zeros((len(texts), len(self.languages) + 1))
        if ids:
            scores = self.word_scores(list(known))
            scores = np.column_stack([scores, scores.max(axis=1)])
            some = np.flatnonzero(counts)
            ends = np.cumsum(counts)
            starts = (ends - counts)[some]
            total[some] = np.add.reduceat(scores[np.array(ids)], starts, axis=0)
        size = np.array(letters) + np.array(counts)
        entropy = -total / np.maximum(size, 1)[:, None]
        return entropy[:, :-1], entropy[:, -1], np.array(letters)

    def judged(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Prediction, score, cross-entropy in that language and whether it is rejected, of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropy, mixed, letters = self.entropies(texts)
        best = entropy.argmin(axis=1)
        lowest = entropy.min(axis=1)
        sure = np.minimum(letters, SURE)[:, None]
        score = 1 / np.exp(-(entropy - lowest[:, None]) * sure).sum(axis=1)
        lacking = letters == 0
        beyond = np.zeros(len(texts), bool)
        if self.centre is not None:
            limit = self.centre + np.maximum(FAR * self.spread, MARGIN)
            beyond = mixed > (limit + 4 / np.sqrt(np.maximum(letters, 1))[:, None])[np.arange(len(texts)), best]
        names = [UNKNOWN if none else self.languages[n] for n, none in zip(best, lacking, strict=True)]
        return names, np.where(lacking, 0.0, score), lowest, lacking | beyond


def _found(sorted_hashes: np.ndarray, rows: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(sorted_hashes):
        return np.full((len(wanted), rows.shape[1]), missing)
    at = np.minimum(np.searchsorted(sorted_hashes, wanted), len(sorted_hashes) - 1)
    found = rows[at]
    found[sorted_hashes[at] != wanted] = missing
    return found


def held_out(doc_id):
    """Rows that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sample_of(docs: DataFrame, most: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """About ``most`` labelled documents of each language that may be learned from, never over twice."""
    may = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    draw = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(2**40)) / F.lit(2.0**40)
    sizes = may.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(LANGUAGES)
    share = sizes.select("lang", (F.lit(float(most)) / F.col("rows")).alias("share"))
    drawn = may.join(F.broadcast(share), "lang").withColumn("draw", draw).filter(F.col("draw") < F.col("share"))
    by_draw = Window.partitionBy("lang").orderBy("draw", "doc_id")
    before = F.coalesce(F.sum(F.octet_length("text")).over(by_draw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = drawn.withColumn("rank", F.row_number().over(by_draw)).withColumn("before", before)
    return ranked.filter((F.col("rank") <= 2 * most) & (F.col("before") <= most_bytes)).select("lang", "text", "rank")


def word_counts(sample: DataFrame) -> DataFrame:
    """Words of the counted part of the sample by language."""

    def split(batches):
        for batch in batches:
            for chunk in chunks([batch], "text"):
                rows = [
                    (lang, word)
                    for lang, text in zip(chunk.column("lang").to_pylist(), chunk.column("text").to_pylist(), strict=True)
                    for word in words_of(text)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
                    names=["lang", "word"],
                )

    counted = sample.filter(F.col("rank") % APART != 0).select("lang", "text")
    return arrow_map(counted, split, "lang string, word string").groupBy("lang", "word").count()


def sequence_counts(words: DataFrame, order: int = ORDER) -> DataFrame:
    """For each language and length the sequences of letters in marked words, and their counts.

    For the longest order, and for sequences at a word's begin, which nothing precedes, that is
    how often they occur; for others, how many different letters they follow.
    """
    marked = words.withColumn("word", F.concat(F.lit(BEGIN), "word", F.lit(END)))
    occurring = marked.withColumn("size", F.explode(F.array(*map(F.lit, range(1, order + 1))))).filter(
        F.char_length("word") >= F.col("size")
    )
    cut = F.transform(
        F.sequence(F.lit(1), F.char_length("word") - F.col("size") + 1),
        lambda at: F.substring(F.col("word"), at, F.col("size")),
    )
    occurring = occurring.select("lang", "size", "count", F.explode(cut).alias("sequence"))
    occurring = occurring.groupBy("lang", "size", "sequence").agg(F.sum("count").alias("times"))
    follows = occurring.filter("size > 1").groupBy(
        "lang", (F.col("size") - 1).alias("size"), F.expr("substring(sequence, 2)").alias("sequence")
    ).agg(F.count(F.lit(1)).alias("followed"))
    counts = occurring.join(follows, ["lang", "size", "sequence"], "left")
    raw = (F.col("size") == order) | F.col("sequence").startswith(BEGIN)
    return counts.select(
        "lang", "size", "sequence", F.when(raw, F.col("times")).otherwise(F.coalesce("followed", F.lit(0))).alias("times")
    ).filter("times > 0")


def text_hashes(texts: list[str]) -> np.ndarray:
    """``text_hash`` of each of the texts, 0 for an empty one."""
    found = np.zeros(len(texts), np.uint64)
    sizes = np.array([len(text) for text in texts], np.int64)
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        points = np.frombuffer("".join(texts[row] for row in rows).encode("utf-32-le"), "<u4").astype(np.uint64)
        found[rows] = sequence_hashes(points, int(size))[size - 1 :: size]
    return found


def shares_and_weights(counts: DataFrame) -> DataFrame:
    """From sequence counts rows (kind, size, lang, text, value): ``share`` of a sequence after its context, ``weight`` of a context."""
    counts = counts.filter(F.col("sequence") != BEGIN)
    numbers = [F.count_if(F.col("times") == n).alias(name) for n, name in ((1, "once"), (2, "twice"))]
    discounts = counts.groupBy("lang", "size").agg(*numbers).select(
        "lang",
        "size",
        F.when((F.col("once") > 0) & (F.col("twice") > 0), F.col("once") / (F.col("once") + 2 * F.col("twice")))
        .otherwise(0.5)
        .alias("discount"),
    )
    # A row for each language and size.
    rows = counts.join(F.broadcast(discounts), ["lang", "size"])
    rows = rows.withColumn("context", F.expr("left(sequence, char_length(sequence) - 1)"))
    contexts = rows.groupBy("lang", "size", "context", "discount").agg(
        F.sum("times").alias("total"), F.count(F.lit(1)).alias("different")
    )
    share = ((F.col("times") - F.col("discount")) / F.col("total")).cast("float").alias("value")
    shares = rows.join(contexts.select("lang", "size", "context", "total"), ["lang", "size", "context"])
    shares = shares.select(F.lit("share").alias("kind"), "size", "lang", F.col("sequence").alias("text"), share)
    weight = (F.col("discount") * F.col("different") / F.col("total")).cast("float").alias("value")
    return shares.unionAll(contexts.select(F.lit("weight"), "size", "lang", "context", weight))


def model_from(counts: DataFrame, order: int = ORDER) -> Model:
    """The model of sequence counts, a table that was written once."""
    languages = [row["lang"] for row in counts.select("lang").distinct().orderBy("lang").collect()]
    letters = max(2, counts.filter("size = 1").select("sequence").distinct().count())
    model = Model(languages, letters, [], [], [], [])
    if not languages:
        return model

    def hashed(batches):
        for batch in batches:
            hashes = text_hashes(batch.column("text").to_pylist())
            columns = [batch.column("kind"), batch.column("size"), batch.column("lang"), pa.array(hashes.view(np.int64))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("value")], names=["kind", "size", "lang", "hash", "value"])

    table = arrow_map(shares_and_weights(counts), hashed, "kind string, size int, lang string, hash long, value float").toArrow()
    kind, size = table.column("kind").to_numpy(), table.column("size").to_numpy()
    column = np.searchsorted(languages, table.column("lang").to_numpy().astype(str))
    hashes, value = table.column("hash").to_numpy().view(np.uint64), table.column("value").to_numpy()
    for length in range(1, order + 1):
        for name, missing, keys, rows in (("share", 0, model.known, model.shares), ("weight", 1, model.contexts, model.weights)):
            here = (size == length) & (kind == name)
            known, which = np.unique(hashes[here], return_inverse=True)
            matrix = np.full((len(known), len(languages)), missing, np.float32)
            matrix[which, column[here]] = value[here]
            keys.append(known)
            rows.append(matrix)
        if not len(model.weights[-1]):
            model.weights[-1] = np.ones((1, len(languages)), np.float32)
    return model


def fitted(docs: DataFrame, most: int = SAMPLE, order: int = ORDER) -> Model:
    """A model of the labelled documents; what reaches the driver is bounded by the sample."""
    sample = saved(sample_of(docs, most), "language-sample")
    counts = saved(sequence_counts(word_counts(sample), order), "language-counts")
    model = model_from(counts, order)
    forget(counts)
    if not model.languages:
        forget(sample)
        return model
    known = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        for chunk in chunks(batches, "text"):
            _, mixed, letters = known.value.entropies(chunk.column("text").to_pylist())
            columns = [chunk.column("lang"), pa.array(mixed), pa.array(letters)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "entropy", "letters"])

    apart = sample.filter(F.col("rank") % APART == 0).select("lang", "text")
    measured = saved(arrow_map(apart, measure, "lang string, entropy double, letters long").filter("letters >= 100"), "measured")
    centre = measured.groupBy("lang").agg(F.median("entropy").alias("centre"))
    spread = (
        measured.join(F.broadcast(centre), "lang")
        .groupBy("lang", "centre")
        .agg((1.4826 * F.median(F.abs(F.col("entropy") - F.col("centre")))).alias("spread"))
    )
    limits = {row["lang"]: row for row in spread.collect()}  # a row for each language
    known.destroy()
    forget(sample, measured)
    # A language too rare to be measured rejects nothing that has letters.
    model.centre = np.array([limits[x]["centre"] if x in limits else np.inf for x in model.languages])
    model.spread = np.array([limits[x]["spread"] if x in limits else 0.0 for x in model.languages])
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows as ``row`` with lang_pred, score, entropy and rejected."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    names = ["row", "lang_pred", "score", "entropy", "rejected"]

    def run(batches):
        for chunk in chunks(batches, "text"):
            predicted, score, entropy, rejected = known.value.judged(chunk.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [chunk.column("row"), pa.array(predicted, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)],
                names=names,
            )

    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), "text")
    judged = "lang_pred string, score double, entropy double, rejected boolean"
    return arrow_map(rows, run, T.StructType([rows.schema["row"], *T.StructType.fromDDL(judged)]))


def op8_kneser_ney(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return identify(docs.select("doc_id", "text"), fitted(docs)).select(
        F.col("row.doc_id").alias("doc_id"),
        held_out(F.col("row.doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        "entropy",
        "rejected",
    )
