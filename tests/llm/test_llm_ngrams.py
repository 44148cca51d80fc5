import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import documents, odd_texts, words
from pyspark.sql import functions as F

from scorelake.llm import arrays, ngrams
from scorelake.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BEGIN, END = object(), object()


def tokens(text):
    spaced = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "").translate(LOWER))
    return [word for word in spaced.split(" ") if word] + [END]


class Plain:
    """The model by its definition, with dictionaries."""

    def __init__(self, texts):
        self.pairs, self.words = Counter(), Counter()
        for text in texts:
            own = tokens(text)
            self.words.update(own)
            self.pairs.update(zip([BEGIN, *own], own))
        self.behind = Counter({BEGIN: len(texts)}) + Counter({w: n for w, n in self.words.items() if w is not END})
        self.follows, self.fans = Counter(), defaultdict(list)
        for (one, two), n in self.pairs.items():
            self.follows[two] += 1
            self.fans[one].append(n)
        self.d = self.discounts(self.pairs.values())
        self.e = self.discounts(self.follows.values())
        self.total = sum(self.follows.values())

    @staticmethod
    def discounts(counts):
        n = Counter(counts)
        if not (n[1] and n[2]):
            return [0, 0.5, 0.5, 0.5]
        y = n[1] / (n[1] + 2 * n[2])
        found = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        return [0, *(min(max(d, 0), i) for i, d in enumerate(found, 1))]

    def alone(self, word):
        if not self.total:
            return 1.0
        left = sum(self.e[min(k, 3)] for k in self.follows.values()) / self.total
        own = self.follows[word]
        return max(own - self.e[min(own, 3)], 0) / self.total + left / (len(self.words) + 1)

    def of(self, word, before):
        if not self.behind[before]:
            return self.alone(word)
        n = self.pairs[before, word]
        left = sum(self.d[min(k, 3)] for k in self.fans[before])
        return (max(n - self.d[min(n, 3)], 0) + left * self.alone(word)) / self.behind[before]

    def score(self, text):
        own = tokens(text)
        return sum(math.log10(self.of(two, one)) for one, two in zip([BEGIN, *own], own))

    def base(self, text):
        n, v = sum(self.words.values()), len(self.words)
        return sum(math.log10((self.words[word] + 1) / (n + v + 1)) for word in tokens(text))


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def some_texts(rng):
    known = words(rng, 70)
    texts = [text for text in odd_texts(rng) if text is None or len(text) < 20_000]
    texts += [" ".join(rng.choices(known[: rng.choice([5, 20, 70])], k=rng.randint(0, 80))) for _ in range(200)]
    return texts + ["The the  THE\tthe\n the", (None, "a null id"), (3, "twice"), (3, "twice")]


def same(rows, expected):
    key = lambda row: [(value is None, value) for value in row]
    for got, wanted in zip(sorted(rows, key=key), sorted(expected, key=key), strict=True):
        assert got[:5] == wanted[:5]
        assert got[5:] == pytest.approx(wanted[5:], rel=1e-6)


@pytest.mark.parametrize("shard_tokens", [1 << 21, 300])
def test_query_by_definition(spark, tmp_path, monkeypatch, shard_tokens):
    monkeypatch.setattr(ngrams.fitted, "__defaults__", (shard_tokens, 50))
    frame = documents(spark, some_texts(random.Random(5)), clashing=True)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(row.doc_id, row.text) for row in frame.collect()]
    plain = Plain([text for doc_id, text in rows if not held_out(doc_id)])
    total = sum(plain.words.values())
    expected = [
        (doc_id, held_out(doc_id), len(own := tokens(text)), sum(plain.words[w] > 0 for w in own), total, plain.base(text), plain.score(text))
        for doc_id, text in rows
    ]
    got = QUERIES["op12_kneser_ney_scores"](spark, str(tmp_path)).drop("perplexity").collect()
    same([tuple(row) for row in got], expected)


def test_probabilities_add_up():
    texts = ["a b a c", "b a b a", "c", "a b d e f", "", "a a a a a"]
    plain = Plain(texts)
    for before in [BEGIN, "a", "b", "never seen"]:
        assert sum(plain.of(word, before) for word in [*plain.words, "unknown"]) == pytest.approx(1)


def test_better_than_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = ngrams.fitted(docs.filter(~ngrams.held_out(F.col("doc_id"))))
    apart = ngrams.scored(docs.filter(ngrams.held_out(F.col("doc_id"))), model)
    row = apart.agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert row[2] and row[0] > row[1]


def test_no_texts(spark):
    none = documents(spark, [])
    model = ngrams.fitted(none)
    assert ngrams.scored(none, model).collect() == []
    [row] = ngrams.scored(documents(spark, ["a b"]), model).collect()
    assert (row.n_tokens, row.n_known, row.base_score, row.score) == (3, 0, 0.0, 0.0)


def test_hot_words_are_spread():
    shards = ngrams.Shards(16, np.array([5], np.uint64), np.array([40], np.uint64))
    second = np.arange(1000, dtype=np.uint64)
    assert len(np.unique(shards.of(np.full(1000, 5, np.uint64), second))) > 10
    assert len(np.unique(shards.of(np.full(1000, 6, np.uint64), second))) == 1


def test_arrays(tmp_path):
    values = np.array([3, 9, 2**63], np.uint64)
    for folder in (str(tmp_path), f"file://{tmp_path}"):
        arrays.write_array(folder, "some", values)
        assert isinstance(arrays.read_array(folder, "some"), np.memmap)
        assert arrays.read_array(folder, "some").tolist() == values.tolist()
    assert np.cumsum(arrays.from_planes(arrays.in_planes(arrays.steps(values)), np.uint64)).tolist() == values.tolist()
    assert arrays.from_planes(arrays.in_planes(values[:0]), np.uint64).tolist() == []
