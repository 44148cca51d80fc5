import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import documents, odd_texts, words

from scorelake.llm import resampling
from scorelake.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    found = WORD.findall((text or "").translate(LOWER))
    return found, found + [f"{one} {two}" for one, two in zip(found, found[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode("utf-8")) % 10_000


def expected(rows, target):
    """Straight from the definition: rows (doc_id, text)."""
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    out = []
    for doc_id, text in rows:
        found, every = features(text)
        weight = sum(gain[bucket(feature)] for feature in every) // len(every) if every else 0
        name = f"7:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(every), weight, score, None, len(found)])
    may = sorted((row for row in out if row[5] >= 20), key=lambda row: (-row[3], row[0] is None, row[0]))
    for rank, row in enumerate(may[: 25 * len(may) // 100], 1):
        row[4] = rank
    return sorted([tuple(row[:5]) for row in out], key=str)


def asked(spark, tmp_path, texts, target):
    frame = documents(spark, texts, clashing=True)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(n, text) for n, text in enumerate(target)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    rows = QUERIES["op11_head_tail_resampling"](spark, str(tmp_path)).collect()
    return sorted([tuple(row) for row in rows], key=str), [(row.doc_id, row.text) for row in frame.collect()]


@pytest.mark.parametrize(("head", "pairs"), [(1 << 16, 1 << 17), (40, 25), (0, 0)])
def test_query_by_definition(spark, tmp_path, monkeypatch, head, pairs):
    monkeypatch.setattr(resampling, "HEAD", head)
    monkeypatch.setattr(resampling, "HEAD_PAIRS", pairs)
    rng = random.Random(11)
    known = words(rng, 60) + ["The", "the", "a", "Über", "x" * 50]
    texts = odd_texts(rng) + [" ".join(rng.choices(known, k=rng.randint(0, 60))) for _ in range(150)]
    texts += [(None, "a the " * 30), (7, "a b " * 15), (7, "a b " * 15)]
    target = [None, "", " ".join(known[:40])] + [" ".join(rng.choices(known[:20], k=30)) for _ in range(20)]
    got, rows = asked(spark, tmp_path, texts, target)
    assert got == expected(rows, target)
    assert any(row[4] for row in got)


def test_nothing_to_draw(spark, tmp_path):
    got, rows = asked(spark, tmp_path, [None, "", "few words"], [])
    assert got == expected(rows, []) and all(row[4] is None for row in got)
    empty = resampling.resample(documents(spark, [])[["doc_id", "text"]], documents(spark, []))
    assert empty.collect() == []


def test_head_changes_no_bucket():
    rng = random.Random(2)
    known = [word.encode() for word in words(rng, 50)]
    texts = [b" ".join(rng.choices(known, k=rng.randint(0, 40))) for _ in range(50)] + [None, b"!"]
    nothing = resampling.Head([], np.full((resampling.PAIR_WORDS,) * 2, -1, np.int16))
    pairs = nothing.pairs.copy()
    for one in range(0, 20, 2):
        for two in range(20):
            pairs[one, two] = zlib.crc32(known[one] + b" " + known[two]) % resampling.BUCKETS
    some = resampling.Head(list(dict.fromkeys(known)), pairs)
    for one, two in zip(nothing.buckets(texts), some.buckets(texts), strict=True):
        assert (one == two).all()


def test_most_frequent_keeps_whole_levels(spark):
    counts = spark.createDataFrame([(str(n), n) for n in range(1, 101)] + [("x", 100)], "word string, n long")
    found = {row.n for row in resampling.most_frequent(counts, 10).collect()}
    assert 100 in found and found == set(range(min(found), 101)) and len(found) <= 9
    assert resampling.most_frequent(counts, 1).collect() == []
