import random
import re
from collections import Counter

import zstandard
from llm_rows import documents, odd_texts, words

from scorelake.llm import quality
from scorelake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    """The base counts, straight from their definition."""
    text = text or ""
    found = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {
        at + ahead for at, window in enumerate(zip(found, found[1:], found[2:])) if windows[window] > 1 for ahead in range(3)
    }
    failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), again, len(covered), failed


def measured(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed


def test_counts_of_odd_texts(spark):
    rng = random.Random(1)
    texts = odd_texts(rng) + ["a b c a b c a b", "x\ny\nx\n \n \nx ", "a b a b a b a b", "é#* <b>|&"]
    texts += [" ".join(rng.choices("abc", k=rng.randint(0, 90))) for _ in range(60)]
    got = quality.judge(documents(spark, texts, clashing=True)).collect()
    assert len(got) == len(texts)
    for row in got:
        assert measured(row) == counted(texts[row.doc_id]), texts[row.doc_id]
        assert not (row.base_failed and row.kept)


def test_bands():
    rng = random.Random(2)
    compress = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    prose = " ".join(words(rng, 3000)).encode()
    kept = lambda raw: quality.judged(raw, compress)[6]
    assert kept(prose) and kept(prose[:3000]) and kept(prose[:600])
    noise = " ".join(rng.randbytes(12).hex() for _ in range(800)).encode("latin-1")
    random_text = bytes(rng.choice(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/ ") for _ in range(20_000))
    assert not kept(random_text)
    assert quality.judged(noise, compress)[7] < 2.5
    # Every window is new, but lines only count up: the base rules pass it, its ratio does not.
    counting = "\n".join(f"the value of this entry in our long list is {n} now" for n in range(2000)).encode()
    assert not quality.judged(counting, compress)[5] or not kept(counting)
    assert not kept(counting)


def test_a_text_that_is_mostly_bad_chunks_goes():
    rng = random.Random(3)
    compress = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    prose = " ".join(words(rng, 4000)).encode()
    alphabet = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/ "
    noise = bytes(rng.choice(alphabet) for _ in range(3 * len(prose)))
    judged = quality.judged(prose + noise, compress)
    assert judged[8] > 0.5 and not judged[6]
    assert quality.judged(prose + noise[: len(prose) // 4], compress)[8] <= 0.5


def test_no_rows(spark):
    assert quality.judge(documents(spark, [])).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = QUERIES["op6_compression_bands"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(texts)
    for row in got:
        assert measured(row) == counted(texts[row.doc_id])
        if labels.get(row.doc_id) == 1:
            assert row.kept or row.base_failed
