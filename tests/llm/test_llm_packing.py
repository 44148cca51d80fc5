import random
import zlib
from array import array

import public_tokenizers
import pytest
from llm_rows import documents, odd_texts
from tokenizers import Tokenizer

from scorelake.llm import packing
from scorelake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def check(rows, ids, capacity):
    """Every document whole and in order, every sequence gapless; returns how many sequences."""
    docs, sequences = {}, {}
    for row in rows:
        docs.setdefault(row.doc_id, []).append(row)
        sequences.setdefault(row.sequence_id, []).append(row)
    assert docs.keys() == ids.keys()
    for doc, pieces in docs.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        at = 0
        for row in pieces:
            assert row.start == at
            assert row.ids_crc32 == zlib.crc32(array("I", ids[doc][at : at + row.length]).tobytes())
            at += row.length
        assert at == len(ids[doc])
        assert len(pieces) == -(-at // capacity) and all(r.length == capacity for r in pieces[1:])
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for row in pieces:
            assert row.offset == at
            at += row.length
        assert at <= capacity
    return len(sequences)


def placed(counts, capacity):
    """The plan written out: the lengths in each sequence."""
    places, sequences = packing.plan(counts, capacity)
    taken = [set() for _ in range(sequences)]
    by_length = {}
    for length, first, sequence, offset, together in places.tolist():
        by_length.setdefault(length, []).append((first, sequence, offset, together))
    for length, count in enumerate(counts):
        starts = sorted(by_length.get(length, []))
        for rank in range(count):
            first, sequence, offset, together = [s for s in starts if s[0] <= rank][-1]
            number, place = sequence + (rank - first) // together, offset + (rank - first) % together * length
            here = set(range(place, place + length))
            assert place + length <= capacity and not taken[number] & here
            taken[number] |= here
    assert all(set(range(len(one))) == one for one in taken)
    return sequences


def test_plans_are_valid_and_near_the_bound():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.choice((1, 2, 7, 30, 64))
        counts = [0] + [rng.choice((0, 0, 1, 2, 9)) for _ in range(capacity)]
        total = sum(n * count for n, count in enumerate(counts))
        used = placed(counts, capacity)
        assert used >= -(-total // capacity)
        assert used <= 11 * (total / capacity) / 9 + sum(c for n, c in enumerate(counts) if 2 * n > capacity) / 5 + 4


def test_combinations_that_fill_exactly_are_used():
    # One, two and three lengths behind the longest; nothing is lost.
    assert packing.exact_groups([0, 1, 0, 0, 0, 0, 0, 0, 0, 1, 0], 10) == [((9, 1), 1)]
    for lengths in ((6, 4), (5, 3, 2), (4, 3, 2, 1), (4, 2, 2, 2), (5, 5)):
        counts = [0] * 11
        for length in lengths:
            counts[length] += 3
        assert placed(counts, 10) == 3
        left = list(counts)
        groups = packing.exact_groups(left, 10)
        assert groups and all(sum(lengths) == 10 for lengths, _ in groups)
        for length, count in enumerate(counts):
            assert count - left[length] == sum(lengths.count(length) * times for lengths, times in groups)


def test_sums_know_what_one_to_three_lengths_reach():
    rng = random.Random(2)
    for _ in range(40):
        counts = [0] + [rng.choice((0, 1)) for _ in range(20)]
        here = [n for n, count in enumerate(counts) if count]
        sums = packing.Sums(counts, 20)
        for gap in range(1, 21):
            expected = {(a,) for a in here if a == gap}
            expected |= {(a, b) for a in here for b in here if a >= b and a + b == gap}
            expected |= {(a, b, c) for a in here for b in here for c in here if a >= b >= c and a + b + c == gap}
            assert set(sums.fills(gap)) == expected


def test_the_plan_stays_small():
    rng = random.Random(3)
    counts = [0] + [rng.randrange(10**9) for _ in range(packing.CAPACITY)]
    places, sequences = packing.plan(counts, packing.CAPACITY)
    assert len(places) < 60_000
    volume = sum(n * count for n, count in enumerate(counts)) / packing.CAPACITY
    # No two pieces of over half a sequence share one.
    assert sequences < 1.03 * max(volume, sum(counts[packing.CAPACITY // 2 + 1 :]))


def test_rows(spark, library):
    rng = random.Random(4)
    texts = odd_texts(rng) + ["a b c"] * 40 + [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 300))) for _ in range(80)]
    docs = documents(spark, texts, clashing=True).repartition(5)
    ids = {n: library.encode(t or "", add_special_tokens=False).ids + [0] for n, t in enumerate(texts)}
    for capacity in (packing.CAPACITY, 64):
        rows = packing.pack_documents(docs, capacity, with_ids=True)
        check(rows.collect(), ids, capacity)
    joined = {r.sequence_id: r.ids for r in packing.sequences(rows).collect()}
    for row in rows.collect():
        part = joined[row.sequence_id][4 * row.offset : 4 * (row.offset + row.length)]
        assert zlib.crc32(part) == row.ids_crc32


def test_repeated_rows_and_no_rows(spark):
    rows = packing.pack_documents(documents(spark, [(1, "same"), (1, "same"), (None, "same"), (3, None)])).collect()
    assert len(rows) == 4 and len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert [r.length for r in rows if r.doc_id == 3] == [1]
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_query(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    ids = {d.doc_id: library.encode(d.text or "", add_special_tokens=False).ids + [0] for d in docs}
    used = check(QUERIES["op7_exact_complement_packing"](spark, "/root/testdata/sf0.001").collect(), ids, 2048)
    assert used <= -(-sum(map(len, ids.values())) // 2048) + 1


def test_ids_are_the_librarys_over_all_control_characters(library):
    """Every character of white space or control between, before and behind others of its kind."""
    encode = packing.encoder(public_tokenizers.path(packing.VOCABULARY)).ids
    rng = random.Random(21)
    odd = [*range(0x21), 0x7F, *range(0x80, 0xA1), 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F]
    odd = [*map(chr, [*odd, 0x3000, 0xFEFF])]
    rest = ["a", "b", "'s", "1", ".", "é", "日", "the", "<|endoftext|>"]
    texts = [f"a{one}{two}b{one}\n\n{two}c" for one in odd for two in odd]
    texts += ["".join(rng.choices(odd + rest * 4, k=rng.randint(1, 14))) for _ in range(20_000)]
    texts += ["".join(rng.choices(odd, k=rng.randint(1, 8))) + "b" for _ in range(10_000)]
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encode(text) == expected.ids, repr(text)


def test_ids_are_the_librarys_over_all_code_points(library):
    encode = packing.encoder(public_tokenizers.path(packing.VOCABULARY)).ids
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 4096):
        text = "".join(f"a{chr(c)}b\n\n{chr(c)}2 {chr(c)}  {chr(c)} ." for c in points[start : start + 4096])
        assert encode(text) == library.encode(text, add_special_tokens=False).ids
