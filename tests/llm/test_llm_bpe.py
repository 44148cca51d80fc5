import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import documents, odd_texts
from tokenizers import Tokenizer

from scorelake.llm import bpe, packing
from scorelake.llm.queries import QUERIES

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def agrees(library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    words = bpe.vocabulary(PATH)
    ids = words.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == expected
    assert words.decode([ids, b"", ids])[2] == library.decode(expected, skip_special_tokens=False)
    assert packing.encoder(PATH).ids(text) == expected


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aaabeht  \n\t.'’éçß日本😀01ſ \x85\x1c", max_size=60))
def test_any_text_is_encoded_as_the_library_does(text):
    agrees(Tokenizer.from_file(PATH) if not hasattr(agrees, "of") else agrees.of, text)


def test_odd_texts(library):
    agrees.of = library
    for text in odd_texts(random.Random(2)):
        agrees(library, text or "")
    agrees(library, "ab" * 20_000)
    agrees(library, "a <|endoftext|><|endoftext|> \n\n  b<|endoftext|>")


def test_all_code_points(library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 2048):
        part = points[start : start + 2048]
        agrees(library, "".join(f"a{chr(c)}b 1{chr(c)}2 {chr(c)}  {chr(c)} ." for c in part))


def test_pairs_fit_as_merging_says(library):
    words, rng = bpe.vocabulary(PATH), random.Random(3)
    plain = [n for n, token in enumerate(words.tokens) if token.isascii() and token.isalpha()]
    for _ in range(3000):
        a, b = rng.choice(plain), rng.choice(plain)
        text = (words.tokens[a] + words.tokens[b]).decode()
        assert words.fits(a, b) == (library.encode(text, add_special_tokens=False).ids == [a, b])


def test_the_table_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    words = bpe.Vocabulary(PATH)
    first = [words.encode(f"word{n} other{n}") for n in range(20)]
    assert len(words.pieces) <= 5
    assert first == [words.encode(f"word{n} other{n}") for n in range(20)]


def test_rows(spark, library):
    texts = odd_texts(random.Random(4))
    got = bpe.round_trip(documents(spark, texts, clashing=True)).collect()
    assert len(got) == len(texts)
    for row in got:
        text = texts[row.doc_id] or ""
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert row.decoded == text
    assert bpe.round_trip(documents(spark, [])).count() == 0
    assert bpe.round_trip(documents(spark, [(None, "x")])).first().doc_id is None


def test_query(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op2_backtracking_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
