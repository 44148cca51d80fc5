"""Byte-level BPE by backtracking, and decoding by an offset table.

Encoding a piece of text: an Aho-Corasick automaton over all tokens gives the longest token
that starts at each byte. The encoder takes the longest one and goes on; where a token does not
fit behind the one before it, the next shorter token that is a prefix is tried, and where none
is left the last token is taken back. Two tokens fit if merging their bytes gives just these
two; that is worked out from the order of merges and kept in a table of pairs. A position that
has failed once is never entered again, so the work is linear in the length of the piece, and
the result is the one that applying the merges in order gives.

Decoding gathers the bytes of all ids at once from one buffer by a table of offsets.

Pieces are the matches of the vocabulary's split pattern; texts of special tokens are cut out
before. Short pieces are remembered in a table of bounded size.

Defined results: a null text is taken as empty, and an empty one has no ids and decodes to the
empty text; equal rows are encoded alike; texts are encoded whole; other columns are not looked
at. Ids that a vocabulary does not have decode to nothing, bytes that are no UTF-8 to U+FFFD.
"""

import json
import re
import sys
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import class_of, documents, map_chunks

VOCABULARY = "byte_bpe_50k.json"
#: Longer pieces are encoded each time; so many short ones are remembered by a worker.
REMEMBERED_LENGTH = 40
REMEMBERED = 300_000
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def printable_bytes() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the 256 bytes.

    Visible Latin-1 characters stand for themselves, the others for those from U+0100 on.
    """
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


def split_pattern(last: int = sys.maxunicode) -> re.Pattern:
    """The public split pattern with its classes spelled out up to a code point, so that ``re`` can run it.

    Up to U+FFFF a class is one table look-up, beyond it is a list that is walked through.
    """
    letters, numbers = class_of("L", last), class_of("N", last)
    pattern = public_tokenizers.PATTERN
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACE}{letters}{numbers}]")
    pattern = pattern.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
    return re.compile(pattern.replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))


class Pieces(dict):
    """Remembered pieces; the table starts anew when it is full."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece.encode("utf-8"))
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        as_byte = printable_bytes()
        written = parts["model"]["vocab"]
        size = 1 + max([*written.values(), *(token["id"] for token in parts["added_tokens"])])
        self.tokens: list[bytes] = [b""] * size
        for text, token in written.items():
            self.tokens[token] = bytes(as_byte[c] for c in text)
        self.special = {token["content"]: token["id"] for token in parts["added_tokens"]}
        # How each token is made: the turn of its merge (-1: a byte) and its two parts.
        self.turn, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.merged: dict[int, int] = {}
        self.size = size
        for turn, merge in enumerate(parts["model"]["merges"]):
            first, second = merge if isinstance(merge, list) else merge.split(" ")
            a, b, made = written[first], written[second], written[first + second]
            self.merged[a * size + b] = turn
            if self.turn[made] < 0:
                self.turn[made], self.left[made], self.right[made] = turn, a, b
        self.fit: dict[int, bool] = {}
        known = {token: number for number, token in enumerate(self.tokens) if token}
        self.whole = known
        self.length = [len(token) for token in self.tokens]
        self.shorter = [self._longest_prefix(token, known) for token in self.tokens]
        self.starts = ahocorasick.Automaton()
        for token, number in known.items():
            self.starts.add_word(token.decode("latin-1"), number)
        self.starts.make_automaton()
        for content, number in self.special.items():
            self.tokens[number] = content.encode("utf-8")
        ends = np.cumsum([0, *map(len, self.tokens)])
        self.offsets, self.bytes = ends.astype(np.int64), np.frombuffer(b"".join(self.tokens), np.uint8)
        self.split_basic, self.split_any = split_pattern(0xFFFF), split_pattern()
        self.beyond = re.compile("[\U00010000-\U0010ffff]")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pieces = Pieces(self.encode_piece)

    @staticmethod
    def _longest_prefix(token: bytes, known: dict[bytes, int]) -> int:
        for end in range(len(token) - 1, 0, -1):
            if token[:end] in known:
                return known[token[:end]]
        return -1

    def fits(self, first: int, second: int) -> bool:
        """Whether merging the bytes of both tokens gives just these two.

        Merges are undone from the last one back. In between, the parts that face each other
        must not have a merge of their own that would have come before the one just undone.
        """
        pair = first * self.size + second
        known = self.fit.get(pair)
        if known is not None:
            return known
        if len(self.fit) >= 2 * REMEMBERED:
            self.fit.clear()
        a, b, before, ok = first, second, float("inf"), True
        while True:
            turn = self.merged.get(a * self.size + b)
            if turn is not None and turn < before:
                ok = False
                break
            if self.turn[a] < 0 and self.turn[b] < 0:
                break
            if self.turn[a] > self.turn[b]:
                before, a = self.turn[a], self.right[a]
            else:
                # Of two equal merges the one further left comes first.
                before, b = self.turn[b] + 1, self.left[b]
        self.fit[pair] = ok
        return ok

    def encode_piece(self, piece: bytes) -> bytes:
        """The ids of a piece, as little-endian unsigned 32-bit integers."""
        token = self.whole.get(piece)
        if token is not None:
            return token.to_bytes(4, "little")
        text, fit, size = piece.decode("latin-1"), self.fit, self.size
        # Where the longest tokens, one after the other, all fit, they are the answer.
        taken = [token for _, token in self.starts.iter_long(text)]
        before = taken[0]
        for token in taken[1:]:
            ok = fit.get(before * size + token)
            if ok is None:
                ok = self.fits(before, token)
            if not ok:
                return self._backtracked(text)
            before = token
        return array("I", taken).tobytes()

    def _backtracked(self, text: str) -> bytes:
        length, shorter, fit, size, end = self.length, self.shorter, self.fit, self.size, len(text)
        longest = [0] * end
        for last, token in self.starts.iter(text):
            longest[last + 1 - length[token]] = token  # later ends are longer
        open_at = bytearray(b"\x01") * (end + 1)
        taken: list[int] = []
        at, token = 0, longest[0]
        while at < end:
            after = at + length[token]
            ok = open_at[after]
            if ok and taken:
                ok = fit.get(taken[-1] * size + token)
                if ok is None:
                    ok = self.fits(taken[-1], token)
            if ok:
                taken.append(token)
                at = after
                if at < end:
                    token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                open_at[at] = 0
                token = taken.pop()
                at -= length[token]
        return array("I", taken).tobytes()

    def split(self, text: str) -> list[str]:
        return (self.split_any if self.beyond.search(text) else self.split_basic).findall(text)

    def encode(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return b"".join(map(self.pieces.__getitem__, self.split(text)))
        parts = []
        for part in self.cut.split(text):
            if part in self.special:
                parts.append(self.special[part].to_bytes(4, "little"))
            else:
                parts.extend(map(self.pieces.__getitem__, self.split(part)))
        return b"".join(parts)

    def decode(self, ids: list[bytes]) -> list[str]:
        """The texts of several documents' ids, gathered together."""
        joined = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        joined = np.where(joined < self.size, joined, 0) if joined.size else joined
        begin = self.offsets[joined]
        sizes = self.offsets[joined + 1] - begin
        ends = np.cumsum(sizes)
        where = np.repeat(begin - (ends - sizes), sizes)
        where += np.arange(len(where))
        text = self.bytes[where].tobytes()
        ends = np.concatenate([[0], ends])
        cuts = ends[np.concatenate([[0], np.cumsum([len(one) // 4 for one in ids])]).astype(np.int64)]
        return [text[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One for each worker process."""
    return Vocabulary(path)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, ids (little-endian unsigned 32-bit) and the text decoded from them."""
    path = path or public_tokenizers.path(VOCABULARY)

    def work(chunk: pa.RecordBatch) -> pa.RecordBatch:
        words = vocabulary(path)
        ids = [words.encode(text or "") for text in chunk.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [chunk.column("doc_id").cast(pa.int64()), pa.array(ids, pa.binary()), pa.array(words.decode(ids), pa.string())],
            names=["doc_id", "ids", "decoded"],
        )

    return map_chunks(docs.select("doc_id", "text"), work, "doc_id long, ids binary, decoded string", "text")


def op2_backtracking_bpe(spark, sf_dir):
    return round_trip(documents(spark, sf_dir)).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
