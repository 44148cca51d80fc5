"""Quality rules: base counts, and how well zstandard compresses a text and its chunks.

Words are runs of anything but ASCII white space. A text fails the base rules if it has under
50 words or over half of its words lie in three-word windows that occur twice or more. Its
compression ratio (bytes over compressed bytes) must then lie in a band that depends on its
length: under it the text is close to random, over it repetitive. Texts are also cut into
fixed chunks, each held against the band of the chunk's own length; a text of which more than
half the bytes lie in chunks outside their band is rejected although it passes as a whole.

Defined results: a null or empty text has no words and fails; ties and equal rows are judged
one by one; the whole text counts however long it is; other columns are not looked at.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from scorelake.llm.common import documents, map_chunks

LEVEL = 3
CHUNK = 8192
LEAST_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes up to which a band holds, lowest and highest ratio allowed.
BANDS = (
    (256, 1.0, 3.0),
    (1024, 1.15, 3.2),
    (4096, 1.4, 3.8),
    (16384, 1.6, 4.5),
    (65536, 1.7, 5.5),
    (float("inf"), 1.7, 6.5),
)

SCHEMA = """doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,
n_repeat_words long, base_failed boolean, kept boolean, ratio double, chunks_outside double"""


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more, the first time included."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(word, len(known)) for word in words], dtype=np.int64)
    if len(known) == len(ids):
        return 0
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = np.concatenate([times[window] > 1, [False, False]])
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return int(covered.sum())


def code_points(raw: bytes) -> int:
    if raw.isascii():
        return len(raw)
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def in_band(size: int, ratio: float) -> bool:
    low, high = next((low, high) for most, low, high in BANDS if size <= most)
    return low <= ratio <= high


def judged(raw: bytes | None, compress) -> tuple:
    """A text's counts, whether the base rules fail it, the verdict and the measured ratios."""
    raw = raw or b""
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = repeated_words(words)
    failed = len(words) < LEAST_WORDS or 100 * repeated > MOST_REPEATED * len(words)
    ratio = len(raw) / len(compress(raw)) if raw else 0.0
    outside = 0
    if len(raw) > CHUNK:
        for start in range(0, len(raw), CHUNK):
            chunk = raw[start : start + CHUNK]
            if not in_band(len(chunk), len(chunk) / len(compress(chunk))):
                outside += len(chunk)
    share = outside / len(raw) if raw else 0.0
    return (
        len(words),
        code_points(raw.translate(None, SPACES)),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        failed,
        not failed and in_band(len(raw), ratio) and share <= 0.5,
        ratio,
        share,
    )


def judge(docs: DataFrame) -> DataFrame:
    """Per document the counts, ``base_failed``, ``kept`` and the ratios behind the verdict."""

    def work(chunk: pa.RecordBatch) -> pa.RecordBatch:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        texts = chunk.column("text").cast(pa.binary()).to_pylist()
        columns = list(zip(*(judged(text, compress) for text in texts), strict=True)) or [()] * 9
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
        names = [part.split()[0] for part in SCHEMA.split(",")]
        return pa.RecordBatch.from_arrays([chunk.column("doc_id").cast(pa.int64()), *arrays], names=names)

    return map_chunks(docs.select("doc_id", "text"), work, SCHEMA, "text")


def op6_compression_bands(spark, sf_dir):
    return judge(documents(spark, sf_dir))
