"""Hand-made documents shared by the tests of the text operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHING = ["row", "mark", "key", "node", "label", "kept", "safe", "first", "batch", "part", "at", "shard", "_row", "rejected"]


def documents(spark, texts, clashing=False):
    """Documents numbered from 0; an item may also be (doc_id, text) or (doc_id, text, lang)."""
    rows = []
    for number, item in enumerate(texts):
        doc_id, text, lang = (item + ("en",))[:3] if isinstance(item, tuple) else (number, item, "en")
        rows.append((doc_id, text, lang, None, None if text is None else len(text)))
    frame = spark.createDataFrame(rows, DOCS)
    if clashing:
        for name in CLASHING:
            frame = frame.selectExpr("*", f"'{name}' AS `{name}`")
    return frame


def words(rng: random.Random, count: int) -> list[str]:
    return ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(3, 9))) for _ in range(count)]


def odd_texts(rng: random.Random) -> list[str | None]:
    """Null, empty, blank, symbols, other scripts, one long word, a long text, and copies."""
    prose = " ".join(words(rng, 120))
    long = "\n".join(" ".join(words(rng, 40)) for _ in range(400))
    return [
        None, "", " ", "\n\n", "!!! ###", "12345", "日本語のテキスト", "😀 a b\x1cc", "x" * 30_000, long, prose, prose,
        prose.upper(), "a  b\t\tc \n d", "it's we'll <|endoftext|> don't", "That it.", "That it.",
    ]
