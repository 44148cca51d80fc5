"""Format-preserving pseudonyms for personal data.

Values are found by pattern and validated: card numbers by their check digit, IBANs by their
remainder, social security numbers, IPv4 addresses and dates by their ranges, telephone numbers
by how many digits they have. A value becomes a number below the size of its format, a keyed
Feistel permutation with cycle walking maps it to another one, and that is written in the same
form: check digits are made anew, separators stay. Equal values get equal pseudonyms in all
documents, however they are punctuated, and different values different ones; without the key
they cannot be turned back. E-mail addresses and secrets are no numbers but are permuted as well,
letter for letter and digit for digit, by a Feistel network over the characters: each round adds to
every second character a stream of numbers from a hash of all the others, so each depends on all
others, in time linear in the length. An address keeps its last label.

Forms that are covered: dates as 2024-01-31, also before a time ('T' and digits), 31.1.2024 and
1/31/2024; telephone numbers as 555-123-4567, (555) 123-4567 with or without a country code, and
after '+' and the country code any three to five groups of two to four digits, before which one
single digit may stand (+33 6 12 34 56 78); cards in fours, as 4-6-5 or unbroken; IBANs in capital
letters, in fours or unbroken. Secrets are runs of 16 characters or more, with the parts of a dotted
token, behind ':' or '=' after a name that has token, secret, password, passwd, pwd or api, access,
private or secret key in it (``aws_secret_access_key``, ``client-secret``), or behind ``Bearer``; and
signed tokens of three parts, AWS key ids and GitHub tokens wherever they stand. National numbers of
other forms, dates in words and secrets of other forms are not looked for.

A pattern may take in a word or number that follows. An IBAN or telephone number that is not valid
as found is tried with shorter ends between its groups, an IBAN first with its country's length;
where nothing is valid, the search goes on one character behind the candidate's start.

Defined results: a null text stays null and an empty one empty, without values; text without a
valid value is returned as it is; repeated values and rows get the same pseudonyms; texts are
searched whole; the rows' other columns are kept whatever their names.
"""

import hashlib
import math
import re
from array import array
from collections.abc import Callable
from datetime import date
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.llm.common import arrow_map, chunks, documents

ROUNDS = 8
#: Where a job sets its own key; without one, pseudonyms can be told by anyone who reads this.
KEY_SETTING = "spark.scorelake.pseudonymKey"
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ACCENTED = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
ALPHABETS = (LOWER, UPPER, DIGITS, ACCENTED, ACCENTED.upper().replace("Ÿ", ""))

PATTERN = re.compile(
    r"""
    (?P<email>(?<![\w.+-])[\w.+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})
    |(?P<secret>(?:(?<![A-Za-z0-9_-])(?i:(?:[a-z0-9]+[_-])*(?:[a-z0-9]*(?:token|secret|password|passwd|pwd)|(?:api|access|private|secret)[_-]?key)
            (?:[_-][a-z0-9]+)*)["']?\s*[:=]\s*["']?(?:(?i:bearer)\s+)?|(?<!\w)(?i:bearer)\s+)
        (?P<hidden>[A-Za-z0-9+/_-]{16,}(?:\.[A-Za-z0-9+/_-]+)*))
    |(?P<bare>(?<![\w.-])(?:eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,})(?![\w-]))
    |(?P<iban>\b[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?\b)
    |(?P<card>(?<![\w.-])(?:\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\w-]))
    |(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
    |(?P<ip>(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d))
    |(?P<date>(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}(?=[Tt]\d)|(?:\d{4}-\d{2}-\d{2}|\d{1,2}(?P<mark>[/.])\d{1,2}(?P=mark)\d{4})(?!\w|[/-]\d)))
    |(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\w)
        |(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}(?!\w)
        |(?<![\w+])\+\d{1,3}[ .-]?\d(?:[ .-]?\d{2,4}){3,5}(?!\w))
    """,
    re.VERBOSE,
)
#: Characters of an IBAN by country; others are found by their remainder alone.
IBAN_SIZES = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
BORDER = re.compile("[ .-]")
SOME = re.compile(r"[0-9@]|(?i:token|secret|passw|pwd|key|bearer)|eyJ|AKIA|ASIA|gh[pousr]_")


class Permutation:
    """A keyed permutation of the numbers below ``size``, 512 bits at most; ``allowed`` may leave some out."""

    def __init__(self, key: bytes, name: str, size: int):
        self.size = size
        self.left = math.isqrt(max(size, 1) - 1) + 1
        self.right = -(-size // self.left)
        of_size = size.to_bytes((size.bit_length() + 7) // 8, "little")
        self.key = hashlib.blake2b(name.encode() + b":" + of_size, key=key[:64], digest_size=32).digest()

    def _by(self, turn: int, half: int) -> int:
        data = turn.to_bytes(1, "little") + half.to_bytes((half.bit_length() + 8) // 8, "little")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "little")

    def _once(self, value: int) -> int:
        a, b = divmod(value, self.right)
        for turn in range(ROUNDS):
            if turn % 2:
                b = (b + self._by(turn, a)) % self.right
            else:
                a = (a + self._by(turn, b)) % self.left
        return a * self.right + b

    def of(self, value: int, allowed: Callable[[int], bool] = lambda _: True) -> int:
        """Walks on while the result is outside; the value itself must be inside."""
        while True:
            value = self._once(value)
            if value < self.size and allowed(value):
                return value


@lru_cache(maxsize=4096)
def permutation(key: bytes, name: str, size: int) -> Permutation:
    return Permutation(key, name, size)


def luhn_digit(payload: str) -> int:
    total = 0
    for place, digit in enumerate(reversed(payload)):
        value = int(digit) * (1 if place % 2 else 2)
        total += value - 9 if value > 9 else value
    return -total % 10


def _refilled(form: str, digits: str) -> str:
    """The form with its digits replaced, separators as they were."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in form)


def _card(key: bytes, text: str) -> str | None:
    digits = re.sub(r"\D", "", text)
    if luhn_digit(digits[:-1]) != int(digits[-1]):
        return None
    size = len(digits) - 1
    payload = f"{permutation(key, 'card', 10**size).of(int(digits[:-1])):0{size}d}"
    return _refilled(text, payload + str(luhn_digit(payload)))


def _ssn(key: bytes, text: str) -> str | None:
    def valid(value: int) -> bool:
        area, group, serial = value // 10**6, value // 10**4 % 100, value % 10**4
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    value = int(text.replace("-", ""))
    if not valid(value):
        return None
    return _refilled(text, f"{permutation(key, 'ssn', 10**9).of(value, valid):09d}")


def _ip(key: bytes, text: str) -> str | None:
    parts = [int(part) for part in text.split(".")]
    if max(parts) > 255:
        return None
    value = permutation(key, "ip", 2**32).of(int.from_bytes(bytes(parts), "big"))
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(key: bytes, text: str) -> str | None:
    """ISO, day.month.year, or month/day/year; day/month/year where that is the only reading."""
    numbers = [int(part) for part in re.split(r"\D", text)]
    slashed = "/" in text
    if "-" in text:
        year, month, day = numbers
    elif slashed and numbers[0] <= 12:
        month, day, year = numbers
    else:
        day, month, year = numbers
    try:
        at = date(year, month, day).toordinal() - FIRST_DAY
    except ValueError:
        return None
    size = LAST_DAY - FIRST_DAY + 1
    if not 0 <= at < size:
        return None
    late = slashed and numbers[0] > 12
    found = date.fromordinal(
        FIRST_DAY + permutation(key, "date", size).of(at, lambda n: not late or date.fromordinal(FIRST_DAY + n).day > 12)
    )
    if "-" in text:
        return found.isoformat()
    padded = len(re.match(r"\d+", text)[0]) == 2
    first, second = (found.month, found.day) if slashed and not late else (found.day, found.month)
    mark = "/" if slashed else "."
    return f"{first:02d}{mark}{second:02d}{mark}{found.year}" if padded else f"{first}{mark}{second}{mark}{found.year}"


def _phone(key: bytes, text: str) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 10 <= len(digits) <= 15:
        return None
    last = digits[-10:]
    return _refilled(text, digits[:-10] + f"{permutation(key, 'phone', 10**10).of(int(last)):010d}")


def _iban(key: bytes, text: str) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _remainder(plain[4:] + plain[:4]) != 1:
        return None
    account = _spelled(key, "iban", plain[4:])
    check = 98 - _remainder(f"{account}{plain[:2]}00")
    left = iter(f"{plain[:2]}{check:02d}{account}")
    return "".join(c if c == " " else next(left) for c in text)


def _remainder(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


_ALPHABET = {char: alphabet for alphabet in ALPHABETS for char in alphabet}
_PLACE = {char: place for alphabet in ALPHABETS for place, char in enumerate(alphabet)}


def _spelled(key: bytes, name: str, text: str) -> str:
    """The text with each character replaced by one of its alphabet; characters of none stay."""
    chars = list(text)
    places = [at for at, char in enumerate(chars) if char in _ALPHABET]
    alphabets = [_ALPHABET[chars[at]] for at in places]
    values = [_PLACE[chars[at]] for at in places]
    form = "".join(alphabet[0] for alphabet in alphabets)
    form_key = hashlib.blake2b(f"{name}:{form}".encode(), key=key[:64], digest_size=32).digest()
    sizes = [len(alphabet) for alphabet in alphabets]
    # Two halves of every second character, whatever the form looks like.
    halves = [values[0::2], values[1::2]]
    half_sizes = [sizes[0::2], sizes[1::2]]
    for turn in range(ROUNDS):
        here, other = turn % 2, 1 - turn % 2
        seed = form_key + bytes([turn]) + bytes(halves[other])
        stream = array("Q", hashlib.shake_256(seed).digest(8 * len(halves[here])))
        halves[here] = [(value + more) % size for value, more, size in zip(halves[here], stream, half_sizes[here], strict=True)]
    values[0::2], values[1::2] = halves
    for at, alphabet, value in zip(places, alphabets, values, strict=True):
        chars[at] = alphabet[value]
    return "".join(chars)


def _email(key: bytes, text: str) -> str:
    names, _, last = text.rpartition(".")
    return f"{_spelled(key, 'email', names)}.{last}"


def _secret(key: bytes, text: str) -> str:
    return _spelled(key, "secret", text)


KINDS = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "ip": _ip, "date": _date, "phone": _phone}


def _readings(kind: str, text: str) -> list[str]:
    """The candidate, and what is left of it when groups at its end belong to something else."""
    if kind not in ("iban", "phone"):
        return [text]
    found = [text, *(text[: border.start()] for border in reversed(list(BORDER.finditer(text))))]
    if kind == "iban":
        size = IBAN_SIZES.get(text[:2])
        found.sort(key=lambda reading: len(reading.replace(" ", "")) != size)
    return found


def pseudonymised(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, length) of each in the new text."""
    parts, spans, done, size, at = [], [], 0, 0, 0
    while match := PATTERN.search(text, at):
        kind = match.lastgroup if match.lastgroup in KINDS else next(k for k in (*KINDS, "secret", "bare") if match[k] is not None)
        if kind in ("secret", "bare"):
            found = match["hidden"] or match["bare"]
            kind, start, end, value = "secret", match.end() - len(found), match.end(), _secret(key, found)
        else:
            start = match.start()
            for reading in _readings(kind, match[0]):
                end, value = start + len(reading), KINDS[kind](key, reading)
                if value is not None:
                    break
        if value is None:
            at = start + 1
            continue
        parts += [text[done:start], value]
        size += start - done
        spans.append((kind, size, len(value)))
        size += len(value)
        at = done = end
    return "".join([*parts, text[done:]]), spans


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """The rows as ``row``, the new text as ``safe``, and the pseudonyms' places as ``spans``."""
    spans_kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))

    def run(batches):
        for chunk in chunks(batches, "text"):
            safe, spans = [], []
            for text in chunk.column("text").to_pylist():
                if text and SOME.search(text):
                    text, places = pseudonymised(text, key)
                else:
                    places = []
                safe.append(text)
                spans.append([{"kind": k, "start": s, "length": n} for k, s, n in places])
            yield pa.RecordBatch.from_arrays(
                [chunk.column("row"), pa.array(safe, pa.string()), pa.array(spans, spans_kind)], names=["row", "safe", "spans"]
            )

    others = [F.col(f"`{name}`") for name in docs.columns if name.lower() != "text"]
    rows = docs.select(F.struct(*(others or [F.lit(None).cast("int").alias("none")])).alias("row"), "text")
    added = T.StructType.fromDDL("safe string, spans array<struct<kind: string, start: long, length: long>>")
    return arrow_map(rows, run, T.StructType([rows.schema["row"], *added]))


def key_of(spark) -> bytes:
    return spark.conf.get(KEY_SETTING, "scorelake").encode("utf-8")


def op5_feistel_pseudonyms(spark, sf_dir):
    found = pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), key_of(spark))
    return found.select(
        "row.doc_id", F.col("safe").alias("text"), F.size("spans").cast("long").alias("n_values"), "spans"
    )
