"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

A value is replaced only if it is valid (calendar date, Luhn number, octets, country check digits).
Its characters become one number below the count of values of its format; a keyed Feistel network
permutes that range (cycle walking stays inside it) and the result is written in the same format. So
equal values stay equal across documents, different ones stay different, and the key undoes it.
Check digits are computed anew, so a pseudonym is as valid as the value was. No shuffle: every task
rewrites its own documents; the key travels with the task, not with the data.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import chunks

# For tests and examples; a user passes a secret.
EXAMPLE_KEY = b"caseflow example key"
ROUNDS = 8

# Formats, in the order in which they are tried at one place.
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]+@(?:[\w-]+\.)+[^\W0-9_]{2,}",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?(?!\w)",
    "access": r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)",
    "secret": r"""(?i:password|passwd|secret|token|api_?key)["']?\s{0,3}[=:]\s{0,3}
      (?:"(?P<double>[^"\n]{4,200})"|'(?P<single>[^'\n]{4,200})'
      |["']?(?P<hidden>(?:[^\s"'<>,;&]|[,;&](?!\w+=|\s))+(?<=[^\W_])))""",
    "iso": r"(?<![\w-])\d{4}-\d{2}-\d{2}(?:(?=T\d\d)|(?![\w-]))",
    "slashed": r"(?<![\w/])\d{1,2}/\d{1,2}/\d{4}(?![\w/])",
    "dotted": r"(?<![\w.])\d{1,2}\.\d{1,2}\.\d{4}(?!\w|\.\d)",
    "address": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)",
    "phone": r"""(?<!\w)(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}
      (?![\w-])""",
    "social": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"""(?<![\w.])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?:(?P=gap)\d{1,4}){2,3}
      |\d{4}(?P<wide>[ -])\d{6}(?P=wide)\d{4,5})(?!\w)""",
    "abroad": r"""(?<!\w)\+[1-9](?:\d{6,14}|\d{0,5}(?:[ .-]?\(\d{1,5}\)\d{0,8})?[ ./-]?(?<!\d)\d{1,8}
      (?:(?P<bar>[ ./-])\d{1,8}(?:(?P=bar)\d{1,8}){0,5})?(?:-\d{1,5})?)(?![\w-]|[./]\d)""",
    "national": r"""(?<![\w+./-])(?!\d{3}-\d{2}-\d{4}(?!\w))(?:0[1-9](?:\.\d{2}){4}
      |[6-9]\d{2}(?:\ \d{2}){3}|9\d\ \d{3}(?:\ \d{2}){2}
      |(?:\(0[1-9]\d{0,3}\)[ ./-]?|0[1-9]\d{0,3}[ /-])\d{2,8}
      (?:(?P<rail>[ -])\d{2,8}(?:(?P=rail)\d{2,8}){0,3})?(?:-\d{1,4})?)(?![\w-]|[./]\d)""",
}
# Digits are ASCII digits.
PATTERNS = {k: v.replace(r"\d", "[0-9]") for k, v in PATTERNS.items()}
KINDS = tuple(PATTERNS)
# Kinds that are reported under another name.
NAMES = {"abroad": "phone", "national": "phone"}
# Country codes of one and two digits; all others have three.
SHORT_CODES = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")
FORMATS = re.compile("|".join(f"(?P<{k}>{v})" for k, v in PATTERNS.items()), re.VERBOSE)
ONE_FORMAT = {k: re.compile(v, re.VERBOSE) for k, v in PATTERNS.items()}
# Characters behind a value that a match starting in front of it can still read.
REACH = 64
# Lengths of the account numbers of countries (ISO 13616).
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
HINT = re.compile(r"[0-9@]|AKIA|(?i:password|passwd|secret|token|key)")
DIGITS = "0123456789"
LOWERS = "abcdefghijklmnopqrstuvwxyz"
UPPERS = LOWERS.upper()
ACCENTED = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß"
CLASSES = (DIGITS, LOWERS, UPPERS, ACCENTED, ACCENTED[:-2].upper())
HEX = "0123456789abcdef"
# Dates of these years are permuted among themselves, and all others among themselves.
FIRST_DAY = dt.date(1900, 1, 1).toordinal()
DAYS = dt.date(2100, 1, 1).toordinal() - FIRST_DAY
ALL_DAYS = dt.date.max.toordinal()
# Longer values are permuted in pieces of so many characters.
PIECE = 128


@lru_cache(1 << 14)
def alphabet(char: str) -> str:
    """The letters or digits beyond ``CLASSES`` of a character's script, case and block; else none."""

    def script(c: str) -> tuple[str, str]:
        return unicodedata.category(c), unicodedata.name(c, "").split(" ")[0]

    first = ord(char) & ~127
    block = [c for c in map(chr, range(first, first + 128)) if c.isalnum()]
    if char not in block or any(char in c for c in CLASSES):
        return ""
    return "".join(
        c for c in block if script(c) == script(char) and not any(c in k for k in CLASSES)
    )


class Permutation:
    """A keyed permutation of ``range(size)`` for any size and name of a format."""

    def __init__(self, key: bytes, backwards: bool = False):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.backwards = backwards
        self.permute = lru_cache(1 << 14)(self._permute)

    def _round(self, name: str, size: int, number: int, half: int, mask: int) -> int:
        said = f"{name}:{size}:{number}:{half}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=64).digest()) & mask

    def _once(self, name: str, size: int, value: int, bits: int) -> int:
        mask = (1 << bits) - 1
        left, right = value >> bits, value & mask
        for number in reversed(range(ROUNDS)) if self.backwards else range(ROUNDS):
            if self.backwards:
                left, right = right ^ self._round(name, size, number, left, mask), left
            else:
                left, right = right, left ^ self._round(name, size, number, right, mask)
        return left << bits | right

    def _permute(self, name: str, size: int, value: int) -> int:
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        value = self._once(name, size, value, bits)
        while value >= size:
            value = self._once(name, size, value, bits)
        return value

    def within(self, name: str, size: int, value: int, valid: Callable[[int], bool]) -> int:
        """Permute the valid members of the range among themselves."""
        value = self.permute(name, size, value)
        while not valid(value):
            value = self.permute(name, size, value)
        return value

    def text(self, name: str, text: str, classes: tuple[str, ...]) -> str:
        """Permute the characters that are in a class, each within its class, as one number.
        With ``CLASSES``, letters and digits beyond them are permuted within their alphabet."""
        if len(text) > PIECE:
            pieces = range(0, len(text), PIECE)
            return "".join(self.text(f"{name} {at}", text[at : at + PIECE], classes) for at in pieces)
        number, size, places = 0, 1, []
        for at, char in enumerate(text):
            members = next((c for c in classes if char in c), None)
            if not members and classes is CLASSES:
                members = alphabet(char)
            if members:
                places.append((at, members))
                number, size = number * len(members) + members.index(char), size * len(members)
        if size < 2:
            return text
        shape = "".join(str(classes.index(m)) if m in classes else f"<{m[0]}>" for _, m in places)
        number, out = self.permute(f"{name}/{shape}", size, number), list(text)
        for at, members in reversed(places):
            number, digit = divmod(number, len(members))
            out[at] = members[digit]
        return "".join(out)


def luhn_digit(digits: str) -> str:
    """The check digit for the digits before it."""
    total = 0
    for at, char in enumerate(reversed(digits)):
        value = int(char) * (2 if at % 2 == 0 else 1)
        total += value - 9 if value > 9 else value
    return str(-total % 10)


def is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and len(set(digits)) > 1 and luhn_digit(digits[:-1]) == digits[-1]


def enough(phone: str) -> bool:
    """Whether a national or foreign phone number has enough digits."""
    return len(re.sub(r"\D", "", phone)) >= (7 if phone[0] in "+(" else 9)


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def refill(shape: str, chars: str) -> str:
    """``shape`` with its letters and digits replaced in order."""
    rest = iter(chars)
    return "".join(next(rest) if c.isalnum() else c for c in shape)


class Pseudonyms:
    """Replaces every valid value in a text; ``backwards`` undoes it."""

    def __init__(self, key: bytes, backwards: bool = False):
        self.feistel = Permutation(key, backwards)

    def email(self, value: str) -> str:
        local, domain = value.rsplit("@", 1)
        return f"{self.feistel.text('email', local, CLASSES)}@{domain}"

    def iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        country, check, account = plain[:2], plain[2:4], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_check(country, account) != check:
            return None
        account = self.feistel.text(f"iban {country}", account, CLASSES)
        return refill(value, country + iban_check(country, account) + account)

    def access(self, value: str) -> str:
        return value[:4] + self.feistel.text("access", value[4:], (DIGITS + UPPERS,))

    def secret(self, value: str) -> str | None:
        match = ONE_FORMAT["secret"].match(value)
        part = next(k for k in ("double", "single", "hidden") if match[k] is not None)
        start, end = match.span(part)
        hidden = value[start:end]
        if part == "hidden":
            told = len(hidden) >= 12 or value[start - 1] == "=" or re.search(r"[0-9!@#$%^&*+=~?]", hidden)
            if len(hidden) < 4 or not told or re.match(r"\w+://", hidden):
                return None
        hexadecimal = lambda v: len(v) >= 12 and all(c in HEX for c in v)
        classes = (HEX,) if hexadecimal(hidden) else CLASSES
        new = self.feistel.text("secret", hidden, classes)
        while hexadecimal(new) != hexadecimal(hidden):
            new = self.feistel.text("secret", new, classes)
        return value[:start] + new + value[end:]

    def day(self, name: str, date: dt.date, valid: Callable[[dt.date], bool]) -> dt.date:
        near = lambda d: 0 <= d.toordinal() - FIRST_DAY < DAYS
        first, size, name = (FIRST_DAY, DAYS, name) if near(date) else (1, ALL_DAYS, f"{name} far")
        back = lambda n: dt.date.fromordinal(first + n)
        own = near(date)
        return back(
            self.feistel.within(
                name, size, date.toordinal() - first, lambda n: near(back(n)) == own and valid(back(n))
            )
        )

    def iso(self, value: str) -> str | None:
        date = real_date(*map(int, value.split("-")))
        return date and self.day("iso", date, lambda d: True).isoformat()

    def slashed(self, value: str) -> str | None:
        return self.parts(value, "/", "", "month", "day")

    def dotted(self, value: str) -> str | None:
        return self.parts(value, ".", "dotted ", "day", "month")

    def parts(self, value: str, sign: str, name: str, *usual: str) -> str | None:
        """A date by its usual order of day and month, else by the other one."""
        one, two, year = value.split(sign)
        wide = len(one) == len(two) == 2
        # One part with a zero in front, the other of one digit.
        mixed = not wide and "0" in (one[0], two[0])

        def fits(d: dt.date) -> bool:
            least, most = sorted((d.day, d.month))
            return wide or (most if mixed else least) < 10

        for first, second in (usual, usual[::-1]):
            read = {first: int(one), second: int(two)}
            date = real_date(int(year), **read)
            if date and fits(date):
                usually = first == usual[0]
                new = self.day(
                    f"{name}{first} first {'mixed' if mixed else wide}{len(one) if mixed else ''}",
                    date,
                    lambda d: fits(d) and (usually or d.day > 12),  # noqa: B023
                )
                a, b = (str(getattr(new, part)) for part in (first, second))
                if wide or mixed:
                    a, b = a.zfill(len(one)), b.zfill(len(two))
                return f"{a}{sign}{b}{sign}{new.year:04d}"
        return None

    def address(self, value: str) -> str | None:
        octets = value.split(".")
        if any(int(o) > 255 or o != str(int(o)) for o in octets):
            return None
        number = int.from_bytes(bytes(map(int, octets)))
        new = self.feistel.permute("address", 1 << 32, number)
        return ".".join(map(str, new.to_bytes(4)))

    def phone(self, value: str) -> str:
        country = re.match(r"\+\d{1,3}(?=[ .(-])", value)
        own = country[0] if country else ""
        return own + self.feistel.text("phone", value[len(own) :], (DIGITS,))

    def abroad(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not enough(value) or len(digits) > 15:
            return None
        code = SHORT_CODES.match(digits)
        own = 1 + (code.end() if code else 3)
        own += len(re.match(r"(?:[ .-]?\(0\))?", value[own:])[0])
        return value[:own] + self.feistel.text("abroad", value[own:], (DIGITS,))

    def national(self, value: str) -> str | None:
        if not enough(value) or len(re.sub(r"\D", "", value)) > 12:
            return None
        own = re.match(r"\(?0[1-9]|\d", value).end()
        return value[:own] + self.feistel.text("national", value[own:], (DIGITS,))

    def social(self, value: str) -> str | None:
        def valid(n: int) -> bool:
            area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
            return area not in (0, 666) and area < 900 and group > 0 and serial > 0

        number = int(value.replace("-", ""))
        if not valid(number):
            return None
        return refill(value, f"{self.feistel.within('social', 10**9, number, valid):09d}")

    def card(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not is_card(digits):
            return None
        new = self.feistel.text("card", digits[:-1], (DIGITS,))
        return refill(value, new + luhn_digit(new))

    def spans(self, kind: str, match: re.Match) -> Iterator[tuple[int, int]]:
        """Where in a match the value may be: an iban has its country's length, or else is the whole
        match; a card is a run of digit groups, longest first from the left; a phone number ends before
        a card, and where it would have too many digits."""
        start, value = match.start(), match[0]
        if kind == "iban":
            places = [at for at, c in enumerate(value) if c != " "]
            length = IBAN_LENGTHS.get(value[:2], len(places))
            if length < len(places) and value[places[length - 1] + 1] == " ":
                yield start, start + places[length - 1] + 1
        if kind == "card":
            groups = [m.span() for m in re.finditer(r"\d+", value)]
            for first, (begin, _) in enumerate(groups):
                for _, end in reversed(groups[first:]):
                    yield start + begin, start + end
        elif kind in NAMES:
            groups = [m.span() for m in re.finditer(r"\d+", value)]
            card = ONE_FORMAT["card"]
            cards = [at for at, _ in groups[1:] if card.match(match.string, start + at)]
            # By shape where enough digits are in front, so that pseudonyms are read alike.
            stop = next((at for at in cards if enough(value[:at])), None) or next(
                (at for at in cards if self.starts_card(match.string, start + at)), len(value)
            )
            for _, end in reversed(groups):
                if end <= stop:
                    yield start, start + end
        else:
            yield match.span()

    def starts_card(self, text: str, at: int) -> bool:
        match = ONE_FORMAT["card"].match(text, at)
        return bool(match) and any(
            begin == at and self.card(text[begin:end]) for begin, end in self.spans("card", match)
        )

    def first(self, text: str, at: int) -> tuple[str, int, int, str, int | None] | None:
        """Kind, start, end and pseudonym of the first valid value from ``at`` on, and the start of
        the earliest other reading of its characters, if any, that was not valid."""
        rejected: list[tuple[int, int]] = []
        while match := FORMATS.search(text, at):
            at = match.start()
            rejected = [span for span in rejected if span[1] > at]
            for kind in KINDS[KINDS.index(match.lastgroup) :]:
                if not (found := ONE_FORMAT[kind].match(text, at)):
                    continue
                several = kind in ("iban", "card", *NAMES) and not found[0].isalnum()
                for start, end in self.spans(kind, found):
                    new = getattr(self, kind)(text[start:end])
                    if new not in (None, text[start:end]):
                        others = [s for s, e in rejected if e > start] + [at] * several
                        return kind, start, end, new, min(others, default=None)
                rejected.append(found.span())
            at += 1
        return None

    def replace(self, text: str) -> tuple[str, list[str]]:
        """The text with pseudonyms and the kinds of the values replaced, in order."""
        kinds: list[str] = []
        if not HINT.search(text):
            return text, kinds
        out, at = [], 0
        while value := self.first(text, at):
            kind, start, end, new, other = value
            # A pseudonym must not make another reading valid, or the key would not undo it.
            while other is not None:
                begin = max(other - 1, 0)
                around = text[begin:start] + new + text[end : end + REACH]
                again = self.first(around, other - begin)
                if again and again[:3] == (kind, start - begin, end - begin):
                    break
                new = getattr(self, kind)(new)
            out += [text[at:start], new]
            kinds.append(NAMES.get(kind, kind))
            at = end
        return "".join([*out, text[at:]]), kinds


def real_date(year: int, month: int, day: int) -> dt.date | None:
    try:
        return dt.date(year, month, day)
    except ValueError:
        return None


def pseudonymise(
    docs: DataFrame,
    key: bytes,
    text: str = "text",
    keep: list[str] | None = None,
    backwards: bool = False,
) -> DataFrame:
    """One row per document: ``row`` (the input row, or its columns ``keep``), ``_text`` with
    pseudonyms and ``kinds``, the kinds of the values replaced, in order.

    Kinds: email (local part), iban, access (keys), secret (the value only), iso, slashed and dotted
    dates, address (IPv4), phone (country code, or trunk zero and the digit behind it, kept),
    social, card. Invalid values stay, and values without a character to permute. ``backwards``
    with the same key restores the input. A null text stays null, an empty one empty; rows are
    neither dropped nor merged; an empty table gives no rows.
    """
    rows = docs.select(
        F.struct(*(keep or ["*"])).alias("row"), docs[text].cast("string").alias("_text")
    )
    kinds = T.StructField("kinds", T.ArrayType(T.StringType()))
    schema = T.StructType([*rows.schema.fields, kinds])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key, backwards)
        for batch in chunks(batches, "_text"):
            done = [
                (None, []) if t is None else pseudonyms.replace(t)
                for t in batch.column("_text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([t for t, _ in done], pa.string()),
                    pa.array([k for _, k in done], pa.list_(pa.string())),
                ],
                schema.names,
            )

    return rows.mapInArrow(rewrite, schema)


def hide_personal_data(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The documents with pseudonyms in their texts, all other columns unchanged."""
    done = pseudonymise(docs, key, text)
    return done.select(F.col("row").withField(text, F.col("_text")).alias("row")).select("row.*")
