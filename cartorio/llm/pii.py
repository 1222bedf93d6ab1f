"""Pseudonyms for personal data that keep its format (operator 3).

Values are found by pattern and validated (check digits, ranges, real dates). A validated value is taken
apart into digits over the alphabets of its places, and a keyed Feistel network permutes all values of
that format; where only some of them are valid it walks on until it meets a valid one. So a pseudonym
has the format of the value, passes the same validation, and equal values stay equal in all documents,
also when they are written with other separators, while nothing can be undone without the key.

Defined results: a null text stays null, without findings; an empty text stays empty; repeated rows get
the same pseudonyms; values that fail validation stay as they are; whole texts are searched, whatever
their length; an empty table gives an empty table. All columns of the table are kept; one named like a
result is replaced by it.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cache
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.llm.ragged import bytes_of, groups

ROUNDS = 10
SECRET_PART = 256
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
HEX = DIGITS + "abcdef"
#: Signs that may stand in a secret; not those that end or quote one.
SIGNS = "!#$%()*+-./:<=>?@[]^_`{|}~"
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)


def feistel(values: Sequence[int], radices: Sequence[int], tweak: str, key: bytes) -> list[int]:
    """Permutes the numbers written with one digit for each radix; another tweak, another permutation."""
    cut = (len(values) + 1) // 2
    sizes = prod(radices[:cut]), prod(radices[cut:])
    halves = [_number(values[:cut], radices[:cut]), _number(values[cut:], radices[cut:])]
    for turn in range(ROUNDS):
        side = turn % 2
        size = sizes[side]
        width = size.bit_length() // 8 + 9  # so much longer than the size that no remainder is favoured
        message = f"{tweak}|{turn}|{len(values)}|{halves[1 - side]}".encode()
        mask = hashlib.shake_256(len(key).to_bytes(4, "big") + key + message).digest(width)
        halves[side] = (halves[side] + int.from_bytes(mask, "big")) % size
    return [*_digits(halves[0], radices[:cut]), *_digits(halves[1], radices[cut:])]


def _number(values: Sequence[int], radices: Sequence[int]) -> int:
    number = 0
    for value, radix in zip(values, radices):
        number = number * radix + value
    return number


def _digits(number: int, radices: Sequence[int]) -> list[int]:
    out = []
    for radix in reversed(radices):
        number, digit = divmod(number, radix)
        out.append(digit)
    return out[::-1]


def permuted_text(text: str, alphabets: Sequence[str], tweak: str, key: bytes) -> str:
    """Permutes the texts that have a letter of each alphabet at its place."""
    values = [alphabet.index(letter) for letter, alphabet in zip(text, alphabets)]
    new = feistel(values, [len(alphabet) for alphabet in alphabets], tweak, key)
    return "".join(alphabet[value] for value, alphabet in zip(new, alphabets))


def permuted_below(value: int, size: int, tweak: str, key: bytes) -> int:
    """Permutes 0 .. size-1: walks on through a slightly larger domain until it is back inside."""
    side = int(size**0.5) + 1
    while True:
        value = _number(feistel(_digits(value, [side, side]), [side, side], tweak, key), [side, side])
        if value < size:
            return value


def by_class(text: str, tweak: str, key: bytes, ignore_case: bool = False) -> str:
    """Permutes letters among letters and digits among digits; everything else stays."""
    places = [i for i, c in enumerate(text) if c.isascii() and c.isalnum()]
    low = "".join(text[i].lower() if ignore_case else text[i] for i in places)
    kinds = [DIGITS if c in DIGITS else LETTERS if c in LETTERS else LETTERS.upper() for c in low]
    form = "".join(kind[0] for kind in kinds)
    new = list(text)
    for place, letter in zip(places, permuted_text(low, kinds, f"{tweak}{form}", key)):
        new[place] = letter.upper() if text[place].isupper() else letter
    return "".join(new)


@cache
def alphabet_of(letter: str) -> str:
    """The characters that one of a secret is permuted among: its own kind. White space, quotes and what
    separates values are a kind each and stay."""
    for kind in (DIGITS, LETTERS, LETTERS.upper(), SIGNS):
        if letter in kind:
            return kind
    first = ord(letter) & ~0xFF
    near = [chr(c) for c in range(first, first + 256) if not 0xD800 <= c < 0xE000]
    kinds = ("islower", "isupper") if letter.islower() or letter.isupper() else ("isalpha", "isalpha")
    own = next((kind for kind in kinds if getattr(letter, kind)()), None)
    # Letters of one case of a block of 256 codepoints; of scripts without case, all its letters.
    return "".join(c for c in near if getattr(c, own)() and (own != "isalpha" or not c.isupper() and not c.islower())) if own else letter


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    doubled = sum(sum(divmod(2 * int(c), 10)) for c in digits[::-2])
    return str(-(doubled + sum(map(int, digits[-2::-2]))) % 10)


def _fill(form: str, digits: str) -> str:
    """``digits`` in the places of the digits of ``form``."""
    rest = iter(digits)
    return "".join(next(rest) if c in DIGITS else c for c in form)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def _card(text: str, key: bytes) -> str | None:
    digits = _only_digits(text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    # The first digit tells the kind of card and stays.
    body = digits[0] + permuted_text(digits[1:-1], [DIGITS] * (len(digits) - 2), f"card{digits[0]}", key)
    return _fill(text, body + luhn_digit(body))


def _iban_check(country: str, account: str) -> str:
    spelled = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(spelled) % 97:02d}"


def _iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    country, account = plain[:2], plain[4:]
    if not 11 <= len(account) <= 30 or _iban_check(country, account) != plain[2:4]:
        return None
    account = by_class(account, "iban" + country, key)
    rest = iter(country + _iban_check(country, account) + account)
    return "".join(c if c == " " else next(rest) for c in text)


#: How long an IBAN of a country is.
IBAN_LENGTHS = dict(
    item.split(":") for item in (
        "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BI:27 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 "
        "DJ:27 DK:18 DO:28 EE:20 EG:29 ES:24 FI:18 FK:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HN:28 "
        "HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 "
        "MC:27 MD:24 ME:22 MK:19 MN:20 MR:27 MT:31 MU:30 NI:28 NL:18 NO:15 OM:23 PK:24 PL:28 PS:29 PT:25 QA:29 "
        "RO:24 RS:22 RU:33 SA:24 SC:31 SD:18 SE:24 SI:19 SK:24 SM:27 SO:23 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 "
        "VA:22 VG:24 XK:20 YE:30"
    ).split()
)


def _iban_ends(text: str) -> Iterator[int]:
    """Words after an IBAN look like groups of it: the whole, then what ends at a space, the longest first.

    A shorter part of a known country has that country's length.
    """
    yield len(text)
    for end in range(len(text) - 1, 0, -1):
        if text[end] == " " and IBAN_LENGTHS.get(text[:2], n := str(end - text.count(" ", 0, end))) == n:
            yield end


def _ipv4(text: str, key: bytes) -> str | None:
    parts = text.split(".")
    if any(int(part) > 255 or (len(part) > 1 and part[0] == "0") for part in parts):
        return None
    return ".".join(map(str, feistel([int(part) for part in parts], [256] * 4, "ipv4", key)))


def _ssn(text: str, key: bytes) -> str | None:
    area, group, serial = (int(text[a:b]) for a, b in ((0, 3), (4, 6), (7, 11)))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    place = (area - 1 - (area > 666)) * 99 * 9999 + (group - 1) * 9999 + serial - 1
    place, serial = divmod(permuted_below(place, 898 * 99 * 9999, "ssn", key), 9999)
    area, group = divmod(place, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}{text[3]}{group + 1:02d}{text[6]}{serial + 1:04d}"


def _phone(text: str, key: bytes) -> str | None:
    """The country code stays; a North American number begins its parts with 2 to 9."""
    head = re.match(r"\+\d{1,3}(?!\d)", text)
    code = head[0] if head else ""
    digits = _only_digits(text[len(code) :])
    if not 7 <= len(digits) <= 14:
        return None
    # Written without a country code or without separators it is the same number.
    national = len(digits) == 10 and code in ("", "+1") and digits[0] in "23456789" and digits[3] in "23456789"
    alphabets = [DIGITS[2:] if national and i in (0, 3) else DIGITS for i in range(len(digits))]
    return code + _fill(text[len(code) :], permuted_text(digits, alphabets, f"phone{national}", key))


def _date(text: str, key: bytes) -> str | None:
    parts = re.split(r"([-/.])", text)
    numbers = [int(part) for part in parts[::2]]
    for order in ((0, 1, 2), (2, 1, 0), (2, 0, 1)):  # year, month and day stand in these places
        try:
            day = date(*(numbers[place] for place in order))
        except ValueError:
            continue
        if len(parts[2 * order[0]]) != 4 or not FIRST_DAY <= day <= LAST_DAY:
            continue
        days = (LAST_DAY - FIRST_DAY).days + 1
        new = FIRST_DAY + timedelta(permuted_below((day - FIRST_DAY).days, days, "date", key))
        for place, value in zip(order, (new.year, new.month, new.day)):
            parts[2 * place] = str(value).rjust(len(parts[2 * place]), "0")
        return "".join(parts)
    return None


def _email(text: str, key: bytes) -> str | None:
    """The last label of the host stays."""
    head, dot, tail = text.rpartition(".")
    return _in_parts(head, lambda part, tweak: by_class(part, f"email{tweak}", key, ignore_case=True), str.lower) + dot + tail


def _in_parts(text: str, renew: Callable[[str, str], str], plain: Callable[[str], str] = str) -> str:
    """Long values are permuted in parts, each under what stands before it, so the time is linear."""
    parts, before, tweak = [], hashlib.sha256(), ""
    for at in range(0, len(text), SECRET_PART):
        part = text[at : at + SECRET_PART]
        parts.append(renew(part, tweak))
        before.update(plain(part).encode())
        tweak = f" after {before.hexdigest()} "
    return "".join(parts)


def _secret(text: str, key: bytes) -> str | None:
    """A value without anything to permute has no pseudonym."""
    if all(c in HEX for c in text):
        return _in_parts(text, lambda part, tweak: permuted_text(part, [HEX] * len(part), f"hex{tweak}", key))

    def renew(part: str, tweak: str) -> str:
        kinds = [alphabet_of(c) for c in part]
        form = "".join(kind[0] for kind in kinds)
        return permuted_text(part, kinds, f"secret{tweak}{form}", key)

    return _in_parts(text, renew) if any(len(alphabet_of(c)) > 1 for c in text) else None


#: A word, or several joined: what follows "the secret:" in a sentence.
_WORDS = re.compile(r"(?:[^\W\d_][^\W\d_A-Z]*|[A-Z]+)(?:[-'’/](?:[^\W\d_][^\W\d_A-Z]*|[A-Z]+))*[.!?)]*")


def _plain_secret(text: str, key: bytes) -> str | None:
    """After a colon and without quotes words stay: they are prose."""
    return None if _WORDS.fullmatch(text) else _secret(text, key)


def _ipv6(text: str, key: bytes) -> str | None:
    """Any spelling of an address has the same pseudonym, in the shortest spelling."""
    if sum(map(bool, text.split(":"))) < 2 or not any(c in DIGITS for c in text):
        return None
    try:
        number = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    words = feistel([number >> 16 * place & 0xFFFF for place in range(8)], [1 << 16] * 8, "ipv6", key)
    new = str(ipaddress.IPv6Address(sum(word << 16 * place for place, word in enumerate(words))))
    return new.upper() if text.upper() == text else new


def _key_id(text: str, key: bytes) -> str | None:
    return text[:4] + permuted_text(text[4:], [LETTERS.upper() + DIGITS] * (len(text) - 4), "key id", key)


@dataclass(frozen=True)
class Kind:
    """``pattern``: its group named value, or else the whole match, is the value.

    ``ends``: where the value may end in that, if it isn't at the end only; the search then goes on after
    the value, or after the first character of what holds none.
    """

    name: str
    pattern: re.Pattern[str]
    renew: Callable[[str, bytes], str | None]
    ends: Callable[[str], Iterator[int]] | None = None

    def values(self, text: str, key: bytes) -> Iterator[tuple[int, int, str]]:
        """Begin, end and pseudonym of every valid value."""
        if self.ends is None:
            group = "value" if "value" in self.pattern.groupindex else 0
            for match in self.pattern.finditer(text):
                begin, end = match.span(group)
                if begin >= 0 and (new := self.renew(text[begin:end], key)) is not None:
                    yield begin, end, new
            return
        at = 0
        while match := self.pattern.search(text, at):
            begin, whole = match.start(), match[0]
            at = begin + 1
            for end in self.ends(whole):
                if (new := self.renew(whole[:end], key)) is not None:
                    yield begin, begin + end, new
                    at = begin + end
                    break


def _kind(
    name: str, pattern: str, renew: Callable[[str, bytes], str | None],
    ends: Callable[[str], Iterator[int]] | None = None,
) -> Kind:
    return Kind(name, re.compile(pattern, re.ASCII), renew, ends)


_NAMED = r"(?i:\b(?:password|passwd|pwd|secret|token|api[_ -]?key)\b)[\"']?\s{0,3}"
#: Anything but white space, quotes and separators; full stops and closing brackets only inside.
_RUN = r"(?:[^\s\"',;&.)\]}]++|[.)\]}]++(?=[^\s\"',;&.)\]}]))++"

#: In order: a place that one kind has taken is not looked at by those after it. Up to six characters of
#: layout (separators, table bars, junk) may stand between the parts of a phone number.
KINDS = (
    _kind("email", r"(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*+@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}\b", _email),
    _kind("key id", r"\b(?:AKIA|ASIA)(?=[A-Z]*\d)[A-Z0-9]{16}\b", _key_id),
    # Between quotes a secret is what stands there; else it ends at white space or at what separates values.
    _kind("secret", _NAMED + r"[=:]\s{0,3}(?P<quote>[\"'])(?P<value>(?:(?!(?P=quote))[^\n])++)(?P=quote)", _secret),
    _kind("secret", _NAMED + rf"=\s{{0,3}}[\"']?(?P<value>{_RUN})", _secret),
    _kind("secret", _NAMED + rf":\s{{0,3}}[\"']?(?P<value>{_RUN})", _plain_secret),
    _kind("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban, _iban_ends),
    _kind("date", r"(?<![\w./-])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d?/\d\d?/\d{4}|\d\d?\.\d\d?\.\d{4})(?!(?![Tt]\d)[\w/-]|\.\d)", _date),
    # Four numbers after "version" are none.
    _kind("ipv4", r"\b(?i:v|ver|version|release)[ .:]{1,2}\d+(?:\.\d+)+|(?<![\w.])(?P<value>\d{1,3}(?:\.\d{1,3}){3})(?!\w|\.\d)", _ipv4),
    _kind("ipv6", r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\w)", _ipv6),
    _kind("ssn", r"(?<![\w-])\d{3}[- ]\d{2}[- ]\d{4}(?![\w-])", _ssn),
    _kind("card", r"(?<!\w)(?<!\d\.)\d{13,19}(?!\w)", _card),
    _kind("card", r"(?<![\w-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![\w-])", _card),
    _kind(
        "phone",
        r"(?<![\w+])(?:\+\d{1,3}[^\w\n+(]{0,6})?(?:\(\d{3}\)|\d{3})[^\w\n+(]{1,6}\d{3}[^\w\n+(]{0,6}-[^\w\n+(]{0,6}\d{4}(?!\w)"
        r"|(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .])\d{3}[ .]\d{4}(?!\w)"
        r"|(?<![\w+])\+\d{8,15}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!\w)",
        _phone,
    ),
)


def pseudonymised(text: str, key: bytes, kinds: Sequence[Kind] = KINDS) -> tuple[str, list[tuple[str, int, int]]]:
    """The new text, and kind, begin and end (in code points of the new text) of every pseudonym."""
    found: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))
    for kind in kinds:
        for begin, end, new in kind.values(text, key):
            if not any(taken[begin:end]):
                taken[begin:end] = b"\1" * (end - begin)
                found.append((begin, end, kind.name, new))
    if not found:
        return text, []
    parts, spans, at, length = [], [], 0, 0
    for begin, end, name, new in sorted(found):
        parts += [text[at:begin], new]
        length += begin - at
        spans.append((name, length, length + len(new)))
        length, at = length + len(new), end
    return "".join([*parts, text[at:]]), spans


def _worth_searching(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold a digit, ``@``, ``=`` or ``:``; every value has one of them."""
    marks = ((data >= 0x30) & (data <= 0x3A)) | (data == ord("@")) | (data == ord("="))
    owner = np.searchsorted(offsets, np.flatnonzero(marks), side="right") - 1
    out = np.zeros(len(offsets) - 1, bool)
    out[owner] = True
    return out


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("begin", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
]))


def with_pseudonyms(
    docs: DataFrame, key: bytes, text: str = "text", spans: str | None = "pseudonyms"
) -> DataFrame:
    """The table with new texts and, unless ``spans`` is None, an array of the pseudonyms in them."""
    others = [name for name in docs.columns if name not in (text, spans)]
    whole = F.struct(F.lit(0).alias("__none"), *(F.col(f"`{name}`") for name in others)).alias("__row")
    rows = docs.select(whole, F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([
        *rows.schema, T.StructField("__spans", SPANS),
    ])
    arrow_spans = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "__text"):
            column = group.column("__text")
            found: dict[int, tuple[str, list[tuple[str, int, int]]]] = {}
            for place in np.flatnonzero(_worth_searching(*bytes_of(column))).tolist():
                new, marks = pseudonymised(column[place].as_py(), key)
                if marks:
                    found[place] = new, marks
            if found:
                mask = np.zeros(group.num_rows, bool)
                mask[list(found)] = True
                news = pa.array([new for new, _ in found.values()], column.type)
                column = pa.compute.replace_with_mask(column, pa.array(mask), news)
            marks = [
                [dict(zip(("kind", "begin", "end"), mark)) for mark in found[i][1]] if i in found else []
                for i in range(group.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [group.column("__row"), column, pa.array(marks, arrow_spans)],
                names=["__row", "__text", "__spans"],
            )

    made = rows.mapInArrow(task, schema)
    columns = [
        F.col("__text").alias(name) if name == text else F.col(f"__row.`{name}`").alias(name)
        for name in docs.columns if name != spans
    ]
    return made.select(*columns, *([F.col("__spans").alias(spans)] if spans else []))
