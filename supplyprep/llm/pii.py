"""Format-preserving pseudonyms for personal data.

Validated numbers and dates are permuted within their format by a keyed Feistel network: card
numbers that pass the Luhn check become card numbers that pass it, bank account numbers (IBAN) keep
their country and get check digits that fit, telephone numbers keep their country code, trunk digit
and punctuation, addresses of four octets stay such addresses, a calendar date becomes another one
written alike, and the name of a mail address keeps its pattern of letters and digits. A date with
slashes is month/day/year where that is a date, else day/month/year; days up to 12 stay so, so
that a pseudonym is read as its value was. Equal values become equal pseudonyms in every document, whatever their punctuation, and
the key turns them back. Numbers that fail their check are left alone.

One pass over the texts, no shuffle; the key travels with the task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructType

from supplyprep.llm.common import bounded_slices, map_arrow

KINDS = ("mail", "card", "phone", "address", "social", "date", "iban")

# The country calling codes of one and two digits; all others have three.
COUNTRY_CODES = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98"
).split()
ROUNDS = 8
_FIRST_DAY, _LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()

_MAIL = r"(?P<mail>[^\W_][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
_NUMBERS = (
    r"(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<address>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
    r"|(?P<date>(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w/-]|\.\d))"
    r"|(?P<social>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\w)"
    r"|(?<![\w+.-])[2-9]\d{2}(?P<gap>[-. ])\d{3}(?P=gap)\d{4}(?![\w-]|\.\d)|(?<![\w+.-])0\d{1,4}[ /-]\d{5,8}(?![\w-]|\.\d))"
    r"|(?P<card>(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d))"
)
_BOTH, _NUMBER = re.compile(f"{_MAIL}|{_NUMBERS}", re.ASCII), re.compile(_NUMBERS, re.ASCII)
_DIGITS = re.compile(r"\d", re.ASCII)


class Feistel:
    """A keyed permutation of 0 .. size - 1.

    A value is split over two factors a and b with a * b >= size; rounds add a keyed hash of one
    half to the other, and a result outside the range is permuted again until it lies inside.
    """

    def __init__(self, key: bytes, tweak: str, size: int) -> None:
        self.key, self.tweak, self.size = hashlib.blake2b(key, digest_size=32).digest(), tweak.encode(), size
        self.a = 1
        while self.a * self.a < size:
            self.a *= 2
        self.b = -(-size // self.a)

    def _mix(self, step: int, value: int, most: int) -> int:
        data = self.tweak + b"|" + self.size.to_bytes(16, "big") + bytes([step]) + value.to_bytes(16, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "big") % most

    def _once(self, value: int, back: bool) -> int:
        x, y = divmod(value, self.b)
        sign = -1 if back else 1
        for step in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            if step % 2:
                y = (y + sign * self._mix(step, x, self.b)) % self.b
            else:
                x = (x + sign * self._mix(step, y, self.a)) % self.a
        return x * self.b + y

    def permute(self, value: int, back: bool = False) -> int:
        if self.size < 2:
            return value
        value = self._once(value, back)
        while value >= self.size:
            value = self._once(value, back)
        return value


def _day(year: int, month: int, day: int) -> date | None:
    try:
        found = date(year, month, day)
    except ValueError:
        return None
    return found if _FIRST_DAY <= found.toordinal() <= _LAST_DAY else None


# --- formats -------------------------------------------------------------------------------


def luhn_digit(digits: str) -> str:
    """The check digit that completes ``digits``."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


def _iban_rest(plain: str) -> int:
    """What an account number leaves modulo 97; 1 if its check digits fit."""
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in shape)


class Pseudonyms:
    """Pseudonyms of one key; ``back`` turns them into the values again."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.key, self.back = key, back
        self.feistel: Callable[[str, int], Feistel] = lru_cache(maxsize=256)(lambda tweak, size: Feistel(key, tweak, size))

    def _digits(self, tweak: str, digits: str) -> str:
        return str(self.feistel(tweak, 10 ** len(digits)).permute(int(digits), self.back)).zfill(len(digits))

    def card(self, found: str) -> str | None:
        digits = re.sub(r"\D", "", found)
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = self._digits("card", digits[:-1])
        while len(set(body + luhn_digit(body))) == 1:  # a row of one digit is no card number
            body = self._digits("card", body)
        return _refill(found, body + luhn_digit(body))

    def phone(self, found: str) -> str | None:
        head = ""
        if found[0] == "+":
            digits = re.sub(r"\D", "", found)
            size = next((n for n in (1, 2) if digits[:n] in COUNTRY_CODES), 3)
            end = [m.end() for m in _DIGITS.finditer(found)][size - 1]
            head = found[:end]
        rest = found[len(head) :]
        digits = re.sub(r"\D", "", rest)
        if not 6 <= len(digits) <= 14:
            return None
        return head + _refill(rest, self._subscriber(digits))

    def _subscriber(self, digits: str) -> str:
        """Another number of as many digits; a first digit 0 or 1 stays, any other becomes one of 2 to 9."""
        if digits[0] in "01":
            return digits[0] + self._digits("phone", digits[1:])
        low = 2 * 10 ** (len(digits) - 1)
        return str(low + self.feistel("phone", 4 * low).permute(int(digits) - low, self.back))

    def iban(self, found: str) -> str | None:
        plain = found.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _iban_rest(plain) != 1:
            return None
        country, account, new = plain[:2], plain[4:], ""
        for at in range(0, len(account), 15):  # parts whose numbers a permutation takes
            part = account[at : at + 15]
            kinds = [(c, "A", 26) if c.isalpha() else (c, "0", 10) for c in part]
            size, value = 1, 0
            for c, zero, base in kinds:
                size, value = size * base, value * base + ord(c) - ord(zero)
            shape = "".join("A" if c.isalpha() else "9" for c in part)
            value = self.feistel(f"iban|{country}|{at}|{shape}", size).permute(value, self.back)
            chosen = []
            for _, zero, base in reversed(kinds):
                value, digit = divmod(value, base)
                chosen.append(chr(ord(zero) + digit))
            new += "".join(reversed(chosen))
        new = f"{country}{98 - _iban_rest(f'{country}00{new}'):02d}{new}"
        letters = iter(new)
        return "".join(c if c == " " else next(letters) for c in found)

    def address(self, found: str) -> str | None:
        parts = found.split(".")
        if any(int(p) > 255 or (p[0] == "0" and p != "0") for p in parts):
            return None
        value = int.from_bytes(bytes(map(int, parts)), "big")
        return ".".join(map(str, self.feistel("address", 1 << 32).permute(value, self.back).to_bytes(4, "big")))

    def social(self, found: str) -> str | None:
        area, group, serial = map(int, found.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = area - 1 - (area > 666)
        value = self.feistel("social", 898 * 99 * 9999).permute((areas * 99 + group - 1) * 9999 + serial - 1, self.back)
        rest, serial = divmod(value, 9999)
        area, group = divmod(rest, 99)
        area += 1
        return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"

    def date(self, found: str) -> str | None:
        a, b, c = (int(n) for n in re.split(r"\D", found))
        if found[4] == "-":
            day, form = _day(a, b, c), "%Y-%m-%d"
        elif found[2] == ".":
            day, form = _day(c, b, a), "%d.%m.%Y"
        else:
            day, form = _day(c, a, b), "%m/%d/%Y"
            if day is None:
                day, form = _day(c, b, a), "%d/%m/%Y"
        if day is None:
            return None
        network, new = self.feistel("date", _LAST_DAY - _FIRST_DAY + 1), day
        while new is day or (new.day > 12) != (day.day > 12):
            new = date.fromordinal(_FIRST_DAY + network.permute(new.toordinal() - _FIRST_DAY, self.back))
        return new.strftime(form)

    def mail(self, found: str) -> str | None:
        name, host = found.split("@", 1)
        kinds = [(c, "a", 26) if "a" <= c <= "z" else (c, "A", 26) if "A" <= c <= "Z" else (c, "0", 10) for c in name if c.isascii() and c.isalnum()]
        size, value = 1, 0
        for c, zero, base in kinds:
            size, value = size * base, value * base + ord(c) - ord(zero)
        if size >= 1 << 120:  # longer names are permuted by parts of 20 characters
            cut = [name[i : i + 20] for i in range(0, len(name), 20)]
            return "".join((self.mail(f"{part}@{i}.{host}") or "").split("@")[0] for i, part in enumerate(cut)) + "@" + host
        shape = "".join("9" if c.isdigit() else "a" if c.islower() else "A" for c, _, _ in kinds)
        value = self.feistel(f"mail|{shape}|{host.lower()}", size).permute(value, self.back)
        new = []
        for _, zero, base in reversed(kinds):
            value, digit = divmod(value, base)
            new.append(chr(ord(zero) + digit))
        fill = reversed(new)
        return "".join(next(fill) if c.isascii() and c.isalnum() else c for c in name) + "@" + host

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and how many of each kind."""
        counts = dict.fromkeys(KINDS, 0)

        def one(match: re.Match) -> str:
            kind = next(k for k in KINDS if match.groupdict().get(k) is not None)
            new = getattr(self, kind)(match[0])
            if new is None:
                return match[0]
            counts[kind] += 1
            return new

        if "@" in text:
            return _BOTH.sub(one, text), counts
        return (_NUMBER.sub(one, text) if _DIGITS.search(text) else text), counts


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """All columns of ``docs`` with pseudonyms in ``text``, plus n_<kind> counts.

    ``back`` turns pseudonyms made with the same key into the values again. Null texts stay null
    and count nothing; every row stays. Columns of ``docs`` named n_<kind> are replaced.
    """
    added = [f"n_{k}" for k in KINDS]
    source = docs.drop(*added)
    names, place = [*source.columns, *added], source.columns.index(text)
    schema = StructType(source.schema.fields[:])
    for name in added:
        schema = schema.add(name, LongType(), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Pseudonyms(key, back)
        for batch in bounded_slices(batches, text):
            done = [(None, {}) if t is None else maker.replace(t) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array([t for t, _ in done], batch.column(place).type)
            counts = [pa.array([c.get(k, 0) for _, c in done], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays([*columns, *counts], names=names)

    return map_arrow(source, run, schema)
