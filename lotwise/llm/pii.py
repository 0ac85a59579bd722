"""Personal data replaced by format-preserving pseudonyms.

A found value is validated (check digits, ranges, calendar), turned into a number of its own
format, and permuted by a keyed Feistel network over exactly the numbers of that format. So a
pseudonym is a valid value of the same shape, equal values get equal pseudonyms in
every document and on every executor, and who holds the key can go back. Separators, set-off
country codes and top-level domains stay. Check digits are computed anew.

Kinds: email, card (Luhn), iban (mod 97), ssn, ip (four bytes), date (year-first, and day or
month first, between 1800 and 2199), phone. Numbers that fail their check are not touched.
North American phones whose area or exchange starts with 0 or 1 are phones too: they are permuted
among themselves.

Where a match fails its check, its shorter ends are tried, then the other kinds at that place; if
none is valid, the search goes on at the next group of characters.

Null and empty texts stay as they are; texts without finds come back unchanged. Every row is
treated by itself, so ties and repeated rows give equal results. All columns stay.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from lotwise.llm.common import map_arrow

ROUNDS = 10
KINDS = ("email", "card", "iban", "ssn", "ip", "date", "phone")
REMEMBERED = 100_000

EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++)@((?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,})(?![A-Za-z0-9-])")
# Kinds in the order in which they are tried at a place. NUMBER finds the places.
AFTER_OTHER, AFTER_PLUS = r"(?<![A-Za-z0-9])", r"(?<![A-Za-z0-9+])"
IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
YMD = r"[0-9]{4}(?P<s1>[-/.])[0-9]{1,2}(?P=s1)[0-9]{1,2}(?![0-9])"
DMY = r"[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)[0-9]{4}(?![0-9])"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
PHONE = (
    r"(?:(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"
    r"|\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}(?![0-9]))"
)
NUMBER = re.compile(f"{AFTER_OTHER}(?:{IBAN}|{IP}|{YMD}|{DMY}|{SSN}|{CARD})|{AFTER_PLUS}{PHONE}")
# A run of groups of fewer than four digits, or with different separators, is a card only if it is
# no phone. Kinds with True may have taken in what follows: their shorter ends are tried too.
PLAIN_CARD = re.compile(r"[0-9]{13,19}|[0-9]{4,}(?:(?P<s>[ -])[0-9]{4,})(?:(?P=s)[0-9]{4,})*(?:(?P=s)[0-9]+)?")
TRIED = [
    ("iban", re.compile(AFTER_OTHER + IBAN), True),
    ("ip", re.compile(AFTER_OTHER + IP), False),
    ("ymd", re.compile(AFTER_OTHER + YMD), False),
    ("dmy", re.compile(AFTER_OTHER + DMY), False),
    ("ssn", re.compile(AFTER_OTHER + SSN), False),
    ("plain_card", re.compile(AFTER_OTHER + CARD), True),
    ("phone", re.compile(AFTER_PLUS + PHONE), True),
    ("card", re.compile(AFTER_OTHER + CARD), True),
]
KIND_OF = {"ymd": "date", "dmy": "date", "plain_card": "card"}
# Digits after the country code where a country's numbers all have as many. A phone that has a
# group end there ends there; any other takes all groups that fit.
NATIONAL_DIGITS = {
    "1": 10, "7": 10, "27": 9, "30": 10, "31": 9, "33": 9, "34": 9, "41": 9, "44": 10, "45": 8, "47": 8, "48": 9,
    "52": 10, "57": 10, "61": 9, "65": 8, "90": 10, "91": 10, "351": 9, "380": 9, "420": 9, "421": 9,
}
FIRST_DAY, DAYS = date(1800, 1, 1), (date(2200, 1, 1) - date(1800, 1, 1)).days


class Permuter:
    """A keyed permutation of 0 .. size-1 for any size and name of the format."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: bytes, number: int, value: int) -> int:
        data = b"%s|%d|%x" % (tweak, number, value)
        return int.from_bytes(blake2b(data, key=self.key, digest_size=32).digest(), "big")

    def __call__(self, value: int, size: int, tweak: str, back: bool = False) -> int:
        """Feistel over a rectangle of at least ``size`` cells; outside cells are walked past."""
        if size < 2:
            return value
        low = max(2, int(size**0.5))
        while low * low < size:
            low += 1
        high, name = -(-size // low), f"{tweak}:{size}".encode()
        while True:
            left, right = divmod(value, low)
            for number in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
                sign = -1 if back else 1
                if number % 2:
                    right = (right + sign * self._round(name, number, left)) % low
                else:
                    left = (left + sign * self._round(name, number, right)) % high
            value = left * low + right
            if value < size:
                return value


def permuted(text: str, tweak: str, permute: Permuter, back: bool = False, first: dict[int, str] | None = None) -> str:
    """The text with its digits and ASCII letters permuted together, each within its class.

    ``first`` gives the allowed characters at some places.
    """
    classes, value = [], 0
    for i, c in enumerate(text):
        own = (first or {}).get(i) or (
            "0123456789" if c in "0123456789" else "abcdefghijklmnopqrstuvwxyz" if "a" <= c <= "z"
            else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if "A" <= c <= "Z" else ""
        )
        classes.append(own)
        if own:
            value = value * len(own) + own.index(c)
    size = 1
    for own in classes:
        size *= len(own) or 1
    value, out = permute(value, size, f"{tweak}:{''.join(str(len(o)) + '.' for o in classes)}", back), []
    for c, own in zip(reversed(text), reversed(classes)):
        if own:
            value, at = divmod(value, len(own))
            c = own[at]
        out.append(c)
    return "".join(reversed(out))


def refilled(shape: str, digits: str, wanted: Callable[[str], bool] = str.isdigit) -> str:
    """The characters of ``digits`` in the places of ``shape`` that hold such."""
    source = iter(digits)
    return "".join(next(source) if wanted(c) else c for c in shape)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_digits(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


def assignable(national: str) -> bool:
    """Whether area and exchange of ten digits have first digits that North America assigns."""
    return national[0] >= "2" and national[3] >= "2"


def complete(phone: str) -> bool:
    """Whether a phone with a country code has just the digits that its country's numbers have."""
    digits = re.sub("[^0-9]", "", phone.replace("(0)", ""))
    return phone.startswith("+") and any(NATIONAL_DIGITS.get(digits[:n]) == len(digits) - n for n in (1, 2, 3))


class Pseudonyms:
    """Replaces the values of a text; remembers values it has met."""

    def __init__(self, key: bytes):
        self.permute = Permuter(key)
        self.known: dict[tuple[str, str], str | None] = {}

    def _one(self, kind: str, value: str) -> str | None:
        if (kind, value) not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[kind, value] = getattr(self, f"_{kind}")(value)
        return self.known[kind, value]

    def _email(self, value: str) -> str:
        local, _, domain = value.rpartition("@")
        labels, _, top = domain.rpartition(".")
        return f"{permuted(local, 'local', self.permute)}@{permuted(labels, 'domain', self.permute)}.{top}"

    def _card(self, value: str) -> str | None:
        digits = re.sub("[ -]", "", value)
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = permuted(digits[:-1], "card", self.permute)
        return refilled(value, body + luhn_digit(body))

    def _iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        country, check, body = plain[:2], plain[2:4], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_digits(country, body) != check:
            return None
        other = permuted(body, f"iban{country}", self.permute)
        return refilled(value, country + iban_digits(country, other) + other, str.isalnum)

    def _ssn(self, value: str) -> str | None:
        area, group, serial = map(int, value.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = [a for a in range(1, 900) if a != 666]
        number = self.permute((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, "ssn")
        number, serial = divmod(number, 9999)
        area, group = divmod(number, 99)
        return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"

    def _ip(self, value: str) -> str | None:
        parts = [int(p) for p in value.split(".")]
        if max(parts) > 255:
            return None
        number = self.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
        return ".".join(map(str, number.to_bytes(4, "big")))

    def _date(self, value: str, order: str) -> str | None:
        mark = re.search("[-/.]", value)[0]
        parts = value.split(mark)
        try:
            day = date(*(int(parts[order.index(p)]) for p in "ymd"))
        except ValueError:
            return None
        if not 0 <= (day - FIRST_DAY).days < DAYS:
            return None
        other = FIRST_DAY + timedelta(self.permute((day - FIRST_DAY).days, DAYS, "date"))
        new = {"y": f"{other.year:04d}", "m": f"{other.month:02d}", "d": f"{other.day:02d}"}
        return mark.join(new[p] for p in order)

    def _ymd(self, value: str) -> str | None:
        return self._date(value, "ymd")

    def _dmy(self, value: str) -> str | None:
        return self._date(value, "dmy") or self._date(value, "mdy")

    def _phone(self, value: str) -> str | None:
        digits = re.sub("[^0-9]", "", value)
        if not 8 <= len(digits) <= 15:
            return None
        national = value.startswith("+1") or not value.startswith("+")
        keep = len(digits) - 10 if national else len(re.match(r"\+([0-9]{1,3}?)(?=[ .(-])|\+([0-9])", value)[0]) - 1
        if keep < 0 or (national and keep > 1):
            return None
        other, limits = digits[keep:], {0: "23456789", 3: "23456789"}
        if not national:
            other = permuted(other, "phone", self.permute)
        elif assignable(other):
            other = permuted(other, "phone", self.permute, first=limits)
        else:
            # Walks past assignable numbers, which have pseudonyms of their own.
            other = permuted(other, "unassigned", self.permute)
            while assignable(other):
                other = permuted(other, "unassigned", self.permute)
        return refilled(value, digits[:keep] + other)

    def _plain_card(self, value: str) -> str | None:
        return self._one("card", value) if PLAIN_CARD.fullmatch(value) else None

    def _at(self, text: str, begin: int, limit: int) -> tuple[int, str, str] | None:
        """End, new value and kind of the first kind that has a valid value at ``begin``."""
        for kind, pattern, open_end in TRIED:
            match = pattern.match(text, begin, limit)
            if not match:
                continue
            ends = [match.end()]
            if open_end:
                ends += [e for e in range(match.end() - 1, begin, -1) if text[e] in " .-(" and (text[e - 1].isalnum() or text[e - 1] == ")")]
            if kind == "phone" and len(ends) > 1:
                ends.sort(key=lambda e: not complete(text[begin:e]))
            for end in ends:
                # What the pattern wants behind a value holds at the end of a group.
                if end < match.end() and not pattern.fullmatch(text, begin, end):
                    continue
                if (new := self._one(kind, text[begin:end])) is not None:
                    return end, new, KIND_OF.get(kind, kind)
        return None

    def _numbers(self, text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, str, str]]:
        """Begin, end, new value and kind of all numbers outside the ``taken`` spans, from left to right.

        Where no kind has a valid value, the search goes on at the next place that may begin one.
        """
        begins, ends = [t[0] for t in taken], [t[1] for t in taken]
        at = 0
        while match := NUMBER.search(text, at):
            begin = match.start()
            # The next span that ends behind this place, if any.
            span = bisect_right(ends, begin)
            if span < len(taken) and begins[span] <= begin:
                at = ends[span]
                continue
            limit = begins[span] if span < len(taken) else len(text)
            found = self._at(text, begin, limit)
            if found:
                yield begin, *found
            at = found[0] if found else begin + 1

    def apply(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The new text and what was replaced: begin, end (in the new text) and kind."""
        spans: list[tuple[int, int, str]] = []
        for pattern in (EMAIL, NUMBER):
            if pattern is EMAIL:
                found = [(m.start(), m.end(), self._one("email", m[0]), "email") for m in EMAIL.finditer(text)] if "@" in text else []
            else:
                found = list(self._numbers(text, spans))
            if not found:
                continue
            out, last, size, moved = [], 0, 0, []
            for begin, end, new, kind in found:
                out += [text[last:begin], new]
                size += begin - last + len(new)
                moved.append((size - len(new), begin, end, len(new), kind))
                last = end
            # How far everything behind each replaced place has moved.
            behind, by = [e for _, _, e, _, _ in moved], [0, *accumulate(n - (e - s) for _, s, e, n, _ in moved)]
            shifted = [(a + by[k], b + by[k], kind) for a, b, kind in spans for k in (bisect_right(behind, a),)]
            text = "".join(out) + text[last:]
            spans = shifted + [(a, a + n, kind) for a, _, _, n, kind in moved]
        return text, sorted(spans)


SPANS = ArrayType(StructType([StructField("begin", LongType()), StructField("end", LongType()), StructField("kind", StringType())]))
SPAN_TYPE = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def pseudonymise(docs: DataFrame, key: bytes, with_spans: bool = True) -> DataFrame:
    """``docs`` with new texts and, if asked for, ``pii_spans`` of what was replaced.

    A column of that name in ``docs`` is replaced.
    """
    docs = docs.drop("pii_spans") if with_spans else docs
    where = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, *([StructField("pii_spans", SPANS)] if with_spans else [])])

    def run(batches):
        own = Pseudonyms(key)
        for batch in batches:
            texts, spans = [], []
            for text in batch.column(where).to_pylist():
                new, found = own.apply(text) if text else (text, [])
                texts.append(new)
                spans.append([{"begin": a, "end": b, "kind": kind} for a, b, kind in found])
            columns = batch.columns
            columns[where] = pa.array(texts, pa.string())
            names = batch.schema.names
            if with_spans:
                columns, names = [*columns, pa.array(spans, SPAN_TYPE)], [*names, "pii_spans"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(docs, run, schema)


def with_text_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, as the length of the new text."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs
