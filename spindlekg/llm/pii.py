"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

Found and checked: payment cards (Luhn), IBANs (remainder by 97), dates (calendar, 1900 to 2099), IPv4 addresses
(octets), social security numbers (number ranges), phone numbers (length), mail addresses, and values assigned to names
such as `token` or `password` (with a digit in them, but for `password=`). A value is read as a number in the domain of its format, moved by a keyed permutation of
that domain without fixed points, and written back in the same format with its check digits made right again. So equal
values, however they are punctuated, have equal pseudonyms in every document, different values different ones, and
whoever holds the key can undo them. Numbers that fail their check are left alone.
Where numbers stand side by side, each place is tried with every kind and, for cards and phones, every end at a group of
digits until one passes; a failed try takes nothing from what begins one character on. Digits alone do not always tell
where one of two neighbours ends, so pseudonyms beside other numbers can read, and undo, as a different split.

Edges, all tested: null stays null and empty stays empty; texts of any length are treated whole; repeated rows each
return a row; an empty table returns no rows. Where matches overlap, the one that is looked for first (secrets, mail
addresses, numbers from left to right) is replaced. Other columns are passed through unchanged.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import trimmed

ROUNDS = 8
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049

RUN = re.compile(r"[0-9][0-9 ().\-/]*[0-9]")
#: In the order in which they are tried at one place.
NUMBERS = {
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)",
    "iso": r"(?<![\w/.-])\d{4}(?P<i>[-/.])\d{1,2}(?P=i)\d{1,2}(?:(?=[T_]\d)|(?![\w/-]))",
    "day": r"(?<![\w/.-])\d{1,2}(?P<d>[-/.])\d{1,2}(?P=d)\d{4}(?![\w/-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}|(?<![\w.])0[1-9](?:[ .-]\d{2}){4})(?![\w])",
    "card": r"(?<![\w])\d(?:[ -]?\d){12,18}(?!\d)",
}
NUMBER = re.compile("|".join(NUMBERS.values()), re.ASCII)
NUMBERS = {kind: re.compile(pattern, re.ASCII) for kind, pattern in NUMBERS.items()}
DIGITS = re.compile(r"[0-9]+")
YEAR = re.compile(r"(?<= )(?:19|20)\d\d(?!\w)", re.ASCII)
#: What a number most likely is as a whole, if more digits follow: a card in its usual groups, a North American phone.
USUAL = {"card": re.compile(r"\d{4}([ -])(?:\d{4}\1\d{4}\1\d{4}|\d{6}\1\d{4,5})(?!\d)|\d{13,19}(?!\d)", re.ASCII), "phone": re.compile(r"\+1(?:\D*\d){10}", re.ASCII)}
IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])|[a-z]{2}\d{2}(?:[a-z0-9]{11,30}|(?: [a-z0-9]{4}){2,7}(?: [a-z0-9]{1,4})?)(?![A-Za-z0-9])", re.ASCII)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-'")
DOMAIN = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")
#: A name may have words before and behind it, joined by underscores or hyphens (AWS_SECRET_ACCESS_KEY, db-password-prod).
SECRET = re.compile(r"(?i)(?<![A-Za-z0-9])(?:token|secret|(passw(?:or)?d|pwd)|api[_-]?key|access[_-]?key|secret[_-]?key)(?:[_-][A-Za-z0-9]+){0,3}[\"']?(\s*[=:]\s*)[\"']?([A-Za-z0-9_/+=-]{8,})")
CLASSES = ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HEX = ("0123456789abcdef", "0123456789ABCDEF")


class Permutation:
    """A keyed permutation of the numbers below size, without fixed points for a size of two or more: one step on a
    circle that a Feistel network has dealt out. Numbers of the network beyond the size are walked over."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size, self.half = size, max(1, (max(1, size - 1).bit_length() + 1) // 2)
        self.mask, self.bytes = (1 << self.half) - 1, (self.half + 7) // 8
        self.key = hashlib.blake2b(f"{kind}:{size}".encode(), key=key[:64], digest_size=32).digest()

    def _round(self, i: int, x: int) -> int:
        return int.from_bytes(hashlib.blake2b(bytes([i]) + x.to_bytes(self.bytes, "big"), key=self.key, digest_size=min(64, self.bytes)).digest(), "big") & self.mask

    def _network(self, x: int, back: bool) -> int:
        while True:
            left, right = x >> self.half, x & self.mask
            for i in range(ROUNDS):
                if back:
                    left, right = right ^ self._round(ROUNDS - 1 - i, left), left
                else:
                    left, right = right, left ^ self._round(i, right)
            x = left << self.half | right
            if x < self.size:
                return x

    def move(self, x: int, step: int = 1) -> int:
        return self._network((self._network(x, False) + step) % self.size, True)


def luhn_digit(payload: str) -> str:
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(payload)))
    return str(-total % 10)


def refill(shape: str, digits: str, old: str = "0123456789") -> str:
    """shape with its characters from old replaced, in order."""
    fill = iter(digits)
    return "".join(next(fill) if c in old else c for c in shape)


class Pseudonyms:
    """step 1 makes pseudonyms, step -1 undoes them."""

    def __init__(self, key: bytes, step: int = 1):
        self.step = step
        self.permutation = lru_cache(maxsize=4096)(lambda kind, size: Permutation(key, kind, size))
        self.of = lru_cache(maxsize=65_536)(self._of)

    def _walk(self, kind: str, size: int, x: int, valid: Callable[[int], bool] = lambda x: True) -> int:
        permutation, x = self.permutation(kind, size), self.permutation(kind, size).move(x, self.step)
        while not valid(x):
            x = permutation.move(x, self.step)
        return x

    def _letters(self, kind: str, text: str, classes: tuple[str, ...]) -> str:
        places = [(i, next(k for k in classes if c in k)) for i, c in enumerate(text) if any(c in k for k in classes)]
        if not places:
            return text
        number, size = 0, 1
        for i, k in places:
            number, size = number * len(k) + k.index(text[i]), size * len(k)
        shape = "".join("0" if c.isdigit() else "A" if c.isupper() else "a" if c.isascii() and c.isalpha() else c for c in text) if len(classes) > 1 else str(len(text))
        moved, out = self._walk(f"{kind}:{shape}", size, number), list(text)
        for i, k in reversed(places):
            moved, at = divmod(moved, len(k))
            out[i] = k[at]
        return "".join(out)

    def _of(self, kind: str, value: str) -> str | None:
        """The pseudonym, or None if the value fails its check."""
        digits = "".join(c for c in value if c in "0123456789")
        if kind == "ip":
            parts = [int(x) for x in value.split(".")]
            if any(x > 255 for x in parts) or any(len(x) > 1 and x[0] == "0" for x in value.split(".")):
                return None
            return ".".join(map(str, self._walk("ip", 1 << 32, int.from_bytes(bytes(parts), "big")).to_bytes(4, "big")))
        if kind == "card":
            if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
                return None
            n = len(digits) - 1
            moved = f"{self._walk(f'card{n}', 10**n, int(digits[:-1])):0{n}d}"
            return refill(value, moved + luhn_digit(moved))
        if kind == "ssn":
            good = lambda x: (x // 10**6) not in (0, 666) and x // 10**6 < 900 and x // 10**4 % 100 and x % 10**4
            return refill(value, f"{self._walk('ssn', 10**9, int(digits), good):09d}") if good(int(digits)) else None
        if kind == "phone":
            code = re.match(r"\+(\d{1,3})", value)
            kept = 0
            if code:
                kept = len(code[1]) if not value[code.end() : code.end() + 1].isdigit() else 1
            if not 7 <= len(digits) - kept <= 14 or len(digits) > 15:
                return None
            if re.match(r"0[1-9][ .-]\d\d[ .-]", value):  # a national number stays one: the zero, then no zero
                return refill(value, f"0{10**8 + self._walk('phone0', 9 * 10**8, int(digits) - 10**8):09d}")
            n = len(digits) - kept
            return refill(value, digits[:kept] + f"{self._walk(f'phone{digits[:kept]}:{n}', 10**n, int(digits[kept:])):0{n}d}")
        if kind == "iban":
            body, small = value.replace(" ", "").upper(), value.islower()
            number = lambda s: int("".join(str(int(c, 36)) for c in s))
            if number(body[4:] + body[:4]) % 97 != 1:
                return None
            rest = self._letters("iban" + body[:2], body[4:], CLASSES)
            made = refill(value.upper(), body[:2] + f"{98 - number(rest + body[:2] + '00') % 97:02d}" + rest, "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")
            return made.lower() if small else made
        if kind in ("iso", "day"):
            return self._date(kind, value)
        if kind == "mail":
            local, _, domain = value.partition("@")
            return f"{self._letters('mail:' + domain.lower(), local, CLASSES)}@{domain}"
        if kind == "word":  # what is assigned to a password without a blank, digits or not
            kind = "secret"
        elif kind == "secret" and not any(c in "0123456789" for c in value):
            return None
        if kind == "secret":
            for alphabet in HEX:
                if set(value) <= set(alphabet):
                    return self._letters("hex", value, (alphabet,))
            return self._letters("secret", value, CLASSES)
        raise ValueError(kind)

    def _date(self, kind: str, value: str) -> str | None:
        mark = next(c for c in value if not c.isdigit())
        parts = value.split(mark)
        if kind == "iso":
            order = (0, 1, 2)
        else:
            order = (2, 0, 1) if mark == "/" and int(parts[0]) <= 12 else (2, 1, 0)
        late = order == (2, 1, 0) and mark == "/"  # day first is told from month first by a day over 12
        wide = all(len(x) >= 2 for x in parts)
        try:
            day = datetime.date(*(int(parts[i]) for i in order)).toordinal() - FIRST_DAY
        except ValueError:
            return None
        if not 0 <= day < DAYS:
            return None
        made = datetime.date.fromordinal
        valid = (lambda x: made(FIRST_DAY + x).day > 12) if late else (lambda x: True)
        found = made(FIRST_DAY + self._walk("late" if late else "date", DAYS, day, valid))
        out = dict(zip(order, (f"{found.year:04d}", f"{found.month:0{2 if wide else 1}d}", f"{found.day:0{2 if wide else 1}d}"), strict=True))
        return mark.join(out[i] for i in range(3))

    def _ends(self, text: str, start: int, limit: int, kind: str) -> list[int]:
        """Where a number of this kind that starts here can end: usual forms first, then from the longest to the
        shortest; never behind a group of digits that begins a number of its own."""
        m = NUMBERS[kind].match(text, start, limit)
        if not m or kind not in USUAL:
            return [m.end()] if m else []
        groups = [g.span() for g in DIGITS.finditer(text, start, m.end())]
        ends, whole = [], kind == "card" and self._usual_card(text, start, limit)
        for k, (at, end) in enumerate(groups):
            if k and text[at - 1] in " ." and ends and self._begins(text, at, limit, kind):
                break
            if k and kind == "card" and not whole and self._usual_card(text, at, limit):
                break
            if end == m.end() or NUMBERS[kind].fullmatch(text, start, end):
                ends.append(end)
        usual = USUAL[kind]
        return sorted(ends, key=lambda end: (usual.fullmatch(text, start, end) is None, -end))

    def _usual_card(self, text: str, at: int, limit: int) -> bool:
        m = USUAL["card"].match(text, at, limit)
        return bool(m and NUMBERS["card"].match(text, at, m.end()) and self.of("card", m[0]) is not None)

    def _begins(self, text: str, at: int, limit: int, kind: str) -> bool:
        """Whether another number than a phone begins here, or, behind a phone, a year."""
        if kind == "phone" and YEAR.match(text, at, limit):
            return True
        for other, pattern in NUMBERS.items():
            m = pattern.match(text, at, limit) if other != "phone" else None
            if m and other != "card" and self.of(other, m[0]) is not None:
                return True
            if m and other == "card" and any(self.of("card", text[at:end]) is not None for end in (g.end() for g in DIGITS.finditer(text, at, m.end())) if pattern.fullmatch(text, at, end)):
                return True
        return False

    def apply(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and how many of each kind."""
        found: list[tuple[int, int, str, str]] = []
        taken: list[tuple[int, int]] = []  # the same places, in order

        def note(start: int, end: int, kind: str) -> bool:
            k = bisect_left(taken, (start, end))
            if (k and taken[k - 1][1] > start) or (k < len(taken) and taken[k][0] < end):
                return False
            new = self.of(kind, text[start:end])
            if new is not None:
                found.append((start, end, "secret" if kind == "word" else kind, new))
                taken.insert(k, (start, end))
            return new is not None

        if "=" in text or ":" in text:
            for m in SECRET.finditer(text):
                note(m.start(3), m.end(3), "word" if m[1] and m[2] == "=" else "secret")
        at = text.find("@")
        while at >= 0:
            start = at
            while start > 0 and text[start - 1] in LOCAL:
                start -= 1
            while start < at and text[start] in ".-+%'":
                start += 1
            domain = DOMAIN.match(text, at + 1)
            if domain and start < at:
                note(start, domain.end(), "mail")
            at = text.find("@", at + 1)
        done = 0
        for run in RUN.finditer(text):
            start = max(done, run.start() - 2)
            iban = IBAN.match(text, run.start() - 2) if run.start() >= 2 and (text[run.start() - 2 : run.start()].isupper() or text[run.start() - 2 : run.start()].islower()) and not text[max(0, run.start() - 3) : run.start() - 2].isalnum() else None
            while iban:
                end = iban.end()
                if note(iban.start(), end, "iban"):
                    done = start = end
                    break
                space = text.rfind(" ", iban.start(), end)
                iban = IBAN.match(text, iban.start(), space) if space > 0 else None
            limit = min(len(text), run.end() + 2)
            while m := NUMBER.search(text, start, limit):
                start = m.start() + 1
                for kind, end in ((kind, end) for kind in NUMBERS for end in self._ends(text, m.start(), limit, kind)):
                    if note(m.start(), end, kind):
                        done = start = end
                        break
        if not found:
            return text, {}
        out, at, counts = [], 0, {}
        for start, end, kind, new in sorted(found):
            out += [text[at:start], new]
            at = end
            counts[kind] = counts.get(kind, 0) + 1
        return "".join([*out, text[at:]]), counts


KINDS = ("secret", "mail", "iban", "ip", "iso", "day", "ssn", "phone", "card")


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """docs with the text column rewritten, and in found_col, if named, a string such as `card=1;mail=2`. A row per
    input row, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonyms(key)
        for batch in trimmed(batches):
            at = batch.schema.get_field_index("__text")
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                made = [(None, {}) if t is None else own.apply(t) for t in part.column(at).to_pylist()]
                columns = part.columns
                columns[at] = pa.array([m[0] for m in made], pa.string())
                counts = pa.array([";".join(f"{k}={m[1][k]}" for k in KINDS if k in m[1]) for m in made], pa.string())
                yield pa.RecordBatch.from_arrays([*columns, counts], names=[*part.schema.names, "__found"])

    others = [c for c in docs.columns if c != text_col]
    kept = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    rows = docs.select(kept.alias("__kept"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    out = rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("__found", T.StringType())]))
    columns = [F.col("__text").alias(c) if c == text_col else F.col(f"__kept.`{c}`").alias(c) for c in docs.columns]
    return out.select(*columns, *([F.col("__found").alias(found_col)] if found_col else []))
