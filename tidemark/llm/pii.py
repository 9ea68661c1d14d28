"""Pseudonyms for personal data that keep its format and link equal values.

Numbers and dates that pass their check (Luhn, mod 97, ranges, calendar) are put through a keyed
permutation of all values of their format: a Feistel network over their rank, walked on until the result is
in the format again. It is one-to-one, so equal values get equal pseudonyms in every
document, different ones never the same, and the holder of the key can restore them.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

# What characters may stand for each other.
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß"]
_ALPHABET_OF = {c: a for a in ALPHABETS for c in a}


class Permutation:
    """A keyed one-to-one map of 0 .. size - 1 onto itself, another one for each purpose and size."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, purpose: bytes, i: int, value: int, bits: int) -> int:
        text = purpose + bytes([i]) + value.to_bytes(bits // 8 + 1, "big")
        wide = max(8, (bits + 7) // 8 + 8)
        out = b""
        while len(out) < wide:
            out += hashlib.blake2b(text + bytes([len(out) // 64]), key=self.key).digest()
        return int.from_bytes(out[:wide], "big") & ((1 << bits) - 1)

    def apply(self, value: int, size: int, purpose: str, back: bool = False) -> int:
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        own = f"{purpose}/{size}/".encode()
        low = (1 << bits) - 1
        rounds = range(ROUNDS)
        while True:
            left, right = value >> bits, value & low
            if back:
                for i in reversed(rounds):
                    left, right = right ^ self._round(own, i, left, bits), left
            else:
                for i in rounds:
                    left, right = right, left ^ self._round(own, i, right, bits)
            value = left << bits | right
            if value < size:
                return value


def _permute_characters(p: Permutation, text: str, purpose: str, back: bool) -> str:
    """Letters and digits of a text as one number, each keeping its place and alphabet; other characters stay."""
    value, size = 0, 1
    for c in text:
        if a := _ALPHABET_OF.get(c):
            value, size = value * len(a) + a.index(c), size * len(a)
    value = p.apply(value, size, purpose, back) if size > 1 else 0
    out = []
    for c in reversed(text):
        if a := _ALPHABET_OF.get(c):
            value, digit = divmod(value, len(a))
            c = a[digit]
        out.append(c)
    return "".join(reversed(out))


def _refill(shape: str, digits: str) -> str:
    """The digits, in the places of the digits of `shape`."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in shape)


def luhn(digits: str) -> int:
    total = sum(int(c) for c in digits[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10


def _card(p: Permutation, text: str, back: bool) -> str | None:
    digits = "".join(c for c in text if c.isdigit())
    if luhn(digits):
        return None
    body = str(p.apply(int(digits[:-1]), 10 ** (len(digits) - 1), "card", back)).zfill(len(digits) - 1)
    return _refill(text, body + str(-luhn(body + "0") % 10))


def _ssn(p: Permutation, text: str, back: bool) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rank, serial = divmod(p.apply(rank, 898 * 99 * 9999, "ssn", back), 9999)
    area, group = divmod(rank, 99)
    return f"{area + 1 + (area + 1 >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def _ip(p: Permutation, text: str, back: bool) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    value = p.apply(int.from_bytes(bytes(octets), "big"), 1 << 32, "ip", back)
    return ".".join(str(b) for b in value.to_bytes(4, "big"))


def _phone(p: Permutation, text: str, back: bool) -> str | None:
    digits = "".join(c for c in text if c.isdigit())
    own = digits[-10:] if len(digits) >= 10 else digits  # the country code stays
    new = str(p.apply(int(own), 10 ** len(own), "phone", back)).zfill(len(own))
    return _refill(text, digits[: len(digits) - len(own)] + new)


def _email(p: Permutation, text: str, back: bool) -> str | None:
    local, at, domain = text.rpartition("@")
    return _permute_characters(p, local, "email/" + domain.lower(), back) + at + domain


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _iban(p: Permutation, text: str, back: bool) -> str | None:
    tight = text.replace(" ", "")
    if not 15 <= len(tight) <= 34 or _iban_rest(tight) != 1:
        return None
    body = _permute_characters(p, tight[4:], "iban/" + tight[:2], back)
    check = 98 - _iban_rest(tight[:2] + "00" + body)
    rest = iter(f"{tight[:2]}{check:02d}{body}")
    return "".join(" " if c == " " else next(rest) for c in text)


def _date(order: str, least_day: int = 1) -> Callable[[Permutation, str, bool], str | None]:
    """`order` names the parts in the text: y, m, d. Days before `least_day` are left to another order."""

    def change(p: Permutation, text: str, back: bool) -> str | None:
        parts = re.split(r"[-/.]", text)
        values = dict(zip(order, map(int, parts), strict=True))
        try:
            day = datetime.date(values["y"], values["m"], values["d"]).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY or values["d"] < least_day:
            return None
        while True:
            day = FIRST_DAY + p.apply(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date", back)
            if (new := datetime.date.fromordinal(day)).day >= least_day:
                break
        written = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        return re.sub(r"\d+", lambda m, names=iter(order): written[next(names)], text)

    return change


# How long the IBANs of a country are.
IBAN_CHARS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 BA20 BE16 BG22 CH21 CY28 CZ24 DE22 DK18 EE20 ES24 FI18 FR27 GB22 GI23 GR27 HR21 HU28 IE22 IL23 IS26 "
    "IT27 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MT31 NL18 NO15 PL28 PT25 RO24 RS22 SA24 SE24 SI19 SK24 SM27 TR26 UA29"
).split()}
# How cards are grouped.
CARD_GROUPS = re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?|[0-9]{6}\1[0-9]{4,5})")


class Runs(NamedTuple):
    """Values of whole groups within a run of groups: a number may stand beside other numbers or words."""

    least: int  # characters, without what stands between groups
    most: int
    begins: re.Pattern
    not_before: re.Pattern  # what may not follow the last group
    usual: Callable[[str], bool]  # written as such values are: goes before runs of other groups

    def taken(self, text: str, groups: list[tuple[int, int]], i: int, change: Callable[[str], str | None]) -> int:
        """The end of the value that begins at group i, or i. It depends on less than 2 * `most` characters from there."""

        def ends(i: int) -> Iterator[int]:
            size = 0
            if not self.begins.match(text, groups[i][0]):
                return
            for j in range(i, len(groups)):
                size += groups[j][1] - groups[j][0]
                if size > self.most:
                    return
                if size >= self.least and not (j == len(groups) - 1 and self.not_before.match(text, groups[j][1])):
                    yield j + 1

        def own(i: int, j: int) -> str:
            return text[groups[i][0] : groups[j - 1][1]]

        def usual(i: int) -> int:
            return max((j for j in ends(i) if self.usual(own(i, j)) and change(own(i, j)) is not None), default=i)

        if (j := usual(i)) > i:
            return j
        for j in sorted(ends(i), reverse=True):
            if change(own(i, j)) is not None and all(usual(k) == k for k in range(i + 1, j)):
                return j
        return i

    def find(self, text: str, end: int, change: Callable[[str], str | None], back: bool) -> list[tuple[int, int, str]]:
        """(start, end, new) of the values in a run, which ends at `end` of the text. Where a new value would make up another one together with
        its neighbours, it is changed again, so that `restore` finds the values in the same places."""
        groups = [m.span() for m in re.finditer(r"[A-Za-z0-9]+", text[:end])]
        steps, i = [], 0
        while i < len(groups):
            j = self.taken(text, groups, i, change)
            steps.append((i, j))
            i = max(j, i + 1)
        spans, now = [], text
        numbered = [(n, i, j) for n, (i, j) in enumerate(steps) if j > i]
        for n, i, j in reversed(numbered) if back else numbered:
            start, end = groups[i][0], groups[j - 1][1]
            first = n
            while first and i - steps[first - 1][0] <= 2 * self.most:
                first -= 1
            value = now[start:end]
            while True:
                value = change(value)
                now = now[:start] + value + now[end:]
                if all(self.taken(now, groups, a, change) == b for a, b in steps[first : n + 1]):
                    break
            spans.append((start, end, value))
        return spans


RUNS = {
    "card": Runs(13, 19, re.compile("[0-9]"), re.compile(r"[\w-]"), lambda x: CARD_GROUPS.fullmatch(x) is not None),
    "iban": Runs(15, 34, re.compile("[A-Z]{2}[0-9]{2}"), re.compile("[A-Za-z0-9]"), lambda x: len(x.replace(" ", "")) == IBAN_CHARS.get(x[:2])),
}

# Kinds by precedence: where two overlap, the one that begins first wins, then the one named first.
KINDS: list[tuple[str, re.Pattern, Callable[[Permutation, str, bool], str | None]]] = [
    ("email", re.compile(r"(?<![\w.+-])\w[\w.+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}(?![\w-])"), _email),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?: ?[A-Z0-9]){11})[A-Z0-9]*+(?: [A-Z0-9]++)*+"), _iban),
    ("ip", re.compile(r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?\w)"), _ip),
    ("date", re.compile(r"(?<![\w./-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![\w/-])"), _date("ymd")),
    ("date", re.compile(r"(?<![\w./-])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![\w/-])"), _date("dmy")),
    ("date", re.compile(r"(?<![\w./-])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![\w/-])"), _date("mdy")),
    ("date", re.compile(r"(?<![\w./-])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![\w/-])"), _date("dmy", least_day=13)),
    ("ssn", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), _ssn),
    ("card", re.compile(r"(?<![\w.+-])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?:[ -][0-9]++)*+"), _card),
    ("phone", re.compile(r"(?<![\w.-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])?[0-9]{3}[.-][0-9]{4}(?![\w-])"), _phone),
    ("phone", re.compile(r"(?<![\w.+-])\+[0-9]{1,3}(?:[ .-]?[0-9]){7,12}(?![\w-])"), _phone),
]
_ANY = re.compile(r"[0-9@]")


def find(p: Permutation, text: str, back: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of what is personal in a text, in order, in code points."""
    if not _ANY.search(text):
        return []
    hits = []
    for rank, (kind, pattern, change) in enumerate(KINDS):
        if (kind == "email") and "@" not in text:
            continue
        for m in pattern.finditer(text):
            if runs := RUNS.get(kind):
                found = runs.find(text[m.start() : m.end() + 1], m.end() - m.start(), lambda x, change=change: change(p, x, back), back)
                hits += [(m.start() + start, rank, m.start() + end, kind, new) for start, end, new in found]
            elif (new := change(p, m[0], back)) is not None:
                hits.append((m.start(), rank, m.end(), kind, new))
    found, at = [], 0
    for start, _, end, kind, new in sorted(hits):
        if start >= at:
            found.append((start, end, kind, new))
            at = end
    return found


def replaced(text: str, found: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, _, new in found:
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]])


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", *, restore: bool = False) -> DataFrame:
    """Every document with its whole text under pseudonyms, and `pii`: what was replaced, by place.

    pii is an array of (start, end, kind, pseudonym) in code points of the text given. Card
    numbers keep their Luhn check, IBANs their country and a right check sum, phone numbers their
    country code, mail addresses their domain; dates stay dates from 1900 to 2099, addresses IPv4. What fails its
    check is no card number, date, IBAN, IP address or social security number and stays. `restore` undoes it with the same key.
    Null texts stay null with an empty pii, empty ones stay empty. All other columns and repeated
    rows are kept; an input column `pii` is replaced; an empty table gives an empty result.
    """
    columns = docs.columns
    spans = "array<struct<start:int,end:int,kind:string,pseudonym:string>>"
    others = [F.col(c) for c in columns if c != text] or [F.lit(1)]
    small = docs.select(F.struct(*others).alias("row"), F.col(text).cast("string").alias("t"))
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("pseudonym", pa.string())]))

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Permutation(key)
        for batch in batches:
            texts, out = batch.column(1).to_pylist(), []
            for i, t in enumerate(texts):
                found = find(p, t, restore) if t else []
                if found:
                    texts[i] = replaced(t, found)
                out.append([dict(zip(("start", "end", "kind", "pseudonym"), f, strict=True)) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(out, span_type)], ["row", "t", "pii"])

    schema = StructType([*small.schema.fields, *StructType.fromDDL(f"pii {spans}").fields])
    done = small.mapInArrow(change, schema)
    return done.select(*[F.col("t").alias(c) if c == text else F.col("row")[c].alias(c) for c in columns if c.lower() != "pii"], "pii")
