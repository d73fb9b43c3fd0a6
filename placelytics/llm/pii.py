"""Format-preserving pseudonyms for validated numbers, dates and addresses in texts.

A value is read as a number below the size of its format's value space, permuted there by a keyed
Feistel network and written back in the same format: a card stays a card with a right check
digit, a dialable phone number a dialable one, a date a date. The permutation depends on the key and the kind
alone, so equal values get equal pseudonyms in every document, however they are punctuated, and no
table of values is kept or joined. It is a bijection: unlike values stay unlike.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame

from placelytics.llm.shared import require

ROUNDS = 8


def permuted(value: int, size: int, key: bytes, valid: Callable[[int], bool] = lambda x: True) -> int:
    """A keyed permutation of the valid numbers below ``size``: Feistel rounds, walked until valid."""
    left_size = isqrt(size - 1) + 1
    right_size = -(-size // left_size)
    while True:
        left, right = value % left_size, value // left_size
        for i in range(ROUNDS):
            seen = right if i % 2 == 0 else left
            digest = hashlib.blake2b(b"%d:%d:%d" % (i, size, seen), key=key, digest_size=16).digest()
            add = int.from_bytes(digest, "big")
            if i % 2 == 0:
                left = (left + add) % left_size
            else:
                right = (right + add) % right_size
        value = right * left_size + left
        if value < size and valid(value):
            return value


def luhn_ok(digits: str) -> bool:
    doubled = (int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _check_digit(digits: str) -> str:
    return next(d for d in "0123456789" if luhn_ok(digits + d))


def _redrawn(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    new = iter(digits)
    return re.sub(r"\d", lambda _: next(new), shape)


def _card(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 13 <= len(digits) <= 19 or not luhn_ok(digits):
        return None
    # The first digit, which names the network, and the length stay.
    n = len(digits) - 2
    body = digits[0] + f"{permuted(int(digits[1:-1]), 10**n, key + b'card%d' % len(digits)):0{n}}"
    return _redrawn(found, body + _check_digit(body))


def _phone_ok(number: int) -> bool:
    """Whether a North American number can be dialled."""
    area, exchange = number // 10**7, number // 10**4 % 1000
    return area >= 200 and exchange >= 200 and area % 100 != 11 and exchange % 100 != 11


_TWO_DIGIT_COUNTRIES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66"
    " 81 82 84 86 90 91 92 93 94 95 98".split()
)


def _country(digits: str) -> str:
    return digits[:1] if digits[0] in "17" else digits[:2] if digits[:2] in _TWO_DIGIT_COUNTRIES else digits[:3]


def _phone(found: str, key: bytes) -> str | None:
    """The country code stays. In North America numbers that can be dialled go to such, and others to others."""
    digits = re.sub(r"\D", "", found)
    country = _country(digits) if found[0] == "+" else digits[:-10]
    rest = digits[len(country) :]
    number, n = int(rest), len(rest)
    if country not in ("", "1"):
        if country == "7" and n != 10:
            return None
        return _redrawn(found, country + f"{permuted(number, 10**n, key + b'phone%d+' % n + country.encode()):0{n}}")
    if n != 10:
        return None
    dialled = _phone_ok(number)
    new = permuted(number, 10**10, key + b"phone", lambda x: _phone_ok(x) == dialled)
    return _redrawn(found, f"{country}{new:010}")


def _ssn_ok(number: int) -> bool:
    area, group, serial = number // 10**6, number // 10**4 % 100, number % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not _ssn_ok(int(digits)):
        return None
    return _redrawn(found, f"{permuted(int(digits), 10**9, key + b'ssn', _ssn_ok):09}")


def _iban_rest(letters: str) -> int:
    return int("".join(str(int(c, 36)) for c in letters)) % 97


def _iban(found: str, key: bytes) -> str | None:
    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_rest(plain[4:] + plain[:4]) != 1:
        return None
    digits = re.sub(r"\D", "", plain[4:])
    new = iter(f"{permuted(int(digits), 10 ** len(digits), key + b'iban' + plain[:2].encode()):0{len(digits)}}")
    body = re.sub(r"\d", lambda _: next(new), plain[4:])
    whole = iter(plain[:2] + f"{98 - _iban_rest(body + plain[:2] + '00'):02}" + body)
    return re.sub(r"[A-Z0-9]", lambda _: next(whole), found)


def _ip_ok(number: int) -> bool:
    """Whether an address can be that of a host on the public net."""
    return 0 < number >> 24 < 224 and number >> 24 not in (10, 127)


def _ip(found: str, key: bytes) -> str | None:
    """Public addresses go to public ones, and others to others."""
    parts = [int(p) for p in found.split(".")]
    if max(parts) > 255:
        return None
    number = int.from_bytes(bytes(parts), "big")
    public = _ip_ok(number)
    new = permuted(number, 1 << 32, key + b"ip", lambda x: _ip_ok(x) == public)
    return ".".join(map(str, new.to_bytes(4, "big")))


_FIRST, _DAYS = dt.date(1900, 1, 1).toordinal(), 200 * 365 + 48


def _date(pattern: str) -> Callable[[str, bytes], str | None]:
    """Dates of 1900 to 2099, written with ``pattern``."""
    width = {"%Y-%m-%d": 10, "%d/%m/%Y": 10, "%d.%m.%Y": 10}

    def replaced(found: str, key: bytes) -> str | None:
        try:
            day = dt.datetime.strptime(found, pattern).date().toordinal() - _FIRST
        except ValueError:
            return None
        if len(found) != width[pattern] or not 0 <= day < _DAYS:
            return None
        return dt.date.fromordinal(_FIRST + permuted(day, _DAYS, key + b"date")).strftime(pattern)

    return replaced


def _mail(found: str, key: bytes) -> str | None:
    """Letters of the local part become letters and digits digits; the domain stays."""
    name, domain = found.rsplit("@", 1)
    sizes = [10 if c.isdigit() else 26 for c in name.lower() if c.isalnum()]
    number, size = 0, 1
    for c, n in zip((c for c in name.lower() if c.isalnum()), sizes, strict=True):
        number, size = number * n + (int(c) if n == 10 else ord(c) - 97), size * n
    shape = re.sub(r"[a-z]", "a", re.sub(r"\d", "0", name.lower()))
    own = hashlib.blake2b(f"{shape}@{domain.lower()}".encode(), digest_size=24).digest()
    number = permuted(number, size, key + b"mail" + own) if size > 1 else 0
    new = []
    for n in reversed(sizes):
        number, digit = divmod(number, n)
        new.append(str(digit) if n == 10 else chr(97 + digit))
    drawn = reversed(new)
    return re.sub(r"[A-Za-z0-9]", lambda _: next(drawn), name) + "@" + domain


#: Kind, pattern and replacement, tried in this order at every place of a text.
KINDS: dict[str, tuple[str, Callable[[str, bytes], str | None]]] = {
    "mail": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,}", _mail),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    "date": (r"(?<![\d.-])\d{4}-\d{2}-\d{2}(?![\d-])", _date("%Y-%m-%d")),
    "date_slashed": (r"(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])", _date("%d/%m/%Y")),
    "date_dotted": (r"(?<![\d.])\d{2}\.\d{2}\.\d{4}(?!\d|\.\d)", _date("%d.%m.%Y")),
    "ip": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)", _ip),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn),
    "card": (r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)", _card),
    "phone": (
        r"(?<![\d+])(?:(?:(?:\+\d{1,3}|1)[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
        r"|\+[1-9](?:[ .()/-]{0,2}\d){7,14}(?!\d|\.\d))",
        _phone,
    ),
}
_ANY = re.compile("|".join(f"(?:{pattern})" for pattern, _ in KINDS.values()))
_PATTERNS = {kind: re.compile(pattern) for kind, (pattern, _) in KINDS.items()}
#: A part of a longer run of digits counts as a card only if written like one.
_CARD_LIKE = re.compile(r"\d{13,19}|\d{4,}([ -])\d{3,}(?:\1\d{3,})*(?:\1\d+)?")
#: Length of an IBAN by country.
_IBAN_LENGTHS = {
    item[:2]: int(item[2:])
    for item in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29"
        " ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20"
        " LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29"
        " PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
        " YE30"
    ).split()
}
_HINT = re.compile(r"[0-9@]")
_OTHERS = [kind for kind in KINDS if kind != "phone"]


def _ends(kind: str, text: str, start: int, longest: int) -> list[int]:
    """Where a value that starts at ``start`` may end: at the end of a group, the longest first."""
    ends = [longest]
    if kind in ("iban", "card", "phone"):
        ends += [
            p for p in range(longest - 1, start, -1)
            if text[p - 1].isalnum() and not text[p].isalnum() and _PATTERNS[kind].fullmatch(text, start, p)
        ]
    if kind == "iban":
        length = _IBAN_LENGTHS.get(text[start : start + 2])
        ends.sort(key=lambda p: p - start - text.count(" ", start, p) != length)
    return ends


def pseudonymised(text: str, key: bytes) -> tuple[str, int]:
    """``text`` with its valid values replaced, and their number. Text without any comes back as it is.

    Where the longest match of a kind fails its check, its shorter ends and the other kinds are tried,
    and then the places behind its start.
    """
    if not _HINT.search(text):
        return text, 0

    @lru_cache(maxsize=1024)
    def new(kind: str, found: str) -> str | None:
        return KINDS[kind][1](found, key)

    def value_at(start: int, tried: int, kinds: Iterable[str]) -> tuple[int, str | None]:
        """The end and the pseudonym of the value at ``start``; without one, the end of what was matched."""
        furthest = start
        for kind in kinds:
            match = _PATTERNS[kind].match(text, start)
            if match is None:
                continue
            furthest = max(furthest, match.end())
            for end in _ends(kind, text, start, match.end()):
                part = end < match.end() or start < tried
                if kind == "card" and part and not _CARD_LIKE.fullmatch(text, start, end):
                    continue
                if kind == "phone" and match[0][0] == "+" and cuts(start, end):
                    continue
                value = new(kind, text[start:end])
                if value is not None:
                    return end, value
        return furthest, None

    def cuts(start: int, end: int) -> bool:
        """Whether another value starts in a phone number of open length and ends with it or behind it."""
        inner = (p for p in range(start + 1, end) if text[p].isdigit() and not text[p - 1].isalnum())
        return any(found[1] is not None and found[0] >= end for found in (value_at(p, end, _OTHERS) for p in inner))

    pieces, done, at, copied, tried = [], 0, 0, 0, 0
    while match := _ANY.search(text, at):
        start = match.start()
        end, value = value_at(start, tried, KINDS)
        if value is None:
            tried, at = end if start >= tried else tried, start + 1
        else:
            pieces += text[copied:start], value
            done, at, copied = done + 1, end, end
    return "".join([*pieces, text[copied:]]) if done else text, done


def pseudonymise(docs: DataFrame, id: str = "doc_id", text: str = "text", *, key: bytes) -> DataFrame:
    """``(id, text, n_values)`` of every row: the text with pseudonyms, and how many it holds.

    ``key`` is the user's own, of 1 to 32 bytes; who knows it can turn every pseudonym back. Every value whose format
    and check digits are right is replaced. What only looks like a value, such as a number with a wrong check digit, stays. A null text
    stays null with 0 values; repeated rows give equal results; an empty table an empty one.
    """
    require(docs, id, text)
    if not 1 <= len(key) <= 32:
        raise ValueError("the key must have 1 to 32 bytes")

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [(None, 0) if t is None else pseudonymised(t, key) for t in b.column(1).to_pylist()]
            columns = [b.column(0), pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[id, text, "n_values"])

    rows = docs.select(docs[id], docs[text])
    kind = rows.schema[id].dataType.simpleString()
    return rows.mapInArrow(batch, f"`{id}` {kind}, `{text}` string, n_values long")
