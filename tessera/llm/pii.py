"""Format-preserving pseudonyms for personal data.

Validated values (card numbers by Luhn, IBANs by remainder 97, dates by calendar, phone,
social-security and network addresses by their ranges, e-mail addresses and secrets by
shape) are replaced by a keyed permutation of their own format: a Feistel network over
the set of valid values, with cycle walking. Equal values get equal pseudonyms in every
document, different values different ones, and whoever holds the key can undo it.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect
from collections.abc import Callable, Iterator
from datetime import date
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame

ROUNDS = 8
#: Only for tests and demonstrations; a deployment passes its own secret.
DEMO_KEY = b"tessera demonstration key"


class Permutation:
    """Keyed permutations of 0..size-1."""

    def __init__(self, key: bytes):
        self.key = key

    def _f(self, tweak: str, i: int, value: int, mod: int) -> int:
        data = self.key + b"\x00" + tweak.encode() + b"\x00" + bytes([i]) + value.to_bytes((value.bit_length() + 7) // 8, "big")
        return int.from_bytes(hashlib.shake_256(data).digest((mod.bit_length() + 7) // 8 + 8), "big") % mod

    def _cells(self, size: int) -> tuple[int, int]:
        a = isqrt(size - 1) + 1
        return a, -(-size // a)

    def forward(self, x: int, size: int, tweak: str, valid: Callable[[int], bool] | None = None) -> int:
        """Image of ``x``; with ``valid``, of the permutation of the valid values alone
        (``x`` must be one of them)."""
        a, b = self._cells(size)
        while True:
            left, right = divmod(x, b)
            for i in range(0, ROUNDS, 2):
                left = (left + self._f(tweak, i, right, a)) % a
                right = (right + self._f(tweak, i + 1, left, b)) % b
            x = left * b + right
            if x < size and (valid is None or valid(x)):
                return x

    def backward(self, x: int, size: int, tweak: str, valid: Callable[[int], bool] | None = None) -> int:
        a, b = self._cells(size)
        while True:
            left, right = divmod(x, b)
            for i in reversed(range(0, ROUNDS, 2)):
                right = (right - self._f(tweak, i + 1, left, b)) % b
                left = (left - self._f(tweak, i, right, a)) % a
            x = left * b + right
            if x < size and (valid is None or valid(x)):
                return x


def _classes(text: str) -> list[tuple[int, int, int]]:
    """(position, first code, radix) of the characters that are permuted."""
    out = []
    for i, c in enumerate(text):
        for lo, hi in ("09", "az", "AZ"):
            if lo <= c <= hi:
                out.append((i, ord(lo), ord(hi) - ord(lo) + 1))
    return out


def _number(text: str) -> tuple[int, int]:
    """(value, size) of a text among all texts of its pattern of digits and letters."""
    value, size = 0, 1
    for i, lo, radix in _classes(text):
        value, size = value * radix + ord(text[i]) - lo, size * radix
    return value, size


def _text(value: int, like: str) -> str:
    out = list(like)
    for i, lo, radix in reversed(_classes(like)):
        value, digit = divmod(value, radix)
        out[i] = chr(lo + digit)
    return "".join(out)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _refill(like: str, digits: str) -> str:
    take = iter(digits)
    return "".join(next(take) if "0" <= c <= "9" else c for c in like)


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _luhn_digit(payload: str) -> str:
    return next(str(d) for d in range(10) if luhn_ok(payload + str(d)))


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _phone_ok(digits: str) -> bool:
    d = digits[-10:]
    return d[0] >= "2" and d[3] >= "2"


def _ssn_ok(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def _ip_class(value: int) -> bool:
    return ipaddress.IPv4Address(value).is_global


# Calling codes of fewer than three digits, and the lengths of national numbers
# of those with short or certain ones; others have up to fifteen digits with the code.
_SHORT_CODES = {"1", "7", "20", "27", *map(str, (*range(30, 35), 36, *range(39, 42), *range(43, 50), *range(51, 59), *range(60, 67), 81, 82, 84, 86,
                                               *range(90, 96), 98))}
_NSN = {"7": (10, 10), "20": (8, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9), "34": (9, 9),
        "36": (8, 9), "39": (6, 11), "40": (9, 9), "41": (9, 9), "44": (9, 10), "45": (8, 8), "46": (7, 10), "47": (8, 8),
        "48": (9, 9), "49": (6, 11), "51": (8, 9), "52": (10, 10), "54": (10, 11), "55": (10, 11), "56": (9, 9), "57": (10, 10),
        "60": (8, 10), "61": (9, 9), "62": (8, 12), "63": (8, 10), "64": (8, 10), "65": (8, 8), "66": (8, 9), "81": (9, 10),
        "82": (8, 10), "84": (9, 10), "86": (10, 11), "90": (10, 10), "91": (10, 10), "92": (9, 10), "98": (10, 10),
        "351": (9, 9), "353": (7, 9), "354": (7, 9), "358": (6, 11), "380": (9, 9), "420": (9, 9), "421": (9, 9),
        "852": (8, 8), "971": (8, 9), "972": (8, 9)}


def _country(text: str) -> tuple[str, int]:
    """Calling code of a number that begins with '+', and where its national number begins."""
    code = re.match(r"\+(\d{1,3})", text)[1]
    code = next((code[:n] for n in (1, 2) if code[:n] in _SHORT_CODES), code)
    return code, re.compile(r"[ .-]?\(0\)|").match(text, 1 + len(code)).end()


def _nsn_ok(code: str, n: int) -> bool:
    least, most = _NSN.get(code, (7, 15 - len(code)))
    return least <= n <= most


_HEX = re.compile("[0-9a-f]+")
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
_DAYS = LAST_DAY.toordinal() - FIRST_DAY.toordinal() + 1


def _day(text: str) -> tuple[date, str] | None:
    """(date, layout) of a numeric date; an ambiguous one is read month first where its
    separator is '/', else day first."""
    m = re.fullmatch(r"(\d+)([-/.])(\d+)\2(\d+)", text)
    a, sep, b, c = int(m[1]), m[2], int(m[3]), int(m[4])
    layouts = [("ymd", a, b, c)] if len(m[1]) == 4 else [("mdy", c, a, b), ("dmy", c, b, a)][:: 1 if sep == "/" else -1]
    for layout, y, mo, d in layouts:
        try:
            day = date(y, mo, d)
        except ValueError:
            continue
        if FIRST_DAY <= day <= LAST_DAY:
            return day, layout
    return None


def _day_class(day: date) -> tuple[bool, int]:
    """Days that every layout writes with as many digits and reads back in the same order: months of one
    or two digits; days of one, of two that could be a month, and later ones."""
    return day.month > 9, (day.day > 9) + (day.day > 12)


class Pseudonyms:
    """One method per kind: the pseudonym of a value, or None if it is not valid."""

    def __init__(self, key: bytes, back: bool = False):
        p = Permutation(key)
        self.turn = p.backward if back else p.forward

    def _walk(self, digits: str, tweak: str, ok: Callable[[str], bool]) -> str:
        n, same = len(digits), ok(digits)
        valid = lambda x: ok(f"{x:0{n}d}") == same  # noqa: E731  valid stays valid, and the rest the rest
        return f"{self.turn(int(digits), 10 ** n, tweak, valid):0{n}d}"

    def email(self, text: str) -> str:
        local, at, domain = text.rpartition("@")
        value, size = _number(local)
        return (_text(self.turn(value, size, f"email {domain.lower()}"), local) if size > 1 else local) + at + domain

    def iban(self, text: str) -> str | None:
        if not iban_ok(text):
            return None
        s = text.replace(" ", "")
        value, size = _number(s[4:])
        bank = _text(self.turn(value, size, f"iban {s[:2]}"), s[4:])
        rest = int("".join(str(int(c, 36)) for c in bank + s[:2] + "00")) % 97
        take = iter(f"{s[:2]}{98 - rest:02d}{bank}")
        return "".join(c if c == " " else next(take) for c in text)

    def card(self, text: str) -> str | None:
        d = _digits(text)
        if len(d) < 13 or not luhn_ok(d) or len(set(d)) == 1:
            return None
        n = len(d) - 2  # the first digit (network) and the check digit are not free
        free = d[0] + f"{self.turn(int(d[1:-1]), 10 ** n, 'card'):0{n}d}"
        return _refill(text, free + _luhn_digit(free))

    def ip(self, text: str) -> str | None:
        parts = [int(x) for x in text.split(".")]
        if max(parts) > 255:
            return None
        value = int.from_bytes(bytes(parts), "big")
        same = _ip_class(value)
        new = self.turn(value, 1 << 32, "ip", lambda x: _ip_class(x) == same)
        return ".".join(str(b) for b in new.to_bytes(4, "big"))

    def ssn(self, text: str) -> str | None:
        d = _digits(text)
        return _refill(text, self._walk(d, "ssn", _ssn_ok)) if _ssn_ok(d) else None

    def phone(self, text: str) -> str | None:
        d = _digits(text)
        if text[0] == "+" and d[0] != "1":
            cc, at = _country(text)
            nsn = _digits(text[at:])
            if not _nsn_ok(cc, len(nsn)):
                return None
            return text[:at] + _refill(text[at:], self._walk(nsn, f"phone +{cc}", lambda x: x[0] != "0"))
        if len(d) != 10 and (len(d) != 11 or d[0] != "1"):
            return None
        return _refill(text, d[:-10] + self._walk(d[-10:], "phone", _phone_ok))

    def date(self, text: str) -> str | None:
        found = _day(text)
        if not found:
            return None
        day, layout = found
        sep = next(c for c in text if c in "-/.")
        a, b, c = (len(x) for x in text.split(sep))
        widths = {"ymd": (b, c), "mdy": (a, b), "dmy": (b, a)}[layout]
        first, kind = FIRST_DAY.toordinal(), _day_class(day)
        # the layout has no part in it, so a day has one pseudonym however it is written
        d = date.fromordinal(first + self.turn(day.toordinal() - first, _DAYS, "date",
                                               lambda x: _day_class(date.fromordinal(first + x)) == kind))
        y, mo, d = f"{d.year:04d}", f"{d.month:0{widths[0]}d}", f"{d.day:0{widths[1]}d}"
        return sep.join({"ymd": (y, mo, d), "mdy": (mo, d, y), "dmy": (d, mo, y)}[layout])

    def secret(self, text: str) -> str:
        if _HEX.fullmatch(text):  # stays hexadecimal
            return f"{self.turn(int(text, 16), 16 ** len(text), 'hex'):0{len(text)}x}"
        value, size = _number(text)
        return _text(self.turn(value, size, "secret", lambda x: not _HEX.fullmatch(_text(x, text))), text)


# In order of precedence: of overlapping finds the earlier kind counts. The group of a secret or
# IBAN is the value. Of cards, IBANs and phones with '+' also parts of a find are tried, see _SPANS.
_HEAD = r"(?<![\w.+-])"
KINDS: list[tuple[str, str, re.Pattern]] = [
    ("email", "@", re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])")),
    ("secret", "=", re.compile(r"(?i)(?:password|passwd|secret|token|api[_-]?key)\s*=\s*\"?([A-Za-z0-9+/_-]{8,})")),
    ("secret", ":", re.compile(r"(?i)\b(?:password|passwd|secret|token|api[_-]?key)\s*:\s*\"?((?=\S*\d)[A-Za-z0-9+/_-]{8,})")),
    ("secret", "AKIA", re.compile(r"\bAKIA([0-9A-Z]{16})\b")),
    ("iban", "", re.compile(_HEAD + r"(?=([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)))")),
    ("card", "", re.compile(r"(?<!\d)(?<!\d[ -])(?=(?:\d[ -]?){12}\d)\d+(?:[ -]\d+)*")),
    ("ip", "", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)")),
    ("ssn", "", re.compile(_HEAD + r"\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("phone", "+", re.compile(r"(?<![\w.+])\+[1-9]\d{0,14}(?:[ .-]?\(\d{1,5}\))?(?:[ .-]?\d{1,14}){0,8}(?!\w)")),
    ("phone", "", re.compile(r"(?<![\w.])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)(?![.-]\d)")),
    ("date", "", re.compile(_HEAD + r"(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?:(?=[Tt]\d\d(?::?\d\d|(?!\w)))|(?!\w|[-/.]\d))")),
]
# Length of IBANs by country.
_IBAN_LENGTH = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for c in cs.split()}
# Numbers of digits of cards by their first digit.
_CARD_LENGTH = {"2": (16,), "3": (14, 15, 16), "4": (13, 16, 19), "5": (16,), "6": (16, 17, 18, 19)}


def _card_spans(text: str, lo: int, hi: int) -> list[tuple[int, int]]:
    """Every stretch of whole groups of a run of digits that can be a card number, the likeliest
    first: 13 to 19 digits as cards are written (one group; groups of four, the last may be
    shorter; four-six-four or -five), or the whole run in other groups, all divided
    alike, with a card's first digit and length. A number beside the card is a group of its own."""
    groups = [m.span() for m in re.compile(r"\d+").finditer(text, lo, hi)]
    found = []
    for i, (start, _) in enumerate(groups):
        if start and (text[start - 1] in ".+_" or text[start - 1].isalnum()):
            continue
        sizes, n = [], 0
        for a, end in groups[i:i + 19]:
            sizes.append(end - a)
            n += end - a
            if n > 19:
                break
            if n < 13 or end < len(text) and (text[end] == "_" or text[end].isalnum()):
                continue
            likely = n in _CARD_LENGTH.get(text[start], ())
            usual = len(sizes) == 1 or sizes in ([4, 6, 4], [4, 6, 5]) or (set(sizes[:-1]) == {4} and sizes[-1] <= 4)
            if usual or (likely and (start, end) == (lo, hi) and len(set(re.findall(r"[ -]", text[lo:hi]))) == 1):
                found.append((not likely, not usual, n != 16, -n, start, end))
    return [f[4:] for f in sorted(found)]


def _iban_spans(text: str, lo: int, hi: int) -> list[tuple[int, int]]:
    """Beginnings that end with a word: of the country's length, else the whole find; for an
    unknown country the longest first."""
    ends = [e for e in range(hi, lo + 14, -1) if e == hi or (text[e] == " " and text[e - 1] != " ")]
    want = _IBAN_LENGTH.get(text[lo:lo + 2])
    if want:
        ends = [e for e in ends if len(text[lo:e].replace(" ", "")) == want] + [hi]
    return [(lo, e) for e in ends]


def _phone_spans(text: str, lo: int, hi: int) -> list[tuple[int, int]]:
    """Beginnings that end with a group, of more than one digit if possible, the longest first;
    only numbers with '+' can be taken too long."""
    if text[lo] != "+":
        return [(lo, hi)]
    ends = [e for e in range(hi, lo + 7, -1) if text[e - 1].isdigit() and (e == len(text) or not text[e].isalnum())]
    return [(lo, e) for e in sorted(ends, key=lambda e: text[e - 2] == " ")]


_SPANS = {"card": _card_spans, "iban": _iban_spans, "phone": _phone_spans}
_DIGIT = re.compile("[0-9]")


def find(text: str, names: Pseudonyms) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the validated values of a text, in order, none
    overlapping."""
    digit, out = _DIGIT.search(text) is not None, []
    taken: list[tuple[int, int]] = []
    for kind, hint, pattern in KINDS:
        if (hint and hint not in text) or (not hint and not digit):
            continue
        for m in pattern.finditer(text):
            whole = m.span(1) if kind in ("secret", "iban") else m.span()
            for lo, hi in _SPANS[kind](text, *whole) if kind in _SPANS else [whole]:
                at = bisect(taken, (lo, hi))  # disjoint and sorted: only the two beside it can overlap
                if (at and taken[at - 1][1] > lo) or (at < len(taken) and taken[at][0] < hi):
                    continue
                new = getattr(names, kind)(text[lo:hi])
                if new is not None:
                    taken.insert(at, (lo, hi))
                    out.append((lo, hi, kind, new))
    return sorted(out)


def pseudonymise(docs: DataFrame, key: bytes = DEMO_KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text with every value replaced, n_found, spans (start,
    end, kind; code points, the same in both texts, as a pseudonym has its value's length
    -- but an IPv4 address, whose parts may get shorter or longer: spans are of the
    original text).

    Texts without a validated value come back as they are; a null text stays null, a very long one is
    searched whole. Equal values get equal pseudonyms over all rows, a day in every numeric
    layout; of overlapping finds the earlier kind counts. Empty table: empty result. Other columns
    are not read. No shuffle."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for b in batches:
            texts, spans = [], []
            for text in b.column(1).to_pylist():
                found = find(text, names) if text else []
                parts, at = [], 0
                for lo, hi, _, new in found:
                    parts += [text[at:lo], new]
                    at = hi
                texts.append("".join(parts) + text[at:] if found else text)
                spans.append([{"start": lo, "end": hi, "kind": kind} for lo, hi, kind, _ in found])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()), pa.array([len(s) for s in spans], pa.int64()),
                 pa.array(spans, pa.list_(span))], names=["doc_id", "text", "n_found", "spans"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, text string, n_found bigint, "
                                "spans array<struct<start: int, end: int, kind: string>>")
