"""PII: format-preserving pseudonyms by a keyed Feistel permutation.

A value is validated (cards by the Luhn sum, IBANs modulo 97, addresses by their
octets, dates by the calendar) and permuted within its format: digits stay
digits, letters letters, hex digits hex digits, separators and case stay, check
digits are made anew, dates stay dates of the calendar (read day first, month first
where that is no day; months may be English names), addresses addresses.
The permutation depends on the key and the kind alone, so equal values get equal
pseudonyms in every document and different values different ones, with no table
to join or keep. Numbers that fail validation aren't personal data and stay.

The Feistel network works on a pair of numbers, the value's two halves in the
mixed radix of its characters; each round adds a keyed hash of one half to the
other, modulo that half's range, which is a permutation whatever the ranges.
Calendars aren't a product of two ranges, so dates walk the cycle until they
fall on a day.

One pass over the table without a shuffle; a text without digits and @ passes
untouched.

Defined cases: a null text stays null; a value within a longer run of letters or
digits isn't one; repeated rows give repeated results; a null doc_id stays null;
an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROUNDS = 8
DEFAULT_KEY = b"tierwise-sample-key"     # for tests and samples; production passes its own
KINDS = ("email", "secret", "iban", "phone", "ip", "date", "ssn", "card")
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
_DIGIT, _HEX, _LOWER, _UPPER = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_MONTHS = ("january february march april may june july august september october november december".split())
_SHORT = {m[:3]: i for i, m in enumerate(_MONTHS, 1)}
# lengths of the IBANs of the registry
_IBAN_LENGTH = {c: int(n) for n, cs in (x.split(":") for x in """
15:NO 16:BE 18:DK,FI,FO,GL,NL,SD,FK 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV
22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG
25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV
29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU""".split()) for c in cs.split(",")}

_FIND = re.compile(r"""
  (?P<email>(?<![\w.%+-])[\w%+-]+(?:\.[\w%+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)
| (?P<secret>\b(?:token|secret|password|passwd|api[_-]?key|key)\s*[=:]\s*["'](?P<hidden>[0-9A-Fa-f]{16,})["'])
| (?P<iban>\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b)
| (?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w))
| (?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))
| (?P<date>(?<![\w./-])(?:\d{4}(?P<ymd>[-/.])\d{1,2}(?P=ymd)\d{1,2}|\d{1,2}(?P<dmy>[-/.])\d{1,2}(?P=dmy)\d{4})
    (?:(?=[Tt]\d{2}|Z\b)|(?![\w/-]|\.\d))
  | (?<![\w./-])\d{1,2}(?:st|nd|rd|th)?[ ](?:of[ ])?(?:MONTH)[.]?,?[ ]\d{4}(?![\w/-]|\.\d)
  | \b(?:MONTH)[.]?[ ]\d{1,2}(?:st|nd|rd|th)?,?[ ]\d{4}(?![\w/-]|\.\d))
| (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
| (?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d))
""".replace("MONTH", "(?i:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in _MONTHS) + "|sept)"), re.X)
_MAY = re.compile(r"[0-9@]")


class Feistel:
    """Keyed permutations of pairs, texts and ranges."""

    def __init__(self, key: bytes, kind: str):
        self.key, self.kind = hashlib.blake2b(key, digest_size=32).digest(), kind.encode()

    def _add(self, i: int, sizes: tuple[int, int], half: int, modulus: int) -> int:
        data = b"%s|%d|%d|%d|%d" % (self.kind, i, *sizes, half)
        size = (modulus.bit_length() + 7) // 8 + 8          # 64 spare bits: the sum modulo a range is nearly even
        out = b"".join(hashlib.blake2b(data + b"|%d" % j, key=self.key).digest() for j in range(-(-size // 64)))
        return int.from_bytes(out[:size], "big") % modulus

    def pair(self, a: int, b: int, sizes: tuple[int, int]) -> tuple[int, int]:
        for i in range(ROUNDS):
            if i % 2:
                b = (b + self._add(i, sizes, a, sizes[1])) % sizes[1]
            else:
                a = (a + self._add(i, sizes, b, sizes[0])) % sizes[0]
        return a, b

    def digits(self, values: list[int], radices: list[int]) -> list[int]:
        """A mixed-radix number, as its digits."""
        half = (len(values) + 1) // 2
        number, sizes = [0, 0], [1, 1]
        for i, (v, r) in enumerate(zip(values, radices)):
            s = int(i >= half)
            number[s], sizes[s] = number[s] * r + v, sizes[s] * r
        number = list(self.pair(*number, tuple(sizes)))
        out = [0] * len(values)
        for i in range(len(values) - 1, -1, -1):
            s = int(i >= half)
            number[s], out[i] = divmod(number[s], radices[i])
        return out

    def text(self, value: str, alphabet_of: Callable[[str], str | None]) -> str:
        """The characters that have an alphabet, permuted within it."""
        alphabets = [alphabet_of(c) for c in value]
        at = [i for i, a in enumerate(alphabets) if a]
        new = self.digits([alphabets[i].index(value[i]) for i in at], [len(alphabets[i]) for i in at])
        out = list(value)
        for i, v in zip(at, new):
            out[i] = alphabets[i][v]
        return "".join(out)

    def number(self, value: int, size: int) -> int:
        """A permutation of range(size), by walking the cycle of a larger one."""
        side = int(size ** 0.5) + 1
        while True:
            a, b = self.pair(*divmod(value, side), (side, side))
            value = a * side + b
            if value < size:
                return value


def _alphabet(c: str) -> str | None:
    return next((a for a in (_DIGIT, _LOWER, _UPPER) if c in a), None)


def _digit(c: str) -> str | None:
    return _DIGIT if c in _DIGIT else None


def _hex(c: str) -> str | None:
    return _HEX if c in _HEX else _HEX.upper() if c in _HEX.upper() else None


def luhn_digit(digits: str) -> str:
    """The check digit that makes digits + check pass."""
    total = sum(v if i % 2 else (2 * v if v < 5 else 2 * v - 9) for i, v in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


def _iban_mod(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _spread(shown: str, plain: str) -> str:
    """plain's characters in the places of shown's letters and digits."""
    it = iter(plain)
    return "".join(next(it) if c.isalnum() else c for c in shown)


def _email(f: Feistel, v: str) -> str:
    local, domain = v.split("@")
    if local.isascii():
        return f"{f.text(local, _alphabet)}@{domain}"
    # letters beyond ASCII have no alphabet to permute in: a keyed hash of the whole, in ASCII letters
    h = hashlib.blake2b(v.encode(), key=f.key).hexdigest() * (1 + len(local) // 64)
    return "".join(c if c in "._%+-" else _DIGIT[int(x, 16) % 10] if c in _DIGIT else _LOWER[int(x, 16)]
                   for c, x in zip(local, h)) + f"@{domain}"


def _iban_end(v: str) -> int | None:
    """The length of the IBAN that v starts with: a word that follows may look like a group of it."""
    ends = [i for i in range(len(v), 0, -1) if v[i - 1] != " " and (i == len(v) or v[i] == " ")]
    known = _IBAN_LENGTH.get(v[:2])
    if known:
        ends = [i for i in ends if len(v[:i].replace(" ", "")) == known] or ends[:1]
    return next((i for i in ends if len(p := v[:i].replace(" ", "")) >= 12 and _iban_mod(p) == 1), None)


def _iban(f: Feistel, v: str) -> str | None:
    plain = v.replace(" ", "")
    if _iban_mod(plain) != 1:
        return None
    body = f.text(plain[4:], _alphabet)
    return _spread(v, plain[:2] + f"{98 - _iban_mod(plain[:2] + '00' + body):02d}" + body)


def _ip(f: Feistel, v: str) -> str | None:
    octets = [int(o) for o in v.split(".")]
    return None if max(octets) > 255 else ".".join(map(str, f.digits(octets, [256] * 4)))


def _national(f: Feistel, v: str) -> str:
    """A phone number's last ten digits, permuted; a country code stays."""
    places = [i for i, c in enumerate(v) if c in _DIGIT][-10:]
    new = f.digits([int(v[i]) for i in places], [10] * len(places))
    out = list(v)
    for i, n in zip(places, new):
        out[i] = str(n)
    return "".join(out)


_PART = re.compile(r"\d+(?:st|nd|rd|th)?|[A-Za-z]{3,}")


def _ordinal(d: int) -> str:
    return "th" if 10 < d < 14 else {1: "st", 2: "nd", 3: "rd"}.get(d % 10, "th")


def _date(f: Feistel, v: str) -> str | None:
    """Year first, day first, or month first if day first is no day of the calendar; or with the month's
    name. Written as it was: order, separators, leading zeros, the name's length and case."""
    parts = _PART.findall(v)
    named = [p for p in parts if p.isalpha()]
    numbers = [int(re.match(r"\d+", p)[0]) for p in parts if not p.isalpha()]
    month_first = False
    if named:
        d, y = numbers
        m = _SHORT[named[0][:3].lower()]
    elif len(parts[0]) == 4:
        y, m, d = numbers
    else:
        d, m, y = numbers
        if m > 12 >= d:
            d, m, month_first = m, d, True
    try:
        day = dt.date(y, m, d).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    at = day - FIRST_DAY
    while True:
        at = f.number(at, LAST_DAY - FIRST_DAY + 1)
        new = dt.date.fromordinal(FIRST_DAY + at)
        # month first stays what day first can't be, so that both stay different
        if not month_first or new.day > 12:
            break
    short = any(len(p) == 1 for p in parts) or bool(named) and not any(p.startswith("0") for p in parts)

    def number(n: int) -> str:
        return str(n) if short else f"{n:02d}"

    def of(m: re.Match) -> str:
        p = m[0]
        if p.isalpha():
            name = _MONTHS[new.month - 1]
            name = name[:3] if len(p) < 5 and p.lower() not in _MONTHS else name
            return name.upper() if p.isupper() else name.lower() if p.islower() else name.title()
        if len(p) == 4 and p.isdigit():
            return f"{new.year:04d}"
        return number(next(rest)) + (_ordinal(new.day) if not p.isdigit() else "")

    rest = iter([new.day] if named else [new.month, new.day] if month_first or len(parts[0]) == 4 else [new.day, new.month])
    return _PART.sub(of, v)


def _ssn(f: Feistel, v: str) -> str | None:
    return None if v[:3] in ("000", "666") or v[0] == "9" or v[4:6] == "00" or v[7:] == "0000" else f.text(v, _digit)


def _card(f: Feistel, v: str) -> str | None:
    plain = re.sub(r"\D", "", v)
    if luhn_digit(plain[:-1]) != plain[-1]:
        return None
    body = f.text(plain[:-1], _digit)
    return _spread(v, body + luhn_digit(body))


_MAKE = {"email": _email, "iban": _iban, "phone": _national, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card}


class Pseudonyms:
    """Pseudonyms of whole texts under one key."""

    def __init__(self, key: bytes = DEFAULT_KEY):
        self.feistel = {k: Feistel(key, k) for k in KINDS}

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        found = dict.fromkeys(KINDS, 0)
        if not _MAY.search(text):
            return text, found

        out, done = [], 0
        while m := _FIND.search(text, done):
            out.append(text[done:m.start()])
            kind, shown, done = m.lastgroup, m[0], m.end()
            if m["secret"]:
                kind, a, b = "secret", *(x - m.start() for x in m.span("hidden"))
                new = shown[:a] + self.feistel[kind].text(shown[a:b], _hex) + shown[b:]
            else:
                if kind == "iban" and (end := _iban_end(shown)):
                    shown, done = shown[:end], m.start() + end          # what follows is read again
                new = _MAKE[kind](self.feistel[kind], shown)
            out.append(shown if new is None else new)
            found[kind] += new is not None
        return "".join(out) + text[done:], found


def pseudonymise(docs: DataFrame, key: bytes = DEFAULT_KEY) -> DataFrame:
    """The rows of docs with text pseudonymised, and n_<kind> and n_found values replaced."""
    counts = [f"n_{k}" for k in KINDS] + ["n_found"]
    kept = [c for c in docs.columns if c not in counts]
    fields = [T.StructField(c, T.StringType()) if c == "text" else docs.schema[c] for c in kept]
    schema = T.StructType(fields + [T.StructField(c, T.LongType()) for c in counts])
    at = kept.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for batch in batches:
            texts, n = [], {k: [] for k in KINDS}
            for t in batch.column(at):
                t = t.as_py()
                new, found = (None, dict.fromkeys(KINDS, 0)) if t is None else names.replace(t)
                texts.append(new)
                for k in KINDS:
                    n[k].append(found[k])
            cols = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            total = [sum(x) for x in zip(*n.values())]
            yield pa.RecordBatch.from_arrays([*cols, *(pa.array(v, pa.int64()) for v in n.values()),
                                              pa.array(total, pa.int64())], kept + counts)

    typed = docs.select(*[docs[c].cast("string").alias(c) if c == "text" else docs[c] for c in kept])
    return typed.mapInArrow(rows, schema)
