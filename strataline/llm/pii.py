"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score.

Every pattern is linear in the text: a span can only begin where a run of its characters begins, so no
position is tried twice. Spans are code point offsets, end exclusive.

Defined cases: null text is empty text and has no spans; repeated rows give repeated results; an empty table
gives an empty table; columns other than the named two are ignored by ``detect`` and kept by ``redact``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructField, StructType

from strataline.llm.common import map_rows

# Kinds whose matches always stay, in the order in which spans are listed; the others need a score.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone")

# Score of a proposed span before and after its checks; a span of a scored kind stays from THRESHOLD on.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4, "ssn": 0.3, "local_phone": 0.3}
CONFIRMED = {"ip": 0.1, "card": 0.4, "phone": 0.1, "iban": 0.5}
THRESHOLD = 0.6
CONTEXT_CHARS = 48
CONTEXT_GAIN = 0.35
CONTEXT = {
    "email": ("mail", "contact", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "teléfono", "appeler"),
    "iban": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "ssn": ("ssn", "social"),
    "local_phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "teléfono", "appeler"),
}
# Words that speak against a span, whatever its kind.
AGAINST = ("example", "version", "isbn", "order", "invoice", "serial")

# Account number lengths of the IBAN registry, for all its countries.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
    "YE": 30,
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}")
_IBAN_BODY = re.compile(r"(?: ?[A-Za-z0-9]){1,29}")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_WORD = re.compile(r"\w+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Check digit of payment cards: every second digit from the right counts double."""
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """ISO 7064 check of an account number, letters counting from 10 on."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _confirmed(text: str) -> Iterator[tuple[str, int, int]]:
    """The base spans: proposed by their patterns and passed by their checks."""
    if "@" in text:
        yield from (("email", a, b) for a, b in _emails(text))
    if not _DIGIT.search(text):
        return
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(part := x.lstrip("0")) <= 3 and int(part or 0) <= 255 for x in m[0].split(".")):
                yield "ip", *m.span()
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                yield "phone", *m.span()


def _account_end(text: str, start: int) -> int | None:
    """The end of the account number that starts here, where its country and its checksum confirm it."""
    want = IBAN_LENGTH.get(text[start : start + 2].upper())
    if not want or not (body := _IBAN_BODY.match(text, start + 4)):
        return None
    compact, end = "", start
    for c in text[start : body.end()]:
        if len(compact) == want:
            break
        end += 1
        compact += c.strip()
    # Small letters are those of words as well, so a number that has some must be a word by itself.
    if not compact.isupper() and text[end : end + 1].isalnum():
        return None
    return end if len(compact) == want and mod97(compact.upper()) else None


def _proposed(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Spans of the scored kinds, and whether a checksum confirmed them."""
    if not _DIGIT.search(text):
        return
    # Numbers that overlap all stay, as a token before the number can pass with its first digits by chance.
    for m in _IBAN.finditer(text):
        if end := _account_end(text, m.start()):
            yield "iban", m.start(), end, True
    for m in _SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "ssn", *m.span(), False
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span(), False


def _score(text: str, kind: str, start: int, end: int, checked: bool) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS // 2]
    words = {w.lower() for w in _WORD.findall(near)}
    score = PRIOR[kind] + CONFIRMED.get(kind, 0) * checked
    score += CONTEXT_GAIN * any(w in words for w in CONTEXT[kind])
    score -= CONTEXT_GAIN * any(w in words for w in AGAINST)
    # What a checksum has confirmed stays, whatever the words around it.
    return round(min(1.0, max(THRESHOLD if checked else 0.0, score)), 3)


def spans_of(text: str | None) -> list[Span]:
    """All spans of one text, by kind as listed, then start.

    Scored kinds without a checksum never overlap a base span. A confirmed account number stands beside one, as its
    digits can pass as a card by chance.
    """
    if not text:
        return []
    found = [Span(k, a, b, _score(text, k, a, b, True)) for k, a, b in _confirmed(text)]
    # The furthest end of the base spans up to each one, in order of their starts.
    base = sorted((s.start, s.end) for s in found)
    starts, ends = [a for a, _ in base], list(accumulate((b for _, b in base), max))
    for kind, a, b, checked in _proposed(text):
        before = bisect_left(starts, b)
        if not checked and before and ends[before - 1] > a:
            continue
        if (score := _score(text, kind, a, b, checked)) >= THRESHOLD:
            found.append(Span(kind, a, b, score))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda s: (order[s.kind], s.start))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by the kind of its first one."""
    out, done = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= done:
            out += [text[done : s.start], f"<{s.kind.upper()}>"]
        done = max(done, s.end)
    return "".join([*out, text[done:]])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``spans`` (kind, start, end, score), kinds as listed, then start."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield doc_id, [s._asdict() for s in spans_of(text)]

    spans = ArrayType(StructType.fromDDL("kind string, start int, end int, score double"))
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("spans", spans)])
    return map_rows(docs.select(id_col, text_col), run, schema)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by a mark of its kind; null texts stay null, other columns as they are."""
    at = docs.columns.index(text_col)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for row in rows:
            text = row[at]
            if text and (spans := spans_of(text)):
                row = (*row[:at], masked(text, spans), *row[at + 1 :])
            yield row

    # The type itself, as names of columns and of their fields may be anything.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return map_rows(plain, run, StructType([StructField(f.name, f.dataType) for f in docs.schema]))
