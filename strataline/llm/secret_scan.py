"""Secrets: fixed patterns, and strings that pass a battery of randomness tests.

A candidate is a run of 20 or more characters of ``[A-Za-z0-9+/_-]`` with the one or two ``=`` that end it as
padding; any other ``=`` separates a name from its value. Where it has separators, its parts of 20 or more
characters are candidates too. Every candidate is judged: its encoding is the narrowest alphabet that holds it, the
last of which holds all; then chi-squared uniformity over the alphabet, a runs test, a lag-one serial correlation
test and, for letters of one case, a test of how common the letters are in prose give p-values under "the symbols
are random", which Fisher's method combines.

Whether a candidate is reported is a matter of false discoveries. Its symbols have a probability if they are random,
and one if they are words or identifiers (``WORD_*``: how classes of symbols, vowels and consonants follow each other,
and how common letters are); the battery's p-value is uniform in the first case and low in the second. With the
prior odds ``WORD_ODDS`` these give the local false-discovery rate, the probability that the candidate is a word, and
it is reported if that is at most ``rate``. Evidence adds up over the symbols, so the control is as strict for short
strings as for long ones, and it follows from the candidate alone: no other text of the corpus has a say. Of
nested candidates that are reported the longest stays. ``false_shares`` sums the rates up.

Defined cases: null text is empty and has no spans; an empty table gives an empty table; repeated rows give repeated
results.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.common import map_rows

BASE_KINDS = ("assign", "access", "hex")
KIND = "random"
MIN_CHARS = 20
# The largest local false-discovery rate that is reported.
RATE = 0.05

_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]++)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?")

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Alphabets from the narrowest to the widest; a candidate belongs to the first that has all its symbols. The last
# one has every symbol that a candidate can have.
ALPHABETS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "UPPER": _UPPER,
    "base32": _UPPER + "234567",
    "letters": _UPPER + _LOWER,
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "joint": _UPPER + _LOWER + _DIGITS + "+/-_",
}
# Alphabets whose strings can be words: letters of one case.
WORDLIKE = ("lower", "UPPER")
# How often each letter occurs in a thousand letters of European prose.
LETTERS = dict(zip(
    _LOWER, (80, 16, 30, 42, 140, 16, 19, 32, 74, 3, 8, 44, 27, 80, 57, 22, 5, 68, 71, 70, 35, 12, 10, 3, 9, 7), strict=True
))
_CUTS = tuple(re.compile(f"[{x}]+") for x in ("/+", "_-", "/+_-"))
_INDEX = {name: {c: i for i, c in enumerate(symbols)} for name, symbols in ALPHABETS.items()}
_SYMBOLS = {name: frozenset(symbols) for name, symbols in ALPHABETS.items()}


def encoding_of(token: str) -> str:
    """The narrowest alphabet that holds every symbol of the token, padding aside."""
    used = set(token.rstrip("="))
    return next(name for name, symbols in _SYMBOLS.items() if used <= symbols)


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail of the chi-squared distribution (Wilson and Hilferty's normal approximation)."""
    if x <= 0:
        return 1.0
    return _normal_tail(((x / df) ** (1 / 3) - 1 + 2 / (9 * df)) / math.sqrt(2 / (9 * df)))


def uniformity_p(values: list[int], size: int) -> float:
    """Chi-squared test of equal use of the alphabet, in as many equal cells as give four symbols to a cell."""
    cells = max(2, min(size, len(values) // 4))
    count = [0] * cells
    for v in values:
        count[v * cells // size] += 1
    # Cells of unequal width when the alphabet is no multiple of their number.
    width = [0] * cells
    for v in range(size):
        width[v * cells // size] += 1
    want = [len(values) * w / size for w in width]
    return _chi2_tail(sum((c - e) ** 2 / e for c, e in zip(count, want, strict=True)), cells - 1)


def runs_p(values: list[int], size: int) -> float:
    """Two-sided test of the number of runs in the lower and the upper half of the alphabet."""
    high = [v >= size // 2 for v in values]
    n, ones = len(high), sum(high)
    zeros = n - ones
    if not ones or not zeros:
        return 2.0 ** (1 - n)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    mean = 2 * ones * zeros / n + 1
    spread = math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
    return min(1.0, 2 * _normal_tail(max(0.0, abs(runs - mean) - 0.5) / spread))


def serial_p(values: list[int]) -> float:
    """Two-sided test of the correlation between neighbours."""
    n = len(values)
    mean = sum(values) / n
    spread = sum((v - mean) ** 2 for v in values)
    if not spread:
        return 2.0 ** (1 - n)
    r = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:], strict=False)) / spread
    return min(1.0, 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n)))


_WEIGHT = [math.log(n) for n in LETTERS.values()]
_WEIGHT_MEAN = sum(_WEIGHT) / len(_WEIGHT)
_WEIGHT_SPREAD = math.sqrt(sum((w - _WEIGHT_MEAN) ** 2 for w in _WEIGHT) / len(_WEIGHT))


def prose_p(values: list[int]) -> float:
    """One-sided test of the logarithms of the letters' frequencies in prose, whose mean is known for random letters."""
    over = sum(_WEIGHT[v] for v in values) / len(values) - _WEIGHT_MEAN
    return _normal_tail(over / _WEIGHT_SPREAD * math.sqrt(len(values)))


def randomness_p(token: str, encoding: str) -> float:
    """Fisher's combination of the battery's p-values; strings that can be words have one test more."""
    index = _INDEX[encoding]
    values = [index[c] for c in token.rstrip("=")]
    size = len(index)
    ps = [uniformity_p(values, size), runs_p(values, size), serial_p(values)]
    if encoding in WORDLIKE:
        ps.append(prose_p(values))
    return _chi2_tail(-2 * sum(math.log(max(p, 1e-300)) for p in ps), 2 * len(ps))


# Parameters of words and identifiers, chosen by hand from the usual ways to write names. Odds against a random string
# before it is looked at; which class of symbol follows which (small letter, capital, digit, separator); how often a
# vowel follows a vowel, a consonant, or neither; how the separators share their class; how often names are in capitals.
WORD_ODDS = 99.0
WORD_CLASSES = {
    "": {"l": 0.55, "u": 0.35, "d": 0.08, "s": 0.02},
    "l": {"l": 0.86, "u": 0.07, "d": 0.02, "s": 0.05},
    "u": {"l": 0.70, "u": 0.25, "d": 0.02, "s": 0.03},
    "d": {"l": 0.15, "u": 0.10, "d": 0.60, "s": 0.15},
    "s": {"l": 0.60, "u": 0.25, "d": 0.13, "s": 0.02},
}
WORD_CAPITALS = 0.2
WORD_VOWELS = {"v": 0.20, "c": 0.52, "": 0.40}
WORD_SEPARATORS = {"_": 0.60, "-": 0.30, "/": 0.08, "+": 0.02}
# A word's battery has p-values p with the density a * p ** (a - 1), where a is this over its length, within bounds.
WORD_EVENNESS, WORD_EVENNESS_BOUNDS = 6.0, (0.05, 0.5)

_VOWELS = frozenset("aeiou")
_SHARE = {
    kind: sum(n for c, n in LETTERS.items() if (c in _VOWELS) == (kind == "v")) for kind in "vc"
}
_CLASS = {c: k for k, symbols in (("l", _LOWER), ("u", _UPPER), ("d", _DIGITS), ("s", "_-/+")) for c in symbols}


def word_evidence(core: str, encoding: str) -> float:
    """Logarithm of how much likelier the symbols are as words than as random symbols of the encoding.

    Words in capitals are words whose cases have changed places.
    """
    as_written = _word_probability(core) + math.log(1 - WORD_CAPITALS)
    in_capitals = _word_probability(core.swapcase()) + math.log(WORD_CAPITALS)
    return max(as_written, in_capitals) + len(core) * math.log(len(ALPHABETS[encoding]))


def _word_probability(core: str) -> float:
    total, before, vowel = 0.0, "", ""
    for c in core:
        kind = _CLASS[c]
        total += math.log(WORD_CLASSES[before][kind])
        if kind in "lu":
            letter = c.lower()
            now = "v" if letter in _VOWELS else "c"
            follows = WORD_VOWELS[vowel]
            total += math.log((follows if now == "v" else 1 - follows) * LETTERS[letter] / _SHARE[now])
            vowel = now
        else:
            total += math.log(0.1 if kind == "d" else WORD_SEPARATORS[c])
            vowel = ""
        before = kind
    return total


def false_discovery_rate(token: str, encoding: str) -> float:
    """Probability that a token is a word or an identifier, given its symbols and its battery."""
    core = token.rstrip("=")
    low, high = WORD_EVENNESS_BOUNDS
    a = min(high, max(low, WORD_EVENNESS / len(core)))
    p = max(randomness_p(token, encoding), 1e-300)
    odds = math.log(WORD_ODDS) + word_evidence(core, encoding) + math.log(a) + (a - 1) * math.log(p)
    return 1 / (1 + math.exp(-min(700.0, max(-700.0, odds))))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start, then kind as listed."""
    found = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(x in low for x in ("passw", "secret", "token", "api")):
            found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    order = {k: i for i, k in enumerate(BASE_KINDS)}
    return sorted(found, key=lambda s: (s[1], order[s[0]]))


def pieces(token: str) -> Iterator[tuple[int, int]]:
    """Start and end of a token and of its long parts between separators, each with the padding that ends it.

    A key may have separators of its own and may stand after a path or a prefix that has others, so the token is
    cut at ``/+``, at ``_-`` and at all four. Longer pieces come first.
    """
    core = len(token.rstrip("="))
    found = {(0, len(token))}
    for cut in _CUTS:
        start = 0
        for a, b in (*(m.span() for m in cut.finditer(token, 0, core)), (core, core)):
            if a - start >= MIN_CHARS:
                found.add((start, len(token) if a == core else a))
            start = b
    yield from sorted(found, key=lambda x: (x[0] - x[1], x[0]))


def candidates(text: str) -> Iterator[tuple[int, int, str, float]]:
    """Start, end, encoding and false-discovery rate of each string that is judged, a token before its parts."""
    if not any(len(w) >= MIN_CHARS for w in text.split()):
        return
    for m in _CANDIDATE.finditer(text):
        for a, b in pieces(m[0]):
            part = m[0][a:b]
            encoding = encoding_of(part)
            yield m.start() + a, m.start() + b, encoding, false_discovery_rate(part, encoding)


def unfixed(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, str, float]]:
    """The candidates that no span of a fixed pattern overlaps."""
    if not base:
        yield from candidates(text)
        return
    # The furthest end of the spans up to each one, which are sorted by start.
    starts, ends = [a for _, a, _ in base], list(accumulate((b for *_, b in base), max))
    for c in candidates(text):
        before = bisect_left(starts, c[1])
        if not before or ends[before - 1] <= c[0]:
            yield c


def random_spans(text: str, base: list[tuple[str, int, int]], rate: float = RATE) -> list[tuple[str, int, int]]:
    """The candidates that are reported, without those that lie in a longer one, by start."""
    passed = sorted({c[:2] for c in unfixed(text, base) if c[3] <= rate}, key=lambda c: (c[0], -c[1]))
    out, reached = [], -1
    for a, b in passed:
        if b > reached:
            out.append((KIND, a, b))
            reached = b
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans`` (kind, start, end), by start, then kind.

    Each text is judged by itself, in one pass.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    order = {k: i for i, k in enumerate((*BASE_KINDS, KIND))}

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            text = text or ""
            base = base_spans(text)
            found = sorted(base + random_spans(text, base, rate), key=lambda s: (s[1], order[s[0]], s[2]))
            yield doc_id, [dict(zip(("kind", "start", "end"), s, strict=True)) for s in found]

    return map_rows(
        docs.select(id_col, text_col), run, f"{id_col} {kind}, spans array<struct<kind:string,start:int,end:int>>"
    )


def false_shares(docs: DataFrame, text_col: str = "text", rate: float = RATE) -> DataFrame:
    """One row per encoding and power of two of the length: candidates, how many are reported, and the share of words
    that is expected among these, the mean of their rates. A token and its parts count each.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (text,) in rows:
            text = text or ""
            for a, b, encoding, found in unfixed(text, base_spans(text)):
                yield encoding, (b - a).bit_length(), int(found <= rate), found if found <= rate else 0.0

    judged = map_rows(docs.select(text_col), run, "encoding string, stratum int, passed long, rate double")
    counted = judged.groupBy("encoding", "stratum").agg(
        F.count("*").alias("candidates"), F.sum("passed").alias("passed"), F.sum("rate").alias("rates")
    )
    share = F.when(F.col("passed") > 0, F.col("rates") / F.col("passed"))
    return counted.select("encoding", "stratum", "candidates", "passed", share.alias("false_share"))
