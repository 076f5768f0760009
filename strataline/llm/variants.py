"""Spelling variants: words one edit apart, found by pivotal grams.

Words are counted in the tasks that read the texts and added up by Spark. A word's bigrams are ordered by how many
words hold them, rare ones first; its prefix is its first ``2 * edits + 1`` grams with those that tie with the last of
them. Among the prefix, dynamic programming chooses ``edits + 1`` grams that don't overlap and are rarest together:
the pivots. One edit spoils at most one of two disjoint grams. Hence of two words one edit apart, the one whose
prefix ends earlier in the order has a pivot that is in the other's prefix, at the same place from the start or from
the end, and pivots are looked up in the other words' prefixes only.

Place limits are used to the full: a pivot to the left of the edit has everything before it unchanged, one to the
right of it everything behind it. With two pivots, the first one is untouched with all to its left, or the second one with
all to its right. What is left over on the other side holds the edit in one of its two halves, so the other half is
part of the key as well. Keys are 64-bit hashes of these parts; candidates are verified by their edit distance as
the join makes them.

A form is more frequent than its word by a factor, so chains of forms are short, and doubling finds their ends.

Defined cases: null or empty texts have no words; a null id counts as an empty one; repeated rows count as often as
they occur; a word without near words is its own root; no words give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import islice, pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from strataline.llm.common import map_rows
from strataline.session import stage

LEAST_POINTS = 7
GRAM = 2
EDITS = 1
# Places of one gram that pivots are chosen from: a rarer pivot overlaps two of them at most.
OCCURRENCES = 3
# Damage dealt to a run: one code point goes where this number divides the hash.
DAMAGE = 31
# Words counted together in a task before the counts are handed on.
COUNTED = 300_000

# Letters are single bytes of Latin-1, and anything else becomes a question mark there.
_RUN = re.compile(rb"[a-z\xC0-\xFF]+")


def occurrence(run: bytes, seed: int) -> bytes:
    """A lower-cased run in Latin-1 as it counts: whole, or without one code point. ``seed`` is the checksum of the id."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_POINTS, seen: int = 2) -> DataFrame:
    """(word, n): words of at least ``least`` code points with at least ``seen`` occurrences."""
    # A run loses one code point at most, so shorter runs make no word.
    long_run = re.compile(_RUN.pattern[:-1] + b"{%d,}" % least)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: Counter[bytes] = Counter()
        for doc_id, text in rows:
            if not text:
                continue
            seed = zlib.crc32(f"{doc_id or ''}:".encode())
            for found, n in Counter(long_run.findall(text.encode("latin-1", "replace").lower())).items():
                word = occurrence(found, seed)
                if len(word) >= least:
                    held[word] += n
            if len(held) > COUNTED:
                yield from ((w.decode("latin-1"), n) for w, n in held.items())
                held.clear()
        yield from ((w.decode("latin-1"), n) for w, n in held.items())

    made = map_rows(docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")), run, "word string, n long", batch_rows=20_000)
    return made.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= seen)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram occurs in the words. Letters are 90 code points, so there are at most 8100 of them."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: Counter[str] = Counter()
        for (word,) in rows:
            held.update(map("".join, pairwise(word)))
        yield from held.items()

    made = map_rows(words.select("word"), run, "gram string, n long")
    return {r["gram"]: r["n"] for r in made.groupBy("gram").agg(F.sum("n").alias("n")).collect()}


def prefix(word: str, rank: dict[str, int], edits: int = EDITS) -> tuple[int, list[int], list[int]]:
    """The rank of the prefix's last gram, the prefix's places, and those among which pivots are chosen; ascending.

    Of a gram that a word repeats over and over the first places do. The choice of pivots takes the leftmost of equal
    ones and needs ``OCCURRENCES`` places at most; an edit makes or spoils at most ``GRAM`` grams, so a near word has
    the pivot's gram among that many more.
    """
    ranks = [rank[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    last = heapq.nsmallest(GRAM * edits + 1, ranks)[-1]
    fewer = [i for i, r in enumerate(ranks) if r < last]
    ties = list(islice((i for i, r in enumerate(ranks) if r == last), OCCURRENCES + GRAM * edits))
    return last, sorted(fewer + ties), sorted(fewer + ties[:OCCURRENCES])


def pivots(places: Sequence[int], cost: Sequence[int], edits: int = EDITS) -> list[int]:
    """The ``edits + 1`` places of disjoint grams with the least total cost, the leftmost of equal choices.

    ``best[j]`` holds the cheapest choice of j grams among the places seen so far that end before the next one can
    begin; a place extends the choices whose last gram it doesn't overlap.
    """
    wanted = edits + 1
    ends: list[list[tuple[int, list[int]] | None]] = []  # per place: the cheapest choice of j grams up to it
    for at, (place, price) in enumerate(zip(places, cost, strict=True)):
        free = at - 1
        while free >= 0 and places[free] + GRAM > place:
            free -= 1
        row: list[tuple[int, list[int]] | None] = [(0, [])]
        for j in range(1, wanted + 1):
            skipped = ends[at - 1][j] if at else None
            before = ends[free][j - 1] if free >= 0 else (row[0] if j == 1 else None)
            taken = (before[0] + price, [*before[1], place]) if before else None
            row.append(min((c for c in (skipped, taken) if c), default=None))
        ends.append(row)
    return ends[-1][wanted][1]


def _key(*parts: object) -> int:
    h = xxh64_intdigest("\0".join(map(str, parts)))
    return h - (1 << 64) if h >> 63 else h


def _halves(rest: str, length: int, side: str) -> Iterator[tuple]:
    """Keys' ends for a rest of a word, if the two words' rests are cut as one of ``length`` code points is.

    The edit lies in the first or in the second half, so the other half is the same, counted from its own end.
    """
    cut = length // 2
    if cut <= len(rest):
        yield side, length, "first", rest[:cut]
    tail = length - cut
    if tail <= len(rest):
        yield side, length, "second", rest[len(rest) - tail :]


def _sides(word: str, left: Sequence[int], right: Sequence[int]) -> Iterator[tuple[str, str, str]]:
    """The unchanged part and the rest of a word, for grams with all to their left, and with all to their right."""
    for at in left:
        yield "left", word[: at + GRAM], word[at + GRAM :]
    for at in right:
        yield "right", word[at:], word[:at]


def index_keys(word: str, places: Sequence[int]) -> set[int]:
    """Keys under which a word is found by its prefix; its rests are cut by their own length."""
    return {
        _key(same, *end)
        for side, same, rest in _sides(word, places, places)
        for end in _halves(rest, len(rest), side)
    }


def probe_keys(word: str, chosen: Sequence[int], edits: int = EDITS) -> set[int]:
    """Keys by which a word looks for others through its pivots; the others' rests may be longer or shorter."""
    return {
        _key(same, *end)
        for side, same, rest in _sides(word, chosen[:1], chosen[-1:])
        for length in range(max(0, len(rest) - edits), len(rest) + edits + 1)
        for end in _halves(rest, length, side)
    }


def near_pairs(words: DataFrame) -> DataFrame:
    """(u, n_u, v, n_v), once for each two words (word, n) that are one edit apart."""
    counts = gram_counts(words)
    order = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
    table = words.sparkSession.sparkContext.broadcast((order, counts))

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        rank, cost = table.value
        for word, n in rows:
            last, places, choice = prefix(word, rank)
            chosen = pivots(choice, [cost[word[i : i + GRAM]] for i in choice])
            for key in index_keys(word, places):
                yield key, False, last, word, n
            for key in probe_keys(word, chosen):
                yield key, True, last, word, n

    made = stage(map_rows(words.select("word", "n"), run, "key long, probe boolean, last int, word string, n long", batch_rows=50_000), "grams")
    probe, index = (
        made.filter("probe" if which == "u" else "not probe").select(
            F.col("key").alias(f"key_{which}"), *[F.col(c).alias(f"{c}_{which}") for c in ("last", "word", "n")]
        )
        for which in "uv"
    )
    close = (
        (F.col("key_u") == F.col("key_v"))
        & (F.col("last_u") <= F.col("last_v"))
        & (F.col("word_u") != F.col("word_v"))
        & F.levenshtein("word_u", "word_v", EDITS).between(0, EDITS)
    )
    found = probe.join(index, close).select("word_u", "n_u", "word_v", "n_v")
    # A pair may be found by several keys, and both ways round where prefixes end with one gram.
    lower = F.col("word_u") < F.col("word_v")
    either = [F.when(lower, F.col(f"{c}_u")).otherwise(F.col(f"{c}_v")) for c in ("word", "n")]
    other = [F.when(lower, F.col(f"{c}_v")).otherwise(F.col(f"{c}_u")) for c in ("word", "n")]
    return found.select(
        either[0].alias("u"), either[1].alias("n_u"), other[0].alias("v"), other[1].alias("n_v")
    ).distinct()


def forms(words: DataFrame, pairs: DataFrame, factor: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest n, if it is ``factor`` times as frequent."""
    directed = pairs.select(F.col("u").alias("word"), F.lit(None).cast("long").alias("n"), F.struct((-F.col("n_v")).alias("less"), F.col("v").alias("form")).alias("near"))
    directed = directed.union(pairs.select("v", F.lit(None).cast("long"), F.struct((-F.col("n_u")).alias("less"), F.col("u").alias("form"))))
    both = directed.unionByName(words.select("word", "n"), allowMissingColumns=True)
    # Strings compare by their UTF-8 bytes, which is the order of code points.
    known = both.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), F.min("near").alias("near"))
    often = -F.col("near.less") >= factor * F.col("n")
    return known.select(
        "word",
        "n",
        "n_near",
        F.when(often, F.col("near.form")).alias("form"),
        F.when(often, -F.col("near.less")).alias("form_n"),
    )


def rooted(found: DataFrame) -> DataFrame:
    """Adds ``root``, the end of each word's chain of forms."""
    found = stage(found, "forms")
    links = found.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        # Every round doubles the steps that are behind a word; n grows tenfold with a step, so rounds are few.
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stage(links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "chains")
        links = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            break
    return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the documents."""
    words = stage(count_words(docs, id_col, text_col), "words")
    return rooted(forms(words, near_pairs(words)))
