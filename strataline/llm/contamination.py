"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items reads every text once.

Text is normalised to its words: A-Z is lower-cased, and words are runs of digits, letters and anything beyond ASCII.
A window is ``size`` consecutive words of an item; an item of fewer words is one window. The automaton holds every
window with a space on either side, so a match begins and ends with a word; matches are carried back to words, and
words to code points of the original text.

The automaton is broadcast as the items' words and built once by each Python worker. It holds at most ``max_words``
words of the benchmark. A larger benchmark is cut into chunks that overlap by ``size - 1`` words, so that no window
is lost, and chunks are dealt to shards by hash; each shard reads the texts once, and what they found is merged per
text. Nothing is left out either way.

Defined cases: a null or empty text has no words and is never hit; a null or empty item has no window; rows with one
item id are one item; an item without an id hits but is neither counted nor listed; repeated documents are judged
one by one; empty tables give no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.llm.common import map_rows
from strataline.session import stage

SIZE = 10
# Words of items in one automaton: about 60 nodes for each, so some 200 MB in a worker.
MAX_WORDS = 50_000
# Words of an item that stay together when items are cut.
CHUNK_WORDS = 1000

# Bytes of UTF-8 to bytes of words and spaces.
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_NORMAL = bytes.maketrans(_SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B)))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ITEMS = T.ArrayType(T.StringType())


def words_of(text: str | None) -> list[bytes]:
    """Normalised words, as UTF-8."""
    return (text or "").encode().translate(_NORMAL).split()


def chunks(words: list[bytes], size: int, longest: int = CHUNK_WORDS) -> Iterator[list[bytes]]:
    """Parts of an item that hold all its windows."""
    if not words:
        return
    step = max(1, longest - size + 1)
    for at in range(0, max(1, len(words) - size + 1), step):
        yield words[at : at + step + size - 1]


def _pattern(words: list[bytes]) -> str:
    # One character for each byte: the automaton knows 256 letters, and places are those of bytes.
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def automaton(parts: Sequence[tuple[str | None, bytes]], size: int) -> ahocorasick.Automaton | None:
    """Of (item, words joined by spaces); a window's value is its length in letters and words, and its items."""
    made = ahocorasick.Automaton()
    for item, joined in parts:
        words = joined.split()
        for at in range(max(1, len(words) - size + 1)):
            window = words[at : at + size]
            pattern = _pattern(window)
            held = made.get(pattern, None)
            if held is None:
                made.add_word(pattern, (len(pattern), len(window), {item} - {None}))
            elif item is not None:
                held[2].add(item)
    if not len(made):
        return None
    made.make_automaton()
    return made


def _worker_automaton(shard: Broadcast, size: int) -> ahocorasick.Automaton | None:
    """The shard's automaton; the broadcast value lives as long as the worker, and so does what is put into it."""
    held = shard.value
    if "automaton" not in held:
        held["automaton"] = automaton(held["parts"], size)
    return held["automaton"]


def hits(words: list[bytes], made: ahocorasick.Automaton | None) -> tuple[np.ndarray | None, set[str]]:
    """Which words lie inside a window, and the items whose windows occur; None where there is no hit."""
    if made is None or not words:
        return None, set()
    marks, items, starts = None, set(), None
    for end, (letters, count, of) in made.iter(_pattern(words)):
        if marks is None:
            marks = np.zeros(len(words) + 1, dtype=np.int64)
            starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), dtype=np.int64) + 1)])
        first = int(np.searchsorted(starts, end - letters + 1))
        marks[first] += 1
        marks[first + count] -= 1
        items |= of
    return None if marks is None else np.cumsum(marks[:-1]) > 0, items


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """First and last-plus-one word of each run of hit words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def spans_of(text: str, runs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as code points of the original text."""
    if not runs:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in runs]


def _parts(benchmark: DataFrame, item_col: str, text_cols: Sequence[str], size: int, max_words: int) -> tuple[DataFrame, int]:
    """(item, words, shard): the benchmark's distinct chunks, and the number of shards, none if there are no words."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for item, *texts in rows:
            for text in texts:
                for chunk in chunks(words_of(text), size, min(CHUNK_WORDS, max(2 * size, max_words // 4))):
                    yield item, b" ".join(chunk), len(chunk)

    schema = T.StructType(
        [T.StructField("item", T.StringType()), T.StructField("words", T.BinaryType()), T.StructField("n", T.LongType())]
    )
    picked = benchmark.select(F.col(item_col).cast("string").alias("item"), *[F.col(c).cast("string") for c in text_cols])
    parts = stage(map_rows(picked, run, schema).distinct(), "items")
    total = parts.agg(F.sum("n")).first()[0] or 0
    # Shards are dealt by hash; half the room is left for those above the average.
    count = -(-2 * total // max_words) if total > max_words else min(total, 1)
    return parts.select("item", "words", F.pmod(F.xxhash64("item", "words"), F.lit(max(1, count))).alias("shard")), count


def _shard(parts: DataFrame, k: int) -> Broadcast:
    """One shard's chunks, about ``max_words`` words at most, to all workers. The driver holds one shard at a time."""
    rows = parts.filter(F.col("shard") == k).select("item", "words").collect()
    return parts.sparkSession.sparkContext.broadcast({"parts": [(r["item"], bytes(r["words"])) for r in rows]})


def _fields(docs: DataFrame, id_col: str) -> list[T.StructField]:
    return [
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", ITEMS),
        T.StructField("spans", SPANS),
    ]


def _scan_once(docs: DataFrame, shard: Broadcast | None, size: int, id_col: str, text_col: str) -> DataFrame:
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        made = _worker_automaton(shard, size) if shard is not None else None
        for doc_id, text in rows:
            words = words_of(text)
            hit, items = hits(words, made)
            if hit is None:
                yield doc_id, len(words), 0, [], []
            else:
                yield doc_id, len(words), int(hit.sum()), sorted(items), spans_of(text, _runs(hit))

    return map_rows(docs.select(id_col, F.col(text_col).cast("string")), run, T.StructType(_fields(docs, id_col)))


def _scan_by_shards(docs: DataFrame, parts: DataFrame, count: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """What each shard finds depends on the text alone, so it is kept by the text's digest and merged there."""
    key = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    runs_type = T.ArrayType(T.ArrayType(T.LongType()))
    found_type = T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("shard", T.LongType()),
            T.StructField("runs", runs_type),
            T.StructField("items", ITEMS),
        ]
    )

    def scan(k: int) -> DataFrame:
        shard = _shard(parts, k)

        def run(rows: Iterator[tuple]) -> Iterator[tuple]:
            made = _worker_automaton(shard, size)
            for text_key, text in rows:
                hit, items = hits(words_of(text), made)
                if hit is not None:
                    yield text_key, k, _runs(hit), sorted(items)

        found = map_rows(docs.select(key.alias("key"), F.col(text_col).cast("string")), run, found_type)
        # Copies of a text find the same; one of them goes on.
        one = found.groupBy("key", "shard").agg(F.first("runs").alias("runs"), F.first("items").alias("items"))
        written = stage(one, "hits")
        shard.unpersist()
        return written

    each = scan(0)
    for k in range(1, count):
        each = each.unionByName(scan(k))
    merged = each.groupBy("key").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )

    def finish(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, runs, items in rows:
            words = words_of(text)
            hit = np.zeros(len(words) + 1, dtype=np.int64)
            for a, b in runs or ():
                hit[a] += 1
                hit[b] -= 1
            hit = np.cumsum(hit[:-1]) > 0
            yield doc_id, len(words), int(hit.sum()), sorted(items or ()), spans_of(text, _runs(hit)) if runs else []

    read = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), key.alias("key"))
    joined = read.join(merged, "key", "left").select("_id", "_text", "runs", "items")
    return map_rows(joined, finish, T.StructType(_fields(docs, id_col)))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    size: int = SIZE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_texts: Sequence[str] = ("text",),
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """One row per document: ``n_words``, ``n_hit``, ``items`` (ids as text, sorted) and ``spans`` of code points.

    ``item_texts`` are the benchmark's columns (questions, answers); each is an item's text by itself.
    """
    parts, count = _parts(benchmark, item_col, item_texts, size, max_words)
    if count > 1:
        return _scan_by_shards(docs, parts, count, size, id_col, text_col)
    return _scan_once(docs, _shard(parts, 0) if count else None, size, id_col, text_col)
