"""N-gram Jaccard join: the global shingle order is cut into fragments, and overlaps are summed over fragments.

A document is the set of its word shingles, as 64-bit hashes. Documents with equal sets form a class, of which one
node goes on. The global order puts rare shingles first, by hash, and the frequent ones last, by frequency; any
order gives the same links, this one keeps passages that many documents share out of the prefixes.

Two sets that are similar enough share a shingle among the first ``n - ceil(t n) + 1`` of each, so pairs that share
such a shingle are the candidates. What lies before their first common
shingle bounds what they can share, and parities of shingles by hash bits bound how far they differ, which leaves
few candidates to count. A candidate's overlap is counted fragment by fragment: sets are cut at the same
points of the order, equal fragments of a pair meet, and the partial overlaps are summed per pair.

Copies of one text by the thousand would give pairs by the million. Therefore each shared shingle first pairs its
documents with one leader only, the one with the least rarer shingles before it, and the links found are contracted to
components. Two more rounds do so among those whose sets have the same least, then the same greatest hash. They leave
few shingles whose similar documents lie in different components; for those every pair across components is counted. Pairs within a component need no count, as they change no component. No link between
components is lost, and nothing is capped.

Defined cases: null text and text without words have an empty set, link with nothing and are their own component;
a text of fewer words than a shingle is one shingle; repeated rows are one class; a null id has no part in the
smallest id of its component; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest, xxh3_128_digest

from strataline.llm.common import map_rows
from strataline.llm.components import stars
from strataline.session import stage

# Shingles counted together in a task before those seen once are forgotten.
COUNTED = 2_000_000
# A shingle of so many documents counts as frequent; the most frequent ones go into the order's table, whose size
# is bounded by MAX_FREQUENT. The table speeds up the join and has no influence on its result.
FREQUENT = 16
MAX_FREQUENT = 500_000
# Bits of the filter that keeps sets without candidates out of the shuffle; a full filter keeps none out.
FILTER_BITS = 1 << 26
RARE_FRAGMENTS = 4
LEADER_ROUNDS = 3
# Least number of 64-bit words of a set's parity signature; it doubles until there are two bits for each shingle.
SIGNATURE_WORDS = 8
MARK_BITS = 15

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


@dataclass(frozen=True)
class Similarity:
    """Words of a shingle, and the least Jaccard similarity in percent."""

    words: int = 5
    percent: int = 80

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1 if n else 0


def shingles(text: str | None, words: int) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending. A-Z is lower-cased; words are separated by ASCII white space."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxh64_intdigest, found), dtype=np.uint64, count=len(found))
    size = min(words, len(found))
    count = len(found) - size + 1
    with np.errstate(over="ignore"):
        acc = h[:count] + np.uint64(size)
        for k in range(1, size):
            acc = (acc ^ (acc >> np.uint64(30))) * _M1 + h[k : k + count]
        acc = (acc ^ (acc >> np.uint64(30))) * _M2
        acc = (acc ^ (acc >> np.uint64(27))) * _M3
        acc ^= acc >> np.uint64(31)
    return np.unique(acc)


def _signed(a: np.ndarray) -> list[int]:
    return a.view(np.int64).tolist()


def _class(found: np.ndarray) -> bytes:
    return xxh3_128_digest(found.tobytes())


def _signature(found: np.ndarray) -> list[int]:
    """Whether an odd number of shingles falls on each bit. Its length is a power of two."""
    bits = 64 * SIGNATURE_WORDS
    while bits < 2 * len(found):
        bits *= 2
    odd = np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _mark(found: np.ndarray) -> int:
    """Bits of the least and of the greatest hash of a set, which similar sets mostly have in common."""
    return int(found[0]) % (1 << MARK_BITS) | int(found[-1]) % (1 << MARK_BITS) << MARK_BITS


def _read(docs: DataFrame, words: int, id_col: str) -> DataFrame:
    """Id, class and size of every document; and, as rows without class, counts of shingles seen more than once."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        waiting: list[np.ndarray] = []
        size = 0
        for doc_id, text in rows:
            found = shingles(text, words)
            yield doc_id, _class(found), len(found), None, None
            waiting.append(found)
            size += len(found)
            if size > COUNTED:
                yield from counted(waiting)
                waiting, size = [], 0
        if waiting:
            yield from counted(waiting)

    def counted(waiting: list[np.ndarray]) -> Iterator[tuple]:
        values, count = np.unique(np.concatenate(waiting), return_counts=True)
        often = count > 1
        for shingle, n in zip(_signed(values[often]), count[often].tolist(), strict=True):
            yield None, None, None, shingle, n

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(id_col, "text"), run, f"{id_col} {kind}, class binary, n long, shingle long, seen long", batch_rows=50_000
    )


def _frequent(read: DataFrame) -> Broadcast:
    """The most frequent shingles, ascending, and each one's place by frequency, the least frequent first."""
    rows = (
        read.filter("class is null")
        .groupBy("shingle")
        .agg(F.sum("seen").alias("seen"))
        .filter(F.col("seen") >= FREQUENT)
        .orderBy(F.desc("seen"), "shingle")
        .limit(MAX_FREQUENT)
        .collect()
    )
    value = np.array([r["shingle"] for r in rows], dtype=np.int64).view(np.uint64)
    rank = np.arange(len(rows), 0, -1, dtype=np.int64)
    order = np.argsort(value)
    return read.sparkSession.sparkContext.broadcast((value[order], rank[order]))


def _places(found: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Place of each shingle among the frequent ones, 0 for the rare."""
    value, rank = frequent
    if not len(value):
        return np.zeros(len(found), dtype=np.int64)
    at = np.minimum(np.searchsorted(value, found), len(value) - 1)
    return np.where(value[at] == found, rank[at], 0)


def _prefixes(docs: DataFrame, how: Similarity, frequent: Broadcast) -> DataFrame:
    """Class, text key, size, parity signature and first shingles of every document that has shingles."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for text, key in rows:
            found = shingles(text, how.words)
            if len(found):
                place = _places(found, frequent.value)
                ordered = np.concatenate([found[place == 0], found[place > 0][np.argsort(place[place > 0], kind="stable")]])
                yield _class(found), key, len(found), _mark(found), _signature(found), _signed(ordered[: how.prefix(len(found))])

    return map_rows(
        docs.select("text", _text_key().alias("key")),
        run,
        "class binary, key long, n long, mark int, signature array<long>, prefix array<long>",
        batch_rows=20_000,
    )


def _fragments(docs: DataFrame, words: int, frequent: Broadcast, wanted: DataFrame) -> DataFrame:
    """The non-empty fragments (node, f, part) of the wanted nodes, a table of (class, key, node)."""
    bit = F.pmod("key", F.lit(FILTER_BITS))
    held = (
        wanted.select(bit.alias("bit"))
        .groupBy(F.expr("bit div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    )
    held_words = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for word, bits in held.collect():  # at most FILTER_BITS / 64 rows, whatever the corpus
        held_words[word] = bits
    filled = docs.sparkSession.sparkContext.broadcast(held_words.view(np.uint64))

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        done: set[int] = set()
        for text, key in rows:
            at = key % FILTER_BITS
            if key in done or not int(filled.value[at // 64]) >> (at % 64) & 1:
                continue
            done.add(key)
            found = shingles(text, words)
            cls = _class(found)
            place = _places(found, frequent.value)
            rare = found[place == 0]
            cut = np.searchsorted(rare, np.arange(1, RARE_FRAGMENTS, dtype=np.uint64) << np.uint64(62))
            yield cls, [_signed(part) for part in (*np.split(rare, cut), found[place > 0])]

    made = map_rows(docs.select("text", _text_key().alias("key")), run, "class binary, parts array<array<long>>")
    return (
        made.groupBy("class")
        .agg(F.first("parts").alias("parts"))
        .join(wanted.select("class", "node"), "class")
        .select("node", F.posexplode("parts").alias("f", "part"))
        .filter(F.size("part") > 0)
    )


def _differing(a: Column, b: Column) -> Column:
    """Bits in which two signatures differ. The longer one is folded, half onto half, to the length of the other."""

    def folded(x: Column, other: Column) -> Column:
        half = F.size(other)
        return F.when(
            F.size(x) == 2 * half,
            F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q)),
        ).otherwise(x)

    bits = F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    # Sizes that a link allows are less than a factor of two apart, and so are lengths.
    return F.when(
        F.size(a).between(F.size(b) / 2, 2 * F.size(b)), F.aggregate(bits, F.lit(0), lambda x, y: x + y)
    ).otherwise(0)


def _few(differing: Column, both: Column, how: Similarity) -> Column:
    """Whether sets of ``both`` shingles together may differ in so many and still be linked."""
    return differing * (100 + how.percent) <= (100 - how.percent) * both


def _hopeful(pairs: DataFrame, nodes: DataFrame, how: Similarity) -> DataFrame:
    """The pairs whose signatures leave a link possible.

    A shingle that only one of two sets has changes one bit, so signatures of linked sets differ in no more bits
    than the sets may differ in shingles. Signatures are small; whole sets only move for the pairs that are left.
    """
    of_u, of_v = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}")) for x in "uv")
    possible = _few(_differing(F.col("s_u"), F.col("s_v")), F.col("n_u") + F.col("n_v"), how)
    return pairs.join(of_u, "u").join(of_v, "v").filter(possible).select("u", "v")


def _text_key() -> Column:
    """A text's number; equal texts have equal numbers."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _links(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, how: Similarity, frequent: Broadcast) -> DataFrame:
    """The pairs (u, v) that are similar enough. ``nodes`` has class, key, node, n and signature."""
    pairs = stage(_hopeful(stage(pairs, "pairs"), nodes, how), "hopeful")
    if pairs.isEmpty():
        return pairs
    wanted = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    wanted = stage(nodes.join(wanted, "node").select("class", "key", "node", "n"), "wanted")
    parts = stage(_fragments(docs, how.words, frequent, wanted), "fragments")
    overlap = (
        pairs.join(parts.select(F.col("node").alias("u"), "f", F.col("part").alias("part_u")), "u")
        .join(parts.select(F.col("node").alias("v"), "f", F.col("part").alias("part_v")), ["v", "f"])
        .select("u", "v", F.size(F.array_intersect("part_u", "part_v")).cast("long").alias("partial"))
        .groupBy("u", "v")
        .agg(F.sum("partial").alias("common"))
    )
    size = wanted.select("node", "n")
    return (
        overlap.join(size.toDF("u", "n_u"), "u")
        .join(size.toDF("v", "n_v"), "v")
        .filter(100 * F.col("common") >= how.percent * (F.col("n_u") + F.col("n_v") - F.col("common")))
        .select("u", "v")
    )


def _reach(n_u: str, rest_u: str, n_v: str, rest_v: str, how: Similarity) -> Column:
    """Whether two sets can be linked if a shared shingle is the first that they share.

    Everything they share then lies among the ``rest`` of each, the shingles from that one on. The first shingle
    shared by linked sets passes, so no link is lost; and sizes that differ too much never pass.
    """
    return (100 + how.percent) * F.least(rest_u, rest_v) >= how.percent * (F.col(n_u) + F.col(n_v))


def _sketches(nodes: DataFrame) -> DataFrame:
    """Signatures folded to the two numbers of 64 bits that pairs are tested by as they are made."""

    def folded(half: int) -> Column:
        return F.aggregate(
            F.filter("signature", lambda _, k: k % 2 == half), F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y)
        )

    return nodes.select("node", folded(0).alias("even"), folded(1).alias("odd"))


def _labelled(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """Shared shingles whose documents lie in different components, with the component ``root`` of each."""
    root = F.coalesce("v", "node")
    labelled = shared.join(joined, F.col("node") == F.col("u"), "left").select("shingle", "node", "n", "mark", "rest", root.alias("root"))
    split = (
        labelled.groupBy("shingle")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low < high")
        .select("shingle")
    )
    return labelled.join(split, "shingle")


def _across(open_: DataFrame, nodes: DataFrame, how: Similarity) -> DataFrame:
    """All pairs of different components that share a shingle and have sizes, places and sketches that a link allows."""
    columns = ("node", "n", "rest", "root", "even", "odd")
    drawn = open_.join(_sketches(nodes), "node")
    left, right = (drawn.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in columns]) for side in "uv")
    differing = sum(F.bit_count(F.col(f"{c}_u").bitwiseXOR(F.col(f"{c}_v"))) for c in ("even", "odd"))
    possible = (
        (F.col("node_u") < F.col("node_v"))
        & (F.col("root_u") != F.col("root_v"))
        & _reach("n_u", "rest_u", "n_v", "rest_v", how)
        & _few(differing, F.col("n_u") + F.col("n_v"), how)
    )
    # One condition of the join, so that a pair which fails it is never a row.
    return (
        left.join(right, (left["shingle"] == right["shingle"]) & possible)
        .select(F.col("node_u").alias("u"), F.col("node_v").alias("v"))
        .distinct()
    )


def components(docs: DataFrame, how: Similarity = Similarity(), id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``, the smallest id it is linked to."""
    read = stage(_read(docs, how.words, id_col), "shingles")
    frequent = _frequent(read)
    kept = read.filter("class is not null").drop("shingle", "seen")
    # A node is a class; its number is fixed by the written table.
    nodes = (
        _prefixes(docs, how, frequent)
        .groupBy("class")
        .agg(
            F.min("key").alias("key"),
            F.first("n").alias("n"),
            F.first("mark").alias("mark"),
            F.first("signature").alias("signature"),
            F.first("prefix").alias("prefix"),
        )
    )
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    postings = nodes.select("node", "n", "mark", F.posexplode("prefix").alias("at", "shingle")).select(
        "node", "n", "mark", (F.col("n") - F.col("at")).alias("rest"), "shingle"
    )
    several = postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("docs")).filter("docs > 1").select("shingle")
    shared = stage(postings.join(several, "shingle"), "shared")
    all_nodes = nodes.select("class", "node")
    nodes = stage(nodes.drop("prefix").join(shared.select("node").distinct(), "node"), "candidates")

    joined = shared.select(F.col("node").alias("u"), F.col("node").alias("v")).filter(F.lit(False))
    for turn in range(LEADER_ROUNDS):
        open_ = stage(_labelled(shared, joined), "open")
        if open_.isEmpty():
            break
        # Documents that share a shingle by chance mostly differ in their marks, so later leaders are of their like.
        mark = F.shiftright("mark", MARK_BITS * max(0, turn - 1)).bitwiseAND(F.lit((1 << MARK_BITS) - 1))
        open_ = open_.withColumn("kind", mark if turn else F.lit(0))
        # What lies before the shared shingle is rarer than it, so the document with the least of it has least of its
        # own: the text that near copies were made from, where it is there.
        own = F.expr("((n - rest) << 20) div n")
        leaders = open_.groupBy("shingle", "kind").agg(
            F.min(F.struct(own.alias("own"), F.xxhash64("node", F.lit(turn)).alias("at"), "node", "n", "rest", "root")).alias("leader")
        )
        pairs = (
            open_.join(leaders, ["shingle", "kind"])
            .filter((F.col("root") != F.col("leader.root")) & _reach("n", "rest", "leader.n", "leader.rest", how))
            .select(F.col("leader.node").alias("u"), F.col("node").alias("v"))
            .distinct()
        )
        links = stage(_links(docs, pairs, nodes, how, frequent), "links")
        if links.isEmpty():
            continue
        joined = stars(joined.union(links))
    across = _across(stage(_labelled(shared, joined), "open"), nodes, how)
    links = stage(_links(docs, across, nodes, how, frequent), "links")
    if not links.isEmpty():
        joined = stars(joined.union(links))

    smallest = kept.filter("n > 0").groupBy("class").agg(F.min(id_col).alias("least"))
    rooted = (
        all_nodes.join(joined, F.col("node") == F.col("u"), "left")
        .select("class", F.coalesce("v", "node").alias("root"))
        .join(smallest, "class")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = rooted.join(least, "root").select("class", "component_id")
    return kept.join(answer, "class", "left").select(
        id_col, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(id_col)).alias("component_id")
    )


def representatives(docs: DataFrame, how: Similarity = Similarity(), id_col: str = "doc_id") -> DataFrame:
    """One document of each component: the one with the smallest id, of several rows with that id one.

    Rows with a null id stay.
    """
    found = components(docs, how, id_col)
    kept = found.filter(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    whole = docs.select(id_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    one = Window.partitionBy(id_col).orderBy(F.xxhash64("doc.text"), "doc.text")
    chosen = whole.join(kept, id_col, "left_semi").withColumn("turn", F.row_number().over(one)).filter("turn = 1")
    return chosen.select("doc").union(whole.filter(F.col(id_col).isNull()).select("doc")).select("doc.*")
