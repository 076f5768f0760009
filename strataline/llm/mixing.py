"""Mixing sources to target weights: a token budget flows down a tree of domains, languages and sources.

At each node the budget is shared by weight. A child that cannot use its share is filled, and the rest is shared
again among its siblings by weight; only what a whole family cannot use goes back to the family's siblings. A leaf
can use at most ``max_epochs`` times its tokens. Shares are exact integers, and odd tokens go to the first children.

A leaf's budget is spent in seeded epochs: whole epochs take every document, and the last one takes a prefix of
the tokens in the order of ``key``, the md5 of seed, epoch, id and size, so one document may be cut. No document is
sorted or moved for that: bucketed sums find the bucket that holds the cut, its few documents find the cut itself,
and every document then decides by comparing its own key.

Tokens are words, runs of anything but ASCII white space. Defined cases: null text has no tokens and is taken
zero times; a null domain, language or source is the empty name; rows with the same id and size have one key and
share the cut equally, odd tokens being left; weights that are not named count ``OTHER``; an empty table gives an
empty table; other columns are ignored by ``allocate`` and kept by ``select``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.llm.common import SPACE, text_or_empty
from strataline.llm.quality import BLANKS
from strataline.session import stage

LEVELS = ("domain", "lang", "source")
OTHER = 1
# Documents that a bucket of a leaf should hold, and the most buckets of a leaf.
BUCKET_ROWS = 4096
MAX_BUCKETS = 1 << 16
# Leaf tables up to so many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_LEAVES = 100_000


@dataclass(frozen=True)
class Mix:
    """Weights by name for each level, the budget as parts of a thousand of all tokens, and the epochs' seed."""

    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    budget_permille: int = 1000
    max_epochs: int = 2
    seed: str = "mix-1"


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def _measures(domain: Column, id_col: str) -> list[Column]:
    def name(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    return [
        F.col(id_col).alias("doc_id"),
        name(domain).alias("domain"),
        name(F.col("lang")).alias("lang"),
        name(F.col("source")).alias("source"),
        F.size(words_of(text_or_empty("text"))).cast("long").alias("n_tokens"),
    ]


def measured(docs: DataFrame, domain: Column, id_col: str = "doc_id") -> DataFrame:
    """Id, leaf and token count of every document."""
    return docs.select(*_measures(domain, id_col))


def _weight(level: str, weights: dict[str, int]) -> Column:
    out = F.lit(OTHER)
    for name, w in sorted(weights.items()):
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def _shared(children: DataFrame, parent: tuple[str, ...], level: str) -> DataFrame:
    """``budget`` of the parent shared among its children by ``weight``, none above its ``capacity``.

    In the order of capacity by weight the full children come first, so a running sum decides which are full.
    """
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = family.orderBy(F.col("capacity") / F.col("weight"), level)
    big = "decimal(20,0)"
    before = F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1))
    heavier = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = F.expr(
        f"cast(capacity as {big}) * cast(heavier as decimal(12,0))"
        f" <= cast(weight as decimal(12,0)) * cast(budget - before as {big})"
    )
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)
    filled = F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(family)
    share = F.expr(
        f"cast(cast(weight as decimal(12,0)) * cast(budget - filled as {big}) div cast(open_weight as decimal(12,0)) as bigint)"
    )
    given = F.sum(F.when(~F.col("full"), F.col("share")).otherwise(0)).over(family)
    turn = F.row_number().over(family.orderBy("full", F.col("capacity") / F.col("weight"), level))
    return (
        children.withColumn("before", F.coalesce(before, F.lit(0)))
        .withColumn("heavier", heavier)
        .withColumn("full", full)
        .withColumn("open_weight", open_weight)
        .withColumn("filled", filled)
        .withColumn("share", F.when(~F.col("full"), share))
        .withColumn("odd", F.col("budget") - F.col("filled") - given)
        .withColumn("turn", turn)
        .withColumn(
            "budget",
            F.when(F.col("full"), F.col("capacity")).otherwise(F.col("share") + F.when(F.col("turn") <= F.col("odd"), 1).otherwise(0)),
        )
        .drop("before", "heavier", "full", "open_weight", "filled", "share", "odd", "turn", "weight")
    )


def budgets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Every leaf with its ``tokens``, ``rows`` and ``budget``. Sized by the number of leaves, not of documents."""
    leaves = (
        sizes.groupBy(*LEVELS)
        .agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
        .withColumn("capacity", F.col("tokens") * mix.max_epochs)
    )
    leaves = stage(leaves, "leaves")
    total = leaves.agg(
        F.least(F.expr(f"cast(sum(cast(tokens as decimal(20,0))) * {mix.budget_permille} div 1000 as bigint)"), F.sum("capacity")).alias(
            "budget"
        )
    )
    parents, above = total, ()
    for depth, level in enumerate(LEVELS, 1):
        names = LEVELS[:depth]
        children = leaves.groupBy(*names).agg(F.sum("capacity").alias("capacity"))
        children = children.withColumn("weight", _weight(level, mix.weights.get(level, {})))
        if above:
            children = children.join(parents, list(above))
        else:
            children = children.crossJoin(F.broadcast(parents))  # one row: the budget of all
        parents = _shared(children, above, level).select(*names, "budget")
        above = names
    return leaves.join(parents, list(LEVELS)).drop("capacity")


def _key(mix: Mix) -> Column:
    return F.md5(
        F.concat_ws(
            ":", F.lit(mix.seed), F.col("epochs"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("n_tokens")
        ).cast("binary")
    )


def _with_leaf(sizes: DataFrame, leaf: DataFrame, n_leaves: int) -> DataFrame:
    return sizes.join(F.broadcast(leaf) if n_leaves <= BROADCAST_LEAVES else leaf, list(LEVELS))


def cuts(sizes: DataFrame, mix: Mix) -> tuple[DataFrame, int]:
    """For every leaf: ``epochs``, the ``cut_key`` of its last epoch, and the tokens ``cut_take`` of rows with that key."""
    leaf = stage(
        budgets(sizes, mix).select(
            *LEVELS,
            F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("epochs"),
            F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("rest"),
            F.least(F.lit(MAX_BUCKETS), F.ceil(F.col("rows") / BUCKET_ROWS)).alias("buckets"),
        ),
        "budgets",
    )
    n_leaves = leaf.count()
    open_leaf = leaf.filter(F.col("rest") > 0)
    keyed = _with_leaf(sizes.filter(F.col("n_tokens") > 0), open_leaf, n_leaves).withColumn("key", _key(mix))
    keyed = keyed.withColumn(
        "bucket", F.expr("cast(cast(conv(substr(key, 1, 8), 16, 10) as bigint) * buckets div 4294967296 as bigint)")
    )
    running = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucket = (
        keyed.groupBy(*LEVELS, "bucket", "rest")
        .agg(F.sum("n_tokens").alias("held"))
        .withColumn("before", F.coalesce(F.sum("held").over(running), F.lit(0)))
        .filter((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("held")))
        .select(*LEVELS, "bucket", "before")
    )
    in_cut = keyed.join(F.broadcast(bucket) if n_leaves <= BROADCAST_LEAVES else bucket, [*LEVELS, "bucket"])
    running = Window.partitionBy(*LEVELS).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        in_cut.groupBy(*LEVELS, "key", "rest", "before")
        .agg(F.sum("n_tokens").alias("held"), F.count(F.lit(1)).alias("rows"))
        .withColumn("before", F.col("before") + F.coalesce(F.sum("held").over(running), F.lit(0)))
        .filter((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("held")))
        .select(*LEVELS, F.col("key").alias("cut_key"), F.expr("(rest - before) div rows").alias("cut_take"))
    )
    return stage(leaf.select(*LEVELS, "epochs").join(cut, list(LEVELS), "left"), "cuts"), n_leaves


def _taken(sized: DataFrame, cut: DataFrame, n_leaves: int, mix: Mix) -> DataFrame:
    key = _key(mix)
    prefix = (
        F.when(F.col("cut_key").isNull() | (key > F.col("cut_key")), F.lit(0))
        .when(key < F.col("cut_key"), F.col("n_tokens"))
        .otherwise(F.least("n_tokens", "cut_take"))
    )
    return _with_leaf(sized, cut, n_leaves).withColumn("prefix_tokens", prefix.cast("long")).drop("cut_key", "cut_take")


def allocate(docs: DataFrame, domain: Column, mix: Mix, id_col: str = "doc_id") -> DataFrame:
    """Every document with its leaf, ``n_tokens``, whole ``epochs`` and ``prefix_tokens`` of the last epoch."""
    sizes = stage(measured(docs, domain, id_col), "sizes")
    cut, n_leaves = cuts(sizes, mix)
    return _taken(sizes, cut, n_leaves, mix)


def prefix_of(text: Column, words: Column) -> Column:
    """The first ``words`` words of a text, with the white space between them."""
    parts = F.split(F.btrim(text, F.lit(BLANKS)), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    return F.btrim(F.array_join(F.slice(parts, 1, words.cast("int")), ""), F.lit(BLANKS))


def select(docs: DataFrame, domain: Column, mix: Mix, id_col: str = "doc_id") -> DataFrame:
    """``docs`` as the mix wants them: a row for each epoch that takes a document, the cut one with a shorter text."""
    cut, n_leaves = cuts(stage(measured(docs, domain, id_col), "sizes"), mix)
    # The document's own columns travel as one struct, so they cannot clash with the working columns.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *_measures(domain, id_col))
    taken = _taken(whole, cut, n_leaves, mix)
    copies = F.concat(
        F.array_repeat(F.col("n_tokens"), F.col("epochs").cast("int")),
        F.when(F.col("prefix_tokens") > 0, F.array(F.col("prefix_tokens"))).otherwise(F.array().cast("array<bigint>")),
    )
    shorter = F.when(F.col("copy") < F.col("n_tokens"), prefix_of(F.col("doc.text"), F.col("copy"))).otherwise(F.col("doc.text"))
    return taken.select("doc", "n_tokens", F.explode(copies).alias("copy")).select(
        *[shorter.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    )
