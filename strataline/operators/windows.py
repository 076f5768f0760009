"""Row-offset windows and global numbers over keys of any size, with one shuffle of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from strataline.operators.dense import placed, running_total

# A key with more rows is cut, if it also holds more than one shuffle partition's share of all rows.
BLOCK_ROWS = 1 << 16
# Rows of a cut key that are looked at to place each cut.
SAMPLES = 32

# Expressions over two windows: the ordered rows of a key, for offsets, and the declared frame, for aggregates.
Compute = Callable[[WindowSpec, WindowSpec], dict[str, Column]]


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def _cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], large: DataFrame, rows: int) -> DataFrame:
    """Per large key the order values at which it is cut, about ``rows`` rows apart, as two levels of an array.

    They are read off a sample that a hash of the order values picks, so a repeated task picks the same rows.
    Wherever the cuts fall the result is the same.
    """
    every = max(1, rows // SAMPLES)
    step = max(1, rows // every)
    place = F.struct(*order)
    picked = df.filter(F.pmod(F.xxhash64(*order), F.lit(every)) == 0)
    of_large = picked.join(_renamed(large, keys, "_large_"), _same(keys, "_large_"), "left_semi")
    sampled = of_large.groupBy(*keys).agg(F.sort_array(F.collect_list(place)).alias("_sampled"))
    cuts = F.filter("_sampled", lambda _, i: (i > 0) & (i % step == 0))
    return sampled.select(*keys, cuts.alias("_cuts")).select(
        *keys, "_cuts", F.ceil(F.sqrt(F.size("_cuts"))).cast("int").alias("_stride")
    ).select(
        *keys, "_cuts", "_stride", F.filter("_cuts", lambda _, i: (i + 1) % F.col("_stride") == 0).alias("_coarse")
    )


def _chunk(order: Sequence[str]) -> Column:
    """How many cuts are not above a row: first among every stride-th cut, then among the stride that follows."""
    place = F.struct(*order)
    strides = F.size(F.filter("_coarse", lambda c: c <= place))
    rest = F.slice("_cuts", strides * F.col("_stride") + 1, F.col("_stride"))
    return F.when(F.size("_cuts") > 0, strides * F.col("_stride") + F.size(F.filter(rest, lambda c: c <= place)))


class _Layout:
    """Rows with the chunk of their key they belong to. Only keys that are larger than a partition have several.

    A chunk is a range of the key's order values, so a window over (key, chunk) needs no more than the shuffle by
    these, and no task holds more than its share however the rows are spread over keys.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], block_rows: int, ranked: bool = False):
        self.keys, self.order, self.columns = list(keys), list(order), df.columns
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        # With ``ranked`` the counts are put in order, as numbers need them.
        self.counts = placed(counts, keys) if ranked else counts
        seen = self.counts.agg(F.sum("_n").alias("all"), F.max("_n").alias("most")).first()
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = max(block_rows, (seen["all"] or 0) // partitions)
        self.cut = (seen["most"] or 0) > rows
        if not self.cut:
            self.rows = df.withColumn("_chunk", F.lit(0)).withColumn("_is_cut", F.lit(False))
            return
        large = self.counts.filter(F.col("_n") > rows).select(*keys)
        # At most one cut per partition and key above it: all keys together have fewer cuts than partitions.
        cuts = F.broadcast(_renamed(_cuts(df, keys, order, large, rows), keys, "_cut_"))
        self.rows = df.join(cuts, _same(keys, "_cut_"), "left").select(
            *self.columns, F.coalesce(_chunk(order), F.lit(0)).alias("_chunk"), F.col("_cuts").isNotNull().alias("_is_cut")
        )

    def windowed(self, rows: DataFrame, compute: Compute, preceding: int, following: int) -> DataFrame:
        """The window expressions of all rows, with context from neighbouring chunks."""

        def over(spec: WindowSpec) -> list[Column]:
            made = compute(spec, spec.rowsBetween(-preceding, following))
            return [c.alias(name) for name, c in made.items()]

        in_chunk = Window.partitionBy(*self.keys, "_chunk").orderBy(*self.order)
        if not self.cut or not preceding + following:
            return rows.select("*", *over(in_chunk)).drop("_chunk", "_is_cut")

        def near(first: int, last: int) -> Column:
            """Among the first or last rows of the chunk."""
            tests = [F.lag(F.lit(1), first).over(in_chunk).isNull()] if first else []
            tests += [F.lead(F.lit(1), last).over(in_chunk).isNull()] if last else []
            return F.col("_is_cut") & reduce(lambda a, b: a | b, tests)

        reach = preceding + following
        flagged = rows.select(
            "*", *over(in_chunk), near(preceding, following).alias("_open"), near(reach, reach).alias("_edge")
        )
        # A row whose frame leaves its chunk is computed among the rows at the edges of its key's chunks. Those within
        # reach of it are all there and side by side; chunks that are smaller than the reach are there as a whole.
        edges = flagged.filter("_edge").select(*rows.columns, "_open")
        whole_key = Window.partitionBy(*self.keys).orderBy(*self.order)
        closed = flagged.filter("not _open").drop("_open", "_edge")
        return closed.unionByName(edges.select("*", *over(whole_key)).filter("_open").drop("_open")).drop("_chunk", "_is_cut")


def _checked(preceding: int, following: int, block_rows: int) -> None:
    if preceding < 0 or following < 0:
        raise ValueError("a frame reaches zero or more rows back and ahead")
    if preceding + following >= block_rows:
        raise ValueError("a block must be larger than the frame")


def offset_window(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    compute: Compute,
    preceding: int = 0,
    following: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the window expressions of ``compute``; frames reach at most the given rows away.

    ``order_by`` must be a total order within a partition. ``compute`` takes the ordered window of a key and the
    frame of ``preceding`` to ``following`` rows. Aggregates use the frame, which is made here, so it cannot reach
    farther than declared; ``lag`` and ``lead`` take no frame, use the first, and must not either.

    Rows are shuffled once, by key and chunk of a key; the first and last rows of chunks meet in a second, small
    window. Beforehand keys are counted, which moves one row per key and task.
    """
    _checked(preceding, following, block_rows)
    layout = _Layout(df, partition_by, order_by, block_rows)
    return layout.windowed(layout.rows, compute, preceding, following)


def numbered_window(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    id_column: str,
    compute: Compute,
    preceding: int = 0,
    following: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``offset_window``, and ``id_column``: the numbers 1..n of all rows in (partition, order).

    A number is the rows of earlier keys and chunks plus the row's place in its own, so only the counts of keys are
    put in a global order.
    """
    _checked(preceding, following, block_rows)
    layout = _Layout(df, partition_by, order_by, block_rows, ranked=True)
    group = [*partition_by, "_chunk"]
    if layout.cut:
        counts = placed(layout.rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")), group)
    else:
        counts = layout.counts.withColumn("_chunk", F.lit(0))
    before = running_total(counts, "_n", "_before").select(*group, "_before")
    rows = layout.rows.join(_renamed(before, group, "_of_"), _same(group, "_of_")).drop(*[f"_of_{c}" for c in group])
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order_by))
    numbered = rows.withColumn(id_column, F.col("_before") + place).drop("_before")
    return layout.windowed(numbered, compute, preceding, following)
