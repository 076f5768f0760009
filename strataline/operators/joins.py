"""Lookups, as-of lookups and key comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataline.operators.dedupe import keep_last
from strataline.operators.validity import chunk_of, day_number, disjoint_intervals


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    last_by: Sequence[str] | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Left-outer lookup that never multiplies fact rows.

    ``on`` maps fact columns to dimension columns, ``take`` maps output columns to dimension columns;
    unmatched rows get nulls. With ``last_by`` the dimension is first reduced to its last row per key;
    without it the caller vouches that keys are unique. ``bounded`` marks a dimension whose size
    cannot grow with the data (a calendar, say) and is broadcast; otherwise the optimizer decides
    from the measured size, and a skewed fact key is split by the adaptive skew join.
    """
    if last_by is not None:
        dim = keep_last(dim, list(on.values()), list(last_by))
    side = dim.select(
        *[F.col(d).alias(f"_on_{i}") for i, d in enumerate(on.values())],
        *[F.col(d).alias(out) for out, d in take.items()],
    )
    cond = None
    for i, fact_column in enumerate(on):
        term = facts[fact_column] == side[f"_on_{i}"]
        cond = term if cond is None else cond & term
    joined = facts.join(F.broadcast(side) if bounded else side, cond, "left")
    return joined.drop(*[f"_on_{i}" for i in range(len(on))])


def asof_lookup(
    facts: DataFrame,
    dim: DataFrame,
    *,
    fact_key: str,
    fact_date: str,
    dim_key: str,
    sk: str,
    out: str | None = None,
) -> DataFrame:
    """Surrogate key of the version valid on the fact's day, else of the current version, else null.

    Validity is ``effective_date <= day <= end_date``; of several valid versions the one with the
    highest (effective_date, key) wins. A version that ends before it starts is never valid.

    The answer depends only on (key, day), so distinct (key, day) probes are resolved and joined back.
    Versions are first cut into disjoint intervals; probes and intervals of a key and chunk of days then meet
    in one ordered pass, where the latest interval begun answers if it hasn't ended. Neither a key nor its
    history is one task's: a group holds the days of one chunk. Probes without an answer take the current version, and
    facts are shuffled once, for the join back on (key, day) against one row each.
    """
    out = out or sk
    versions = dim.select(
        F.col(dim_key).alias("_k"),
        day_number(F.col("effective_date")).alias("_start"),
        day_number(F.col("end_date")).alias("_end"),
        F.col(sk).cast("bigint").alias("_sk"),
        F.col("is_current").alias("_current"),
    ).filter(F.col("_k").isNotNull())
    probes = facts.select(F.col(fact_key).alias("_k"), F.to_date(fact_date).alias("_day")).distinct()
    day = F.to_date(fact_date)
    days = facts.agg(day_number(F.min(day)).alias("first"), day_number(F.max(day)).alias("last")).first()
    first, last = (0, -1) if days["first"] is None else days
    intervals = disjoint_intervals(versions.filter("_end >= _start"), first, last)
    at = day_number(F.col("_day"))
    # A probe without a day has a group of its own, without intervals.
    events = (
        probes.filter("_k is not null")
        .select("_k", chunk_of(at).alias("_chunk"), at.alias("_from"), F.lit(1).alias("_kind"))
        .unionByName(intervals.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    )
    in_order = Window.partitionBy("_k", "_chunk").orderBy("_from", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    begun = F.last(F.when(F.col("_kind") == 0, F.struct("_to", "_sk")), ignorenulls=True).over(in_order)
    holds = F.when(F.col("_begun._to") >= F.col("_from"), F.col("_begun._sk"))
    probed = (
        events.select("_k", "_from", "_kind", begun.alias("_begun"))
        .filter("_kind = 1")
        .select("_k", F.col("_from").alias("_day"), holds.alias("_valid"))
    )
    current = (
        versions.filter("_current")
        .groupBy("_k")
        .agg(F.max(F.struct("_start", "_sk"))["_sk"].alias("_fallback"))
        .select(F.col("_k").alias("_current_k"), "_fallback")
    )
    answers = probed.join(current, F.col("_k") == F.col("_current_k"), "left").select(
        "_k", "_day", F.coalesce("_valid", "_fallback").alias("_answer")
    )
    answered = (facts[fact_key] == answers["_k"]) & day_number(day).eqNullSafe(answers["_day"])
    return facts.join(answers.filter("_answer is not null"), answered, "left").select(
        *facts.columns, F.col("_answer").alias(out)
    )


def orphan_keys(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-null child keys that no parent row has, as column ``key``."""
    keys = child.select(F.col(child_column).alias("key")).filter("key is not null").distinct()
    parents = parent.select(F.col(parent_column).alias("_parent")).filter("_parent is not null").distinct()
    return keys.join(parents, F.col("key") == F.col("_parent"), "left_anti")


def new_rows(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Incoming rows whose key the existing table lacks; two null keys are equal.

    The existing keys are made distinct first, which collapses a repeated key before it is shuffled, unless the caller
    vouches that they are ``unique``.
    """
    if existing is None:
        return incoming
    known = existing.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    known = known if unique else known.distinct()
    cond = None
    for k in keys:
        term = incoming[k].eqNullSafe(known[f"_known_{k}"])
        cond = term if cond is None else cond & term
    return incoming.join(known, cond, "left_anti")
