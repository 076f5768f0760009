"""Upserts by natural key and their statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions.scalars import iso_day
from strataline.operators.dedupe import duplicated_keys, keep_last
from strataline.operators.joins import new_rows
from strataline.schemas import SOURCE_ORDER
from strataline.session import stage


def source_order(df: DataFrame, fallback: Sequence[str]) -> list[str]:
    """Columns that put rows in source order: the recorded position, else the given columns."""
    recorded = [c for c in SOURCE_ORDER if c in df.columns]
    return recorded or list(fallback)


def last_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last row per key in source order; without a recorded position, the greatest remaining columns."""
    rest = [c for c in df.columns if c not in keys]
    return keep_last(df, keys, source_order(df, rest or keys))


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``last_per_key`` of a table whose keys are rarely repeated: only the rows of repeated keys are put in order.

    Which these are is found from the keys alone, so nothing else is shuffled where no key is repeated.
    """
    repeated = stage(duplicated_keys(df, keys).select(*[F.col(k).alias(f"_twice_{k}") for k in keys]), "repeated")
    if repeated.isEmpty():
        return df
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_twice_{k}")) for k in keys])
    return df.join(repeated, same, "left_anti").unionByName(last_per_key(df.join(repeated, same, "left_semi"), keys))


# Two hashes of a row's columns, made when rows are compared.
DIGEST = ("_digest_1", "_digest_2")


def digests(columns: Sequence[str]) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *columns).alias(name) for seed, name in enumerate(DIGEST, 1)]


def digest_totals() -> list[Column]:
    """Sums of rows' digests, equal for equal sets of rows in any order."""
    return [F.sum(F.col(d).cast("decimal(38,0)")) for d in DIGEST] + [F.bit_xor(d) for d in DIGEST]


def lists_all(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], date: str) -> bool:
    """Whether the incoming rows up to the newest existing day have just the existing keys, by number and digests.

    Keys are single on both sides. A feed that lists its history and goes on at its end is known by this from two scans;
    of any other nothing is said.
    """
    newest = existing.agg(F.max(F.to_date(date)).alias("day")).first()["day"]
    early = F.col("_day").isNull() | (F.col("_day") <= F.lit(newest).cast("date"))

    def totals(rows: DataFrame) -> tuple:
        listed = rows.select(*digests(keys), F.to_date(date).alias("_day")).filter(early)
        return tuple(listed.agg(F.count(F.lit(1)), *digest_totals()).first())

    return totals(existing) == totals(incoming)


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Existing and incoming rows, one per key, incoming winning and its last row winning within it.

    ``existing`` is itself the result of an upsert and therefore unique, so it is only filtered by
    the incoming keys (an anti join that the optimizer broadcasts when the increment is small); just
    the increment is sorted and deduplicated, unless the caller vouches that it is ``unique``. Columns are matched by name.
    """
    fresh = incoming if unique else last_per_key(incoming, keys)
    if existing is None:
        return fresh
    kept = new_rows(incoming.select(*keys), existing, keys, unique)
    return kept.unionByName(fresh, allowMissingColumns=True)


def after_watermark(day: Column, watermark: str | None) -> Column:
    """Strictly newer than the watermark; a null day never is; without a watermark everything is."""
    if watermark is None:
        return F.lit(True)
    return F.coalesce(F.to_date(day) > F.lit(watermark).cast("date"), F.lit(False))


def merge_statistics(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    date_column: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """One row: incoming_rows, new_keys (rows, not distinct keys) and rows_after_watermark.

    ``rows_after_watermark`` is null for a table that has no date column to compare.
    """
    flagged = incoming.select(
        *keys,
        (after_watermark(F.col(date_column), watermark) if date_column else F.lit(None).cast("boolean")).alias("_after"),
    )
    if existing is None:
        marked = flagged.withColumn("_known", F.lit(None).cast("boolean"))
    else:
        known = existing.select(*[F.col(k).alias(f"_known_{k}") for k in keys]).distinct()
        known = known.withColumn("_known", F.lit(True))
        cond = None
        for k in keys:
            term = flagged[k].eqNullSafe(known[f"_known_{k}"])
            cond = term if cond is None else cond & term
        marked = flagged.join(known, cond, "left")
    after = F.count_if("_after") if date_column else F.lit(None).cast("bigint")
    return marked.agg(
        F.count(F.lit(1)).alias("incoming_rows"),
        F.count_if(F.col("_known").isNull()).alias("new_keys"),
        after.alias("rows_after_watermark"),
    )


def newest_day(df: DataFrame, date_column: str) -> DataFrame:
    """One row, ``day``: the newest date as ISO text, null when there is none."""
    return df.agg(iso_day(F.max(F.to_date(date_column))).alias("day"))
