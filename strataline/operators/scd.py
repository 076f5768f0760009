"""Slowly changing dimensions: type 1 (overwrite) and type 2 (versions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions.scalars import differs, open_end
from strataline.operators.dedupe import keep_first, keep_last
from strataline.operators.dense import dense_ids
from strataline.operators.upsert import source_order
from strataline.schemas import SOURCE_ORDER

VERSION_COLUMNS = ("effective_date", "end_date", "is_current")


def highest_key(df: DataFrame | None, sk: str) -> int:
    """Greatest surrogate key in use, 0 for an absent or empty dimension."""
    if df is None:
        return 0
    return df.agg(F.max(sk)).first()[0] or 0


def _matching(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, Column]:
    """Rename the right side so that both sides' columns can be told apart after a join."""
    renamed = right.select(*[F.col(c).alias(f"_in_{c}") for c in right.columns], F.lit(True).alias("_matched"))
    return renamed, left[key].eqNullSafe(renamed[f"_in_{key}"])


def merge_type1(existing: DataFrame | None, incoming: DataFrame, *, key: str, sk: str) -> DataFrame:
    """Overwrite matched rows, keep absent ones, append new ones with the next surrogate keys.

    The first row per key of the increment counts. Existing columns are declared: further columns of
    the increment are ignored. The surrogate key comes first.
    """
    declared = [c for c in incoming.columns if c not in SOURCE_ORDER]
    attributes = declared if existing is None else [c for c in existing.columns if c != sk]
    order = source_order(incoming, [c for c in declared if c != key] or [key])
    first = keep_first(incoming, [key], order)
    numbering = [*[c for c in order if c in SOURCE_ORDER], key]
    if existing is None:
        return dense_ids(first, numbering, sk).select(sk, *attributes)

    shared = [c for c in attributes if c in first.columns]
    side, cond = _matching(existing, first.select(*shared), key)
    updated = existing.join(side, cond, "left").select(
        sk,
        *[
            F.when(F.col("_matched"), F.col(f"_in_{c}")).otherwise(F.col(c)).alias(c) if c in shared else F.col(c)
            for c in attributes
        ],
    )
    known = existing.select(F.col(key).alias("_known"))
    unseen = first.join(known, first[key].eqNullSafe(known["_known"]), "left_anti")
    added = dense_ids(unseen, numbering, sk, start=highest_key(existing, sk)).select(sk, *shared)
    return updated.unionByName(added, allowMissingColumns=True)


def merge_type2(
    existing: DataFrame | None,
    incoming: DataFrame,
    *,
    key: str,
    compare: Sequence[str],
    sk: str,
    effective: str,
    deleted: str | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Merge an increment into a versioned dimension.

    A current version whose ``compare`` columns differ (null-safe), or whose key is flagged in
    ``deleted``, is closed the day before the row's ``effective`` date. Changed and new keys open a
    version that is valid from there on. A deleted key never opens one. Keys absent from the
    increment, and all closed versions, stay as they are; so do unchanged versions, including their
    columns outside ``compare``.

    The last row per key of the increment counts, in ``order`` and with deletions after other rows.
    New surrogate keys continue after the highest one, in the same order. Columns of the result are
    those of the dimension (the increment's on the first load), then key and validity columns.

    A dimension has at most one current version per key, which this operator preserves; each side of
    its joins therefore holds a key once, and the joins cannot be skewed.
    """
    order = list(order) if order is not None else source_order(incoming, [c for c in incoming.columns if c != key])
    numbering = [*order, key] if key not in order else order
    flag = F.coalesce(F.col(deleted) == 1, F.lit(False)) if deleted else F.lit(False)
    fresh = keep_last(incoming.withColumn("_deleted", flag), [key], ["_deleted", *order])
    helper = {*SOURCE_ORDER, effective, "_deleted"}
    versioned = {sk, *VERSION_COLUMNS}
    if existing is None:
        attributes = [c for c in incoming.columns if c not in helper]
        return _open(fresh.filter("not _deleted"), numbering, attributes, sk, effective, 0)

    attributes = [c for c in existing.columns if c not in versioned]
    current = existing.filter("is_current")

    # Close: current versions against the few increment columns that decide.
    decide = list(dict.fromkeys([key, *compare, effective, "_deleted"]))
    side, cond = _matching(current, fresh.select(*decide), key)
    changed = F.coalesce(
        F.col("_matched") & (F.col("_in__deleted") | _any([differs(c, f"_in_{c}") for c in compare])), F.lit(False)
    )
    last = F.date_sub(F.col(f"_in_{effective}"), 1)
    winners = (
        current.join(side, cond, "left")
        .withColumn("_changed", changed)
        .select(
            *attributes,
            sk,
            "effective_date",
            F.when(F.col("_changed"), last).otherwise(F.col("end_date")).alias("end_date"),
            (~F.col("_changed")).alias("is_current"),
        )
    )
    closed = existing.filter("not is_current").select(*attributes, sk, *VERSION_COLUMNS)

    # Open: the increment against the current versions' deciding columns.
    side, cond = _matching(fresh, current.select(*dict.fromkeys([key, *compare])), key)
    opened = (
        fresh.join(side, cond, "left")
        .filter(~F.col("_deleted"))
        .filter(F.col("_matched").isNull() | _any([differs(c, f"_in_{c}") for c in compare]))
        .select(*fresh.columns)
    )
    added = _open(opened, numbering, [c for c in attributes if c in opened.columns], sk, effective, highest_key(existing, sk))
    return closed.unionByName(winners).unionByName(added, allowMissingColumns=True)


def _any(conditions: Sequence[Column]) -> Column:
    result = F.lit(False)
    for c in conditions:
        result = result | c
    return result


def _open(
    rows: DataFrame, numbering: Sequence[str], attributes: Sequence[str], sk: str, effective: str, start: int
) -> DataFrame:
    numbered = dense_ids(rows, list(numbering), sk, start=start)
    return numbered.select(
        *attributes,
        F.col(sk),
        F.to_date(F.col(effective)).alias("effective_date"),
        open_end().alias("end_date"),
        F.lit(True).alias("is_current"),
    )


def inverted_versions(dim: DataFrame) -> DataFrame:
    """One row, ``inverted``: versions that end before they start and so are never valid."""
    return dim.agg(F.count_if(F.col("end_date") < F.col("effective_date")).alias("inverted"))
