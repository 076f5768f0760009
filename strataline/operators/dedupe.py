"""One row per key, and the opposite: rows that share a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # `row_number() = 1` lets Spark keep only the first row per key in every map task before the
    # shuffle (WindowGroupLimit), so a key that holds much of the table stays cheap.
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in ``order``. Null keys count as equal."""
    return _ranked_first(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in ``order``. Null keys count as equal."""
    return _ranked_first(df, keys, [F.col(c).asc_nulls_first() for c in order])


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition on equal keys where two nulls are equal."""
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(right[k])
        cond = term if cond is None else cond & term
    return cond


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once."""
    dup = duplicated_keys(df, keys).select(*[F.col(k).alias(f"_dup_{k}") for k in keys])
    cond = None
    for k in keys:
        term = df[k].eqNullSafe(dup[f"_dup_{k}"])
        cond = term if cond is None else cond & term
    return df.join(dup, cond, "left_semi")
