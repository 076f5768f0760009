"""Scalar expressions shared by the table builders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: end date of a version that is still open.
OPEN_END = dt.date(9999, 12, 31)

# Characters that Python's str.strip() removes and that occur in delimited files.
WHITESPACE = " \t\n\r\f\v "


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def open_end() -> Column:
    return F.lit(OPEN_END)


def strip(c: Column | str) -> Column:
    """Remove surrounding whitespace of every kind; plain ``trim`` keeps tabs."""
    return F.trim(as_col(c), F.lit(WHITESPACE))


def to_day(c: Column | str) -> Column:
    return F.to_date(as_col(c))


def season_of(day: Column | str, start_month: int = 8) -> Column:
    """Season labelled by the calendar year it starts in; null stays null."""
    d = as_col(day)
    return (F.year(d) - F.when(F.month(d) >= start_month, 0).otherwise(1)).cast("int")


def outcome(own: Column | str, other: Column | str) -> Column:
    """W, L or D from the point of view of ``own``; null when either score is missing."""
    a, b = as_col(own), as_col(other)
    return F.when(a > b, "W").when(a < b, "L").when(a == b, "D")


def date_key(day: Column | str) -> Column:
    """yyyymmdd as an integer."""
    d = as_col(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day(day: Column | str) -> Column:
    return F.date_format(as_col(day), "yyyy-MM-dd")


def half_even(c: Column | str) -> Column:
    """Round to a whole number, ties to even (``round`` takes ties away from zero)."""
    return F.bround(as_col(c), 0)


def differs(a: Column | str, b: Column | str) -> Column:
    """Null-safe inequality: two nulls are equal, a null and a value are not."""
    return ~as_col(a).eqNullSafe(as_col(b))


def category_of(candidates: Sequence[Column | str], taxonomy: Mapping[str, Sequence[str]]) -> Column:
    """Category of the first candidate that the taxonomy lists, else null.

    A value listed twice belongs to the category named first.
    """
    member: dict[str, str] = {}
    for category, values in taxonomy.items():
        for value in values:
            member.setdefault(value, category)
    if not member:
        return F.lit(None).cast("string")
    lookup = F.create_map(*[F.lit(x) for pair in member.items() for x in pair])
    return F.coalesce(*[F.element_at(lookup, strip(c)) for c in candidates])


def calendar_columns(day: Column | str, start_month: int = 8) -> list[Column]:
    """The attributes of a calendar row."""
    d = as_col(day)
    return [
        date_key(d).alias("date_sk"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        season_of(d, start_month).alias("season"),
    ]


def row_in_task() -> Column:
    """Position of a row in its task, from 0. Beyond 2^33 rows the task fails, as numbers would repeat."""
    marked = F.monotonically_increasing_id()
    wrapped = F.raise_error(F.lit("a task has more than 2^33 rows; use smaller partitions")).cast("bigint")
    return F.when(F.shiftright(marked, 33) == F.spark_partition_id(), marked.bitwiseAND(F.lit((1 << 33) - 1))).otherwise(wrapped)
