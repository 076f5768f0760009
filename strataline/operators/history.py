"""Interval histories from dated points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.functions.scalars import open_end
from strataline.operators.upsert import lists_all, upsert
from strataline.operators.windows import BLOCK_ROWS, numbered_window
from strataline.session import stage


def interval_history(
    points: DataFrame,
    *,
    key: str,
    date: str,
    ties: Sequence[str],
    sk: str,
    block_rows: int = BLOCK_ROWS,
    written: bool = False,
) -> DataFrame:
    """Turn dated points into versions that last until the day before the key's next point.

    Adds ``sk`` (1..n in (key, date, ties) order), ``effective_date``, ``end_date`` and ``is_current``.
    Two points on one date both survive; the first then ends before it starts. Points without a key
    are dropped.

    The points are written once, as they are counted before they are numbered and what leads to them may be long;
    points that are read from a table as they are (``written``) are not.
    """
    keyed = points.filter(F.col(key).isNotNull())
    following = numbered_window(
        keyed if written else stage(keyed, "points"), [key], [date, *ties], sk,
        lambda w, _: {"_next": F.lead(date).over(w)}, following=1, block_rows=block_rows,
    )
    return following.select(
        F.col(sk),
        *[c for c in points.columns],
        F.col(date).alias("effective_date"),
        F.coalesce(F.date_sub("_next", 1), open_end()).alias("end_date"),
        F.col("_next").isNull().alias("is_current"),
    )


def merge_points(
    existing: DataFrame | None,
    incoming: DataFrame,
    identity: Sequence[str],
    unique: bool = False,
    date: str | None = None,
) -> DataFrame:
    """Union of known and incoming points, one row per identity, the incoming one if both have it.

    Where all points are ``unique`` and have a ``date``, points that list all known ones are not compared with these.
    """
    if existing is not None and unique and date and lists_all(existing, incoming, identity, date):
        return incoming
    return upsert(existing, incoming, identity, unique)
