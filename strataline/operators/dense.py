"""Dense sequential ids and running totals over a total order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.functions.scalars import row_in_task
from strataline.session import stage


def placed(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The rows range-partitioned and sorted, written once with their partition and their position in it.

    The written table pins the partitioning, so a lost executor cannot shift positions.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", row_in_task())
    )
    return stage(ranged, "ordered")


def _earlier(rows: DataFrame, total: Column) -> DataFrame:
    """(_part, _before): the sum of ``total`` over earlier partitions. One row per shuffle partition."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy("_part")
        .agg(total.alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )


def dense_ids(df: DataFrame, order: Sequence[str | Column], id_column: str, start: int = 0) -> DataFrame:
    """Number the rows ``start+1 .. start+n`` in ``order``, which must be a total order.

    The id is the position plus the number of rows in earlier partitions. The offset table has one row per shuffle
    partition, which bounds the broadcast and its running sum.
    """
    rows = placed(df, order)
    numbered = rows.join(F.broadcast(_earlier(rows, F.count(F.lit(1)))), "_part")
    return numbered.withColumn(id_column, F.col("_before") + F.col("_pos") + F.lit(start + 1)).drop(
        "_part", "_pos", "_before"
    )


def running_total(rows: DataFrame, value: str, out: str) -> DataFrame:
    """Add ``out`` to ``placed`` rows: the sum of ``value`` over all earlier rows in their order."""
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(F.broadcast(_earlier(rows, F.sum(value))), "_part").withColumn(
        out, F.col("_before") + F.col("_inside")
    ).drop("_part", "_pos", "_inside", *["_before"] * (out != "_before"))
