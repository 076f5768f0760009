"""The driver's tables and the views of them that several queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str | Column) -> Column:
    """Money as whole cents, so that sums and comparisons are exact."""
    return F.round((F.col(c) if isinstance(c, str) else c) * 100).cast("bigint")


def price_points(lineitem: DataFrame) -> DataFrame:
    """Dated prices of a part: every distinct (part, day, price, supplier), with the line's flag."""
    return lineitem.select(
        F.col("l_partkey").alias("part"),
        F.to_date("l_shipdate").alias("day"),
        cents("l_extendedprice").alias("price"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_returnflag").alias("flag"),
    )


POINT = ("part", "day", "price", "supplier")
