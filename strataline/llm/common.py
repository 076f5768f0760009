"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# ASCII white space; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(
    df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str | StructType, batch_rows: int = 4096
) -> DataFrame:
    """Run a generator over the rows of each partition, in Arrow batches.

    ``fn`` takes an iterator over the rows as tuples, in the order of ``df``'s columns, and yields tuples in the
    order of ``schema`` (DDL, or a type where names are a caller's); it may hold state for the whole partition. Rows are never gathered beyond one batch.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        def flush(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

        out: list[tuple] = []
        size = 0
        for row in fn(rows()):
            out.append(row)
            size += sum(len(v) for v in row if isinstance(v, str | bytes | list))
            if len(out) >= batch_rows or size > 8_000_000:
                yield flush(out)
                out, size = [], 0
        if out:
            yield flush(out)

    return df.mapInArrow(run, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))




def thinned(at: Column, rows: int, total: int | Column) -> Column:
    """Whether a row's hash ``at`` is among the share that leaves about four times ``rows`` of ``total`` rows."""
    scale = 1 << 30
    return F.pmod(at, F.lit(scale)) < F.ceil(F.lit(4.0 * rows * scale) / F.greatest(F.lit(1), total if isinstance(total, Column) else F.lit(total)))
