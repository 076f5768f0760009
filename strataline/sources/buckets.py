"""Versions of a keyed table in hash buckets: a merge writes the buckets it changes and refers to the others.

A version is a folder with a manifest, one row per bucket that holds rows: the run whose folder has the bucket's
files, and how many rows they are. A merge first writes the incoming rows by bucket, each task to the buckets it has rows of,
without a shuffle. Buckets that these repeat, by count and sums of their rows' digests, stay what they were. Buckets
of which they have every key are theirs from now on. Both is what a snapshot that lists a whole table comes to, and only
keys are shuffled for it. Of the other buckets the incoming rows that the table has already are dropped by their digests,
and the rest is written together with the old rows that are not replaced. The new manifest takes all other buckets from
the old one.

Buckets are a power of two. They double when they hold more than twice ``bucket_rows`` on average, which
rewrites the table, so each row is rewritten for this a bounded number of times as the table grows.
"""

from __future__ import annotations

import json
import threading
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.operators.dedupe import same_key
from strataline.operators.upsert import DIGEST, digest_totals, digests, lists_all, one_per_key
from strataline.schemas import SOURCE_ORDER
from strataline.session import control_table, parquet_writer, remove, stage

BUCKET_ROWS = 1 << 22
# Keys of one whole number are placed by blocks of 2**GRAIN neighbours, where a bucket has room for many such blocks. What was
# numbered together mostly belongs together, and compresses and aggregates better side by side.
GRAIN = 6
MANIFEST_DDL = "buckets int, bucket int, path string, row_count bigint, grain int"
BUCKET = "_bucket"
# So many buckets are counted while they are written, more from what was written.
OBSERVED = 64
# So many files a task keeps open; with more buckets the rest of its rows is sorted by bucket.
OPEN_FILES = 128


@dataclass(frozen=True)
class Version:
    """A table's buckets and where each one's files are."""

    buckets: int
    schema: T.StructType
    paths: dict[int, str]
    rows: dict[int, int]
    # How many keys the version before lacked, where this one was just written.
    new_keys: int = field(default=0, compare=False)
    # By blocks of how many neighbours, as a power of two, keys are placed. Earlier manifests have none.
    grain: int = 0

    @property
    def row_count(self) -> int:
        return sum(self.rows.values())


def _bucket_of(keys: Sequence[str], buckets: int, grain: int) -> Column:
    placed = [F.shiftright(k, grain) for k in keys] if grain else keys
    return F.pmod(F.xxhash64(*placed), F.lit(buckets)).cast("int")


def _grain_for(schema: T.StructType, keys: Sequence[str], bucket_rows: int) -> int:
    whole = len(keys) == 1 and isinstance(schema[keys[0]].dataType, (T.LongType, T.IntegerType))
    return GRAIN if whole and bucket_rows >= 1024 << GRAIN else 0


def _buckets_for(rows: int, bucket_rows: int) -> int:
    buckets = 1
    while rows > buckets * bucket_rows:
        buckets *= 2
    return buckets


# Manifests that were read or written last. A version never changes.
_versions: OrderedDict[str, Version] = OrderedDict()
_KEPT = 256


def _remember(path: str, version: Version) -> Version:
    _versions[path] = version
    if len(_versions) > _KEPT:
        _versions.popitem(last=False)
    return version


def load_version(spark: SparkSession, path: str) -> Version:
    return _versions.get(path) or _remember(path, _manifest(spark, path))


def _manifest(spark: SparkSession, path: str) -> Version:
    # One row per bucket, and one without a bucket that keeps the schema, of a table without rows too.
    rows = spark.read.schema(f"{MANIFEST_DDL}, schema string").parquet(f"{path}/manifest").collect()
    schema = next(r["schema"] for r in rows if r["bucket"] is None)
    held = [r for r in rows if r["bucket"] is not None]
    return Version(
        rows[0]["buckets"],
        T.StructType.fromJson(json.loads(schema)),
        {r["bucket"]: r["path"] for r in held},
        {r["bucket"]: r["row_count"] for r in held},
        grain=rows[0]["grain"] or 0,
    )


def _save_version(spark: SparkSession, path: str, version: Version) -> None:
    rows = [(version.buckets, b, p, version.rows[b], version.grain) for b, p in sorted(version.paths.items())]
    table = control_table(spark, [*rows, (version.buckets, None, None, 0, version.grain)], MANIFEST_DDL)
    schema = F.when(F.col("bucket").isNull(), F.lit(json.dumps(version.schema.jsonValue())))
    table.withColumn("schema", schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    _remember(path, version)


def _files(spark: SparkSession, version: Version, chosen: Sequence[int] | None = None) -> DataFrame:
    """Rows of the chosen buckets, or of all."""
    paths = [version.paths[b] for b in (version.paths if chosen is None else chosen) if b in version.paths]
    if not paths:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*paths)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The whole table of a version."""
    return _files(spark, load_version(spark, path))


# How many write()s of buckets go on in a session, and its own setting of their writers.
_writing: dict[str, tuple[int, str]] = {}
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_lock = threading.Lock()


@contextmanager
def _open_writers(spark: SparkSession, buckets: int) -> Iterator[None]:
    """Lets a task keep a file of every bucket open, so that its rows need not be sorted by bucket to be written."""
    own = str(id(spark))
    with _lock:
        depth, before = _writing.get(own, (0, spark.conf.get(_WRITERS, "0")))
        _writing[own] = depth + 1, before
        spark.conf.set(_WRITERS, str(max(int(spark.conf.get(_WRITERS, "0")), min(buckets, OPEN_FILES))))
    try:
        yield
    finally:
        with _lock:
            depth, before = _writing[own]
            _writing[own] = depth - 1, before
            if depth == 1:
                del _writing[own]
                spark.conf.set(_WRITERS, before)


def _write(rows: DataFrame, data: str, buckets: Sequence[int]) -> dict[int, int]:
    """Write rows of ``buckets`` by ``BUCKET`` under a folder; the number of rows of each that has some.

    Every task writes to all buckets that it has rows of, so rows are neither shuffled nor sorted for it.
    """
    spark = rows.sparkSession
    with _open_writers(spark, len(buckets)):
        if len(buckets) <= OBSERVED:
            seen = Observation()
            counts = [F.count_if(F.col(BUCKET) == b).alias(str(b)) for b in buckets]
            _save(rows.observe(seen, *counts), data)
            return {b: n for b in buckets if (n := seen.get[str(b)])}
        _save(rows, data)
    # Only the folders' names and the files' own row counts are read.
    written = spark.read.schema(f"{BUCKET} int").parquet(data)
    return {r[BUCKET]: r["n"] for r in written.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}


def _save(rows: DataFrame, data: str) -> None:
    parquet_writer(rows).mode("overwrite").partitionBy(BUCKET).parquet(data)


def _by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in their types, null where ``df`` lacks one."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def upsert_buckets(
    previous: str | None,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    bucket_rows: int = BUCKET_ROWS,
    *,
    unique: bool = False,
    at_most: int | None = None,
    date: str | None = None,
) -> Version:
    """Write the version at ``path``: that at ``previous`` with the incoming rows, the last one per key winning.

    Columns are matched by name; those that the table doesn't have are added to it, null in earlier rows. With
    ``unique`` the caller vouches that no key is repeated. ``at_most`` bounds the incoming rows, where that is known.
    ``date`` is a column by which the table mostly goes on; see ``lists_all``.
    """
    spark = incoming.sparkSession
    fresh = (incoming if unique else one_per_key(incoming, keys)).drop(*SOURCE_ORDER)
    old = load_version(spark, previous) if previous is not None else None
    if old is None:
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in fresh.schema.fields])
        if at_most is None:
            counted = Observation()
            fresh = stage(fresh.observe(counted, F.count(F.lit(1)).alias("rows")), "increment")
            at_most = counted.get["rows"]
        buckets = _buckets_for(at_most, bucket_rows)
        grain, data = _grain_for(schema, keys, bucket_rows), f"{path}/data"
        paths, rows = _located(data, _write(_placed(fresh, keys, buckets, grain), data, range(buckets)))
        version = Version(buckets, schema, paths, rows, sum(rows.values()), grain)
    else:
        version = _merged(spark, old, path, fresh, keys, bucket_rows, date)
    _save_version(spark, path, version)
    return version


def _placed(rows: DataFrame, keys: Sequence[str], buckets: int, grain: int) -> DataFrame:
    return rows.withColumn(BUCKET, _bucket_of(keys, buckets, grain))


def _merged(
    spark: SparkSession, old: Version, path: str, fresh: DataFrame, keys: Sequence[str], bucket_rows: int, date: str | None
) -> Version:
    """The incoming rows are written by bucket first, as that is all there is to do for the buckets they replace as a whole.

    Which these are the keys alone tell: those of which the incoming rows have every key. Of the others the rows that
    are left are put beside the new ones.
    """
    added = [T.StructField(f.name, f.dataType) for f in fresh.schema.fields if f.name not in old.schema.names]
    schema = T.StructType([*old.schema.fields, *added])
    folder = f"{path}/incoming"
    rows = _write(_placed(_by_name(fresh, schema), keys, old.buckets, old.grain), folder, range(old.buckets))
    arrived = Version(old.buckets, schema, *_located(folder, rows))
    same = set() if added else _unchanged(spark, old, arrived)
    differ = sorted(set(rows) - same)
    left = _left(spark, old, arrived, differ, keys, date)
    whole = [b for b in differ if not left.get(b)]
    partial = [b for b in differ if left.get(b)]
    # Keys are single on both sides, so an old row that is not left met one of the new.
    new_keys = sum(rows[b] - (old.rows.get(b, 0) - left.get(b, 0)) for b in differ)
    total = sum(n for b, n in old.rows.items() if b not in differ) + sum(left.values()) + sum(rows[b] for b in differ)
    if added or total > 2 * old.buckets * bucket_rows:
        # Every row is written again, with the new columns or by the new number of buckets.
        buckets = old.buckets if total <= 2 * old.buckets * bucket_rows else _buckets_for(total, bucket_rows)
        kept, touched = {}, sorted({*old.paths, *rows})
        changed = _files(spark, arrived)
    else:
        buckets, touched = old.buckets, partial
        kept = {b: p for b, p in old.paths.items() if b not in differ} | {b: arrived.paths[b] for b in whole}
        changed = _changed(spark, old, arrived, partial, keys)
        if changed is not None:
            touched = [r[BUCKET] for r in changed.select(_bucket_of(keys, buckets, old.grain).alias(BUCKET)).distinct().collect()]
            kept |= {b: old.paths[b] for b in partial if b not in touched}
    counts = {b: rows[b] if b in whole else old.rows[b] for b in kept}
    if touched:
        before = _by_name(_files(spark, old, touched), schema)
        stays = before.join(replaced := changed.select(*keys), same_key(before, replaced, keys), "left_anti")
        merged = _placed(stays.unionByName(changed), keys, buckets, old.grain)
        data = f"{path}/data"
        paths, written = _located(data, _write(merged, data, range(buckets) if added or buckets != old.buckets else touched))
        kept, counts = kept | paths, counts | written
    remove(spark, [folder] if not set(whole) & set(kept) else [p for b, p in arrived.paths.items() if kept.get(b) != p])
    if not differ and not added:
        return replace(old, new_keys=0)
    return Version(buckets, schema, kept, counts, new_keys, old.grain)


def _unchanged(spark: SparkSession, old: Version, arrived: Version) -> set[int]:
    """Buckets that hold the same rows: as many, with the same sums of their digests. Few rows are shuffled."""
    alike = [b for b, n in arrived.rows.items() if old.rows.get(b) == n]
    if not alike:
        return set()

    def sums(version: Version) -> set[tuple]:
        rows = _files(spark, version, alike).select(*digests(version.schema.names), _folder_bucket())
        return {tuple(r) for r in rows.groupBy(BUCKET).agg(*digest_totals()).collect()}

    return {r[0] for r in sums(old) & sums(arrived)}


def _folder_bucket() -> Column:
    """The bucket of a row read from a version's files, by the name of their folder."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"{BUCKET}=([0-9]+)/[^/]*$", 1).cast("int").alias(BUCKET)


def _left(
    spark: SparkSession, old: Version, arrived: Version, buckets: Sequence[int], keys: Sequence[str], date: str | None
) -> dict[int, int]:
    """How many rows of each bucket have a key that the incoming rows don't have. Only keys are read and shuffled.

    Not even these are shuffled where the incoming rows list all keys and go on after the table's newest ``date``.
    """
    if not set(buckets) & set(old.paths):
        return {}
    if date in old.schema.names and lists_all(_files(spark, old, buckets), _files(spark, arrived, buckets), keys, date):
        return {}
    known = _files(spark, old, buckets).select(*keys)
    new = _files(spark, arrived, buckets).select(*keys).withColumnsRenamed({k: f"_new_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    left = known.join(new, same, "left_anti").groupBy(_bucket_of(keys, old.buckets, old.grain).alias(BUCKET))
    return {r[BUCKET]: r["n"] for r in left.agg(F.count(F.lit(1)).alias("n")).collect()}


def _changed(spark: SparkSession, old: Version, arrived: Version, buckets: Sequence[int], keys: Sequence[str]) -> DataFrame | None:
    """The incoming rows of these buckets that the table doesn't have yet."""
    if not buckets:
        return None
    compared = digests(old.schema.names)
    known = _files(spark, old, buckets).select(*keys, *compared).withColumnsRenamed({c: f"_known_{c}" for c in (*keys, *DIGEST)})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in (*keys, *DIGEST)])
    new = _files(spark, arrived, buckets).select("*", *compared)
    return stage(new.join(known, same, "left_anti").drop(*DIGEST), "changed")


def _located(data: str, rows: dict[int, int]) -> tuple[dict[int, str], dict[int, int]]:
    return {b: f"{data}/{BUCKET}={b}" for b in rows}, rows
