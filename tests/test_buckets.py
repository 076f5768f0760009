"""Key-bucketed versions: the same rows as a plain upsert, while untouched buckets are referred to."""

from __future__ import annotations

import os
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strataline.operators.upsert import upsert
from strataline.sources.buckets import BUCKET, _manifest, load_version, read_buckets, upsert_buckets
from strataline.sources.store import LayerStore

DDL = "k long, l string, v long, t timestamp_ntz"


def data(rng: random.Random, n: int, keys: int) -> list[tuple]:
    return [(rng.choice([None, *range(keys)]), rng.choice(["a", "b", None]), rng.choice([None, *range(5)]), None) for _ in range(n)]


def files_of(path: str) -> set[str]:
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and "manifest" not in d}


@pytest.mark.parametrize("bucket_rows", [8, 1 << 22])
def test_versions_equal_plain_upserts(spark, tmp_path, rows, bucket_rows):
    rng = random.Random(bucket_rows)
    known, previous = None, None
    for step, n in enumerate([60, 10, 0, 150]):
        incoming = spark.createDataFrame(data(rng, n, 40 * (step + 1)), DDL)
        known = spark.createDataFrame(upsert(known, incoming, ["k", "l"]).collect(), DDL)
        path = f"{tmp_path}/v{step}"
        version = upsert_buckets(previous, path, incoming, ["k", "l"], bucket_rows)
        assert rows(read_buckets(spark, path)) == rows(known) and version.row_count == known.count()
        assert load_version(spark, path) == version == _manifest(spark, path)
        previous = path
    # Earlier versions are still what they were.
    assert read_buckets(spark, f"{tmp_path}/v0").count() <= 60


def test_bytes_written_follow_the_increment(spark, tmp_path, rows):
    table = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    one, two = f"{tmp_path}/1", f"{tmp_path}/2"
    first = upsert_buckets(None, one, table, ["k"], 500)
    assert first.buckets == 64 and len(first.paths) == 64
    # A full extract that changes two rows and adds one.
    changed = table.withColumn("v", F.when(F.col("k").isin(17, 1234), -1).otherwise(F.col("v"))).union(spark.sql("select 20000L, 7L"))
    second = upsert_buckets(one, two, changed, ["k"], 500)
    touched = {b for b in second.paths if second.paths[b] != first.paths.get(b)}
    assert 1 <= len(touched) <= 3 and all(second.paths[b].startswith(two) for b in touched)
    size = lambda path: sum(map(os.path.getsize, files_of(path)))
    assert size(two) < 0.1 * size(one)
    assert rows(read_buckets(spark, two)) == rows(changed) and rows(read_buckets(spark, one)) == rows(table)
    # Nothing new writes nothing.
    third = upsert_buckets(two, f"{tmp_path}/3", changed, ["k"], 500)
    assert files_of(f"{tmp_path}/3") == set() and third.paths == second.paths


def test_only_touched_buckets_are_read_and_old_rows_are_not_shuffled(spark, tmp_path):
    table = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    upsert_buckets(None, f"{tmp_path}/1", table, ["k"], 100)
    version = upsert_buckets(f"{tmp_path}/1", f"{tmp_path}/2", spark.sql("select 3L as k, -1L as v"), ["k"], 100)
    held = read_buckets(spark, f"{tmp_path}/2").filter("k = 3").first()
    assert held["v"] == -1
    of_three = next(b for b in version.paths if version.paths[b].startswith(f"{tmp_path}/2"))
    assert len(files_of(f"{tmp_path}/2")) <= version.rows[of_three] and version.paths[of_three].endswith(f"{BUCKET}={of_three}")


def test_buckets_double_as_the_table_grows(spark, tmp_path, rows):
    table = spark.range(1000).select(F.col("id").alias("k"))
    first = upsert_buckets(None, f"{tmp_path}/1", table.filter("k < 100"), ["k"], 50)
    second = upsert_buckets(f"{tmp_path}/1", f"{tmp_path}/2", table, ["k"], 50)
    assert (first.buckets, second.buckets) == (2, 32)
    assert rows(read_buckets(spark, f"{tmp_path}/2")) == rows(table)


def test_new_columns_are_null_in_earlier_rows(spark, tmp_path, make, rows):
    upsert_buckets(None, f"{tmp_path}/1", make("k int, v int", (1, 10), (2, 20)), ["k"])
    upsert_buckets(f"{tmp_path}/1", f"{tmp_path}/2", make("v int, k int, w string", (30, 2, "x")), ["k"])
    assert rows(read_buckets(spark, f"{tmp_path}/2"), "k", "v", "w") == [(1, 10, None), (2, 30, "x")]
    upsert_buckets(f"{tmp_path}/2", f"{tmp_path}/3", make("k int, v int", (1, 11)), ["k"])
    assert rows(read_buckets(spark, f"{tmp_path}/3"), "k", "v", "w") == [(1, 11, None), (2, 30, "x")]


def test_empty_tables(spark, tmp_path, make):
    empty = make("k int, v int", (1, 1)).filter("false")
    version = upsert_buckets(None, f"{tmp_path}/1", empty, ["k"])
    assert version.row_count == 0 and read_buckets(spark, f"{tmp_path}/1").columns == ["k", "v"]
    upsert_buckets(f"{tmp_path}/1", f"{tmp_path}/2", make("k int, v int", (5, 6)), ["k"])
    assert [tuple(r) for r in read_buckets(spark, f"{tmp_path}/2").collect()] == [(5, 6)]


def test_store_reads_both_kinds_of_tables(spark, tmp_path, make, rows):
    store = LayerStore(spark, str(tmp_path))
    store.write(make("k int, v int", (1, 1), (2, 2)), "cumulative", "t", "r1")
    metrics = store.upsert(make("k int, v int", (2, 3)), "cumulative", "t", "r2", "r1", ["k"])
    assert metrics.row_count == 2 and rows(store.read("cumulative", "t", "r2")) == [(1, 1), (2, 3)]
    store.upsert(make("k int, v int", (4, 4)), "cumulative", "t", "r3", "r2", ["k"])
    assert rows(store.read_present("cumulative", ["t", "absent"], "r3")["t"]) == [(1, 1), (2, 3), (4, 4)]


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_rows_are_written_by_bucket_without_a_shuffle_or_a_sort(spark, tmp_path, rows, monkeypatch):
    from strataline.sources import buckets

    plans, save = [], buckets._save
    monkeypatch.setattr(buckets, "_save", lambda df, path: (plans.append(df), save(df, path)))
    table = spark.range(3000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    one, two = f"{tmp_path}/1", f"{tmp_path}/2"
    upsert_buckets(None, one, table.filter("k < 2000"), ["k"], 500, unique=True, at_most=2000)
    # A full extract: every known key is replaced, so its rows are all there is to write.
    upsert_buckets(one, two, table.withColumn("v", F.col("v") + 1), ["k"], 500, unique=True, at_most=3000)
    assert len(plans) == 2 and not any(map(shuffles, plans))
    assert rows(read_buckets(spark, two)) == rows(table.withColumn("v", F.col("v") + 1))
    assert rows(read_buckets(spark, one)) == rows(table.filter("k < 2000"))
    assert spark.conf.get(buckets._WRITERS, "0") == "0"


def test_buckets_with_rows_that_are_left_keep_them(spark, tmp_path, rows):
    table = spark.range(400).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    one, two = f"{tmp_path}/1", f"{tmp_path}/2"
    first = upsert_buckets(None, one, table, ["k"], 50)
    some = table.filter("v % 7 = 0").withColumn("v", F.when(F.col("v") % 14 == 0, -F.col("v") - 1).otherwise(F.col("v")))
    second = upsert_buckets(one, two, some.union(some), ["k"], 50)
    assert rows(read_buckets(spark, two)) == rows(upsert(table, some, ["k"])) and second.rows == first.rows
    # Rows that the table has already, and no others, change nothing.
    third = upsert_buckets(two, f"{tmp_path}/3", some.filter("v >= 0"), ["k"], 50)
    assert third.paths == second.paths and files_of(f"{tmp_path}/3") == set()


def test_new_keys_are_counted_by_the_merge(spark, tmp_path, monkeypatch):
    from strataline.sources import buckets

    ddl = "k long, day date"
    days = spark.range(400).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.expr("date'2024-01-01' + int(id div 10)").alias("day"))
    known, table = days.filter("coalesce(k, 0) < 300"), days.localCheckpoint()
    store, files = LayerStore(spark, str(tmp_path), bucket_rows=50), buckets._files
    args = {"unique": True, "at_most": 400, "date": "day"}
    assert store.upsert(known, "cumulative", "t", "1", None, ["k"], **args).new_keys == 300
    # History as it was, and later days: no keys are joined.
    joined: list = []
    monkeypatch.setattr(buckets, "_folder_bucket", lambda: joined.append(1) or F.lit(0).alias(BUCKET))
    assert store.upsert(table, "cumulative", "t", "2", "1", ["k"], **args).new_keys == 100
    monkeypatch.undo()
    # Some rows are left out, one key moved to another day, one is new on an earlier day.
    changed = table.filter("coalesce(k, 0) % 7 = 0").unionByName(spark.createDataFrame([(1000, None), (5, None)], ddl))
    third = store.upsert(changed, "cumulative", "t", "3", "2", ["k"], **args)
    assert (third.new_keys, third.row_count) == (1, 401)
    assert store.upsert(changed, "cumulative", "t", "4", "3", ["k"], **args).new_keys == 0
    assert buckets._files is files


def test_neighbouring_keys_are_placed_together_and_merged(spark, tmp_path, rows, monkeypatch):
    from strataline.sources import buckets

    monkeypatch.setattr(buckets, "GRAIN", 4)
    size, one, two = 1024 << 4, f"{tmp_path}/1", f"{tmp_path}/2"
    table = spark.range(-100, 70000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), F.col("id").alias("v"))
    first = upsert_buckets(None, one, table, ["k"], size)
    assert (first.grain, first.buckets) == (4, 8) and _manifest(spark, one) == first and min(first.rows.values()) > 5000
    of = F.regexp_extract("_metadata.file_path", f"{BUCKET}=([0-9]+)", 1)
    blocks = spark.read.parquet(*first.paths.values()).select(F.floor(F.col("k") / 16).alias("block"), of.alias("b"))
    assert blocks.distinct().groupBy("block").count().filter("count > 1").isEmpty()
    some = table.filter("v % 1000 = 0 or v = 7").withColumn("v", -F.col("v")).union(spark.sql("select 90000L, 1L"))
    second = upsert_buckets(one, two, some, ["k"], size)
    assert (second.grain, second.new_keys) == (4, 1) and rows(read_buckets(spark, two)) == rows(upsert(table, some, ["k"]))
    # Earlier versions keep the places they had.
    monkeypatch.setattr(buckets, "GRAIN", 20)
    assert upsert_buckets(None, f"{tmp_path}/3", table.limit(9), ["k"], size).grain == 0
    assert upsert_buckets(two, f"{tmp_path}/4", some, ["k"], size).grain == 4


def test_columns_in_runs_have_no_dictionary_and_take_less_room(spark, tmp_path):
    """A game's rows lie together; the numbers of a dictionary would hide that their values repeat."""
    rows = spark.range(60_000, numPartitions=1).select(
        F.col("id").alias("appearance_id"),
        F.floor(F.xxhash64(F.floor(F.col("id") / 3)) % 20_000).alias("player_id"),
        (F.col("id") % 7).alias("goals"),
    )
    rows.write.option("compression", "zstd").parquet(f"{tmp_path}/before")
    version = upsert_buckets(None, f"{tmp_path}/v1", rows, ["appearance_id"], unique=True, at_most=60_000)
    metrics = LayerStore(spark, f"{tmp_path}/store").write(rows, "silver", "t", "r")
    assert version.row_count == metrics.row_count == 60_000
    folders = [next(iter(version.paths.values())), f"{tmp_path}/store/silver/t/run=r"]

    def chunks(folder: str) -> dict:
        (file,) = Path(folder).glob("*.parquet")
        group = pq.ParquetFile(file).metadata.row_group(0)
        return {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}

    before = chunks(f"{tmp_path}/before")
    for folder in folders:
        now = chunks(folder)
        assert not now["player_id"].has_dictionary_page and now["goals"].has_dictionary_page
        assert now["player_id"].total_compressed_size < 0.8 * before["player_id"].total_compressed_size
        same = spark.read.parquet(folder).select(rows.columns)
        assert same.exceptAll(rows).isEmpty() and rows.exceptAll(same).isEmpty()
