from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataline.operators.dedupe import duplicated_rows, keep_first, keep_last
from strataline.operators.dense import dense_ids
from strataline.operators.history import interval_history, merge_points
from strataline.operators.joins import asof_lookup, lookup, new_rows, orphan_keys
from strataline.operators.prepare import SchemaError, cast_declared, conform, project_or_null
from strataline.operators.scd import merge_type1
from strataline.operators.upsert import after_watermark, merge_statistics, newest_day, upsert
from strataline.operators.validity import sweep
from strataline.operators.windows import _Layout, numbered_window, offset_window
from strataline.plans.gold import rolling_mean, valuation_trend
from strataline.schemas import GAMES, PLAYERS

D = dt.date
OPEN = D(9999, 12, 31)


def test_keep_last_and_first_treat_null_keys_as_equal(make, rows):
    df = make("k int, o int, v string", (1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 2, "d"))
    assert rows(keep_last(df, ["k"], ["o"]), "v") == [("b",), ("d",)]
    assert rows(keep_first(df, ["k"], ["o"]), "v") == [("a",), ("c",)]


def test_keep_last_reduces_before_the_shuffle(make):
    df = make("k int, o int", (1, 1))
    plan = keep_last(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_duplicated_rows_returns_all_members(make, rows):
    df = make("k int, v int", (1, 1), (1, 2), (2, 3), (None, 4), (None, 5))
    assert rows(duplicated_rows(df, ["k"]), "v") == [(1,), (2,), (4,), (5,)]


def test_dense_ids_equal_a_global_row_number(spark, rows):
    df = spark.range(5000).select(F.pmod(F.hash("id"), F.lit(97)).alias("g"), "id")
    got = dense_ids(df, ["g", "id"], "n", start=10)
    want = df.withColumn("n", F.row_number().over(Window.orderBy("g", "id")).cast("bigint") + 10)
    assert rows(got, "g", "id", "n") == rows(want, "g", "id", "n")


@pytest.mark.parametrize("block_rows", [16, 100_000])
def test_offset_window_equals_a_plain_window(spark, rows, block_rows):
    df = spark.range(900).select(
        F.when(F.col("id") < 400, None).when(F.col("id") < 860, 1).otherwise(F.col("id") % 7).alias("k"),
        F.col("id").alias("o"),
        F.pmod(F.hash("id"), F.lit(1000)).cast("bigint").alias("v"),
    )

    def both(w, frame):
        return {"m": F.avg("v").over(frame), "next": F.lead("v").over(w)}

    got = offset_window(df, ["k"], ["o"], both, preceding=2, following=1, block_rows=block_rows)
    w = Window.partitionBy("k").orderBy("o")
    want = df.select("*", *[c.alias(n) for n, c in both(w, w.rowsBetween(-2, 1)).items()])
    assert rows(got, "k", "o", "v", "m", "next") == rows(want, "k", "o", "v", "m", "next")


@pytest.mark.parametrize(("preceding", "following"), [(0, 0), (0, 1), (2, 0), (3, 2), (5, 7)])
def test_offset_window_across_chunks_smaller_than_the_frame(spark, rows, preceding, following):
    """Ties and nulls in the order, keys of every size, two key columns; chunks of a few rows."""
    rng = random.Random(preceding * 10 + following)
    data = [
        (rng.choice([None, "a", "a", "a", "b"]), rng.choice([1, 1, 1, 2]), rng.choice([None, *range(4)]), i, rng.randrange(100))
        for i in range(700)
    ]
    df = spark.createDataFrame(data, "k string, l int, o int, p int, v int").repartition(5)

    def all_of(w, frame):
        ahead = {"lead": F.lead("v", following).over(w)} if following else {}
        behind = {"lag": F.lag("v", preceding).over(w)} if preceding else {}
        return {"s": F.sum("v").over(frame), "c": F.count("v").over(frame), **ahead, **behind}

    block = preceding + following + 1
    got = numbered_window(df, ["k", "l"], ["o", "p"], "n", all_of, preceding, following, block_rows=block)
    w = Window.partitionBy("k", "l").orderBy("o", "p")
    want = df.select(
        "*",
        F.row_number().over(Window.orderBy("k", "l", "o", "p")).cast("bigint").alias("n"),
        *[c.alias(n) for n, c in all_of(w, w.rowsBetween(-preceding, following)).items()],
    )
    assert rows(got, *want.columns) == rows(want)
    plain = offset_window(df, ["k", "l"], ["o", "p"], all_of, preceding, following, block_rows=block)
    assert rows(plain, *[c for c in want.columns if c != "n"]) == rows(want.drop("n"))


def test_offset_window_shuffles_rows_once(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id", F.col("id").alias("v"))
    made = offset_window(df, ["k"], ["id"], rolling_mean("v"), preceding=2)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_chunks_of_a_large_key_are_bounded(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 15_000, 1).otherwise(F.col("id")).alias("k"), F.xxhash64("id").alias("o"))
    layout = _Layout(df, ["k"], ["o"], 500)
    sizes = [r["count"] for r in layout.rows.filter("k = 1").groupBy("_chunk").count().collect()]
    # 20,000 rows over four shuffle partitions: a chunk should hold about 5,000.
    assert len(sizes) >= 3 and sum(sizes) == 15_000 and max(sizes) < 10_000
    assert layout.rows.filter("k <> 1 and (_chunk > 0 or _is_cut)").isEmpty()


def test_offset_window_needs_room_for_the_frame(make):
    with pytest.raises(ValueError):
        offset_window(make("k int, p long", (1, 1)), ["k"], ["p"], lambda w, _: {}, preceding=4, block_rows=4)


def test_lookup_never_multiplies_rows(make, rows):
    facts = make("id int, k int", (1, 10), (2, 20), (3, None), (4, 30))
    dim = make("dk int, o int, sk int", (10, 1, 100), (10, 2, 101), (20, 1, 200), (None, 1, 999))
    got = lookup(facts, dim, {"k": "dk"}, {"sk": "sk"}, last_by=["o"])
    assert rows(got, "id", "sk") == [(1, 101), (2, 200), (3, None), (4, None)]


DIM = "key int, sk long, effective_date date, end_date date, is_current boolean"


def _asof_by_definition(facts, versions):
    out = []
    for fid, key, day in facts:
        valid = [v for v in versions if v[0] == key and day and v[2] <= day <= v[3]]
        current = [v for v in versions if v[0] == key and v[4]]
        pick = valid or current
        out.append((fid, max(pick, key=lambda v: (v[2], v[1]))[1] if pick else None))
    return sorted(out, key=repr)


def test_asof_lookup_valid_then_current_then_null(make, rows):
    versions = [
        (1, 1, D(2024, 8, 1), D(2026, 2, 28), False),
        (1, 2, D(2026, 3, 1), OPEN, True),
        (2, 3, D(2024, 8, 1), D(2024, 7, 31), False),
        (2, 4, D(2024, 8, 1), OPEN, True),
        (3, 5, D(2024, 8, 1), D(2025, 1, 1), False),
    ]
    facts = [
        (1, 1, D(2024, 8, 17)), (2, 1, D(2026, 3, 16)), (3, 1, D(2020, 1, 1)), (4, 2, D(2024, 8, 1)),
        (5, 3, D(2025, 1, 1)), (6, 3, D(2025, 1, 2)), (7, 4, D(2025, 1, 1)), (8, None, D(2025, 1, 1)), (9, 1, None),
    ]
    got = asof_lookup(
        make("id int, k int, day date", *facts), make(DIM, *versions),
        fact_key="k", fact_date="day", dim_key="key", sk="sk",
    )
    assert rows(got, "id", "sk") == _asof_by_definition(facts, versions)
    assert dict(rows(got, "id", "sk")) == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5, 6: None, 7: None, 8: None, 9: 2}


def test_sweep_gives_the_winner_of_every_day():
    rng = random.Random(11)
    for _ in range(300):
        items = []
        for key in range(rng.randint(0, 12)):
            first = rng.randrange(30)
            items.append((max(first, 5), rng.randrange(max(first, 5), 45), first, rng.choice([key, None])))
        found = list(sweep(sorted(items, key=lambda x: x[0])))
        assert all(a[1] < b[0] for a, b in zip(found, found[1:], strict=False))
        for day in range(50):
            open_ = [(rank, key is not None, key or 0) for a, b, rank, key in items if a <= day <= b]
            want = max(open_, default=None)
            got = [key for a, b, key in found if a <= day <= b]
            assert got == ([] if want is None else [want[2] if want[1] else None])


def test_asof_lookup_with_overlapping_versions(make, rows):
    rng = random.Random(7)
    day = lambda n: D(2024, 1, 1) + dt.timedelta(days=n)
    versions = []
    for sk in range(1, 60):
        start = rng.randrange(60)
        versions.append((rng.randrange(4), sk, day(start), day(start + rng.randrange(-3, 25)), rng.random() < 0.1))
    facts = [(i, rng.randrange(5), day(rng.randrange(90))) for i in range(400)]
    got = asof_lookup(
        make("id int, k int, day date", *facts), make(DIM, *versions),
        fact_key="k", fact_date="day", dim_key="key", sk="sk",
    )
    assert rows(got, "id", "sk") == _asof_by_definition(facts, versions)


def test_orphans_are_distinct_keys(make, rows):
    child = make("c int", (1001,), (9999,), (9999,), (None,))
    assert rows(orphan_keys(child, "c", make("p int", (1001,), (None,)), "p")) == [(9999,)]


def test_new_rows_count_rows_and_match_nulls(make, rows):
    existing = make("a int, b string", (1, "x"), (2, None))
    incoming = make("a int, b string", (1, "x"), (2, None), (3, "y"), (3, "y"))
    assert rows(new_rows(existing, incoming, ["a", "b"])) == [(3, "y"), (3, "y")]
    assert new_rows(None, incoming, ["a"]).count() == 4


def test_upsert_is_idempotent_and_dedupes_first_loads(make, rows):
    old = make("id int, _src_row long, v string", (1, 1, "old"), (2, 2, "old"), (2, 3, "older wins late"))
    first = upsert(None, old, ["id"])
    assert rows(first, "id", "v") == [(1, "old"), (2, "older wins late")]
    incoming = make("id int, _src_row long, v string", (2, 1, "new"), (3, 2, "new"))
    merged = upsert(first, incoming, ["id"])
    assert rows(merged, "id", "v") == [(1, "old"), (2, "new"), (3, "new")]
    assert rows(upsert(merged, incoming, ["id"])) == rows(merged)


def test_merge_statistics(make):
    incoming = make("id int, d date", (1, D(2024, 1, 1)), (2, D(2024, 1, 2)), (3, D(2024, 1, 3)), (4, None))
    existing = make("id int, d date", (1, D(2024, 1, 1)))
    row = merge_statistics(existing, incoming, ["id"], "d", "2024-01-02").first()
    assert tuple(row) == (4, 3, 1)
    assert tuple(merge_statistics(None, incoming, ["id"], "d", None).first()) == (4, 4, 4)
    assert tuple(merge_statistics(None, incoming, ["id"]).first()) == (4, 4, None)
    assert newest_day(incoming, "d").first().day == "2024-01-03"
    assert newest_day(incoming.filter("false"), "d").first().day is None
    assert incoming.filter(after_watermark(F.col("d"), "2024-01-01")).count() == 2


def test_interval_history(make, rows):
    points = make("p int, d date, v long", (1, D(2024, 9, 1), 2), (1, D(2024, 8, 1), 1), (2, D(2024, 8, 5), 3))
    got = interval_history(points, key="p", date="d", ties=["v"], sk="sk")
    assert rows(got, "sk", "p", "v", "effective_date", "end_date", "is_current") == [
        (1, 1, 1, D(2024, 8, 1), D(2024, 8, 31), False),
        (2, 1, 2, D(2024, 9, 1), OPEN, True),
        (3, 2, 3, D(2024, 8, 5), OPEN, True),
    ]
    assert interval_history(points.filter("false"), key="p", date="d", ties=["v"], sk="sk").count() == 0


def test_interval_history_across_blocks_and_ties(make, rows):
    points = [(i % 2, D(2024, 1, 1) + dt.timedelta(days=i // 4), i) for i in range(60)]
    df = make("p int, d date, v long", *points)
    small = interval_history(df, key="p", date="d", ties=["v"], sk="sk", block_rows=4)
    assert rows(small) == rows(interval_history(df, key="p", date="d", ties=["v"], sk="sk"))
    # Two values on one day both stay; the first of them ends the day before it starts.
    assert small.filter("end_date < effective_date").count() == 30


def test_merge_points_keeps_the_incoming_row(make, rows):
    ddl = "p int, d date, v long, club string"
    known = make(ddl, (1, D(2024, 1, 1), 5, "old"), (1, D(2024, 2, 1), 6, "old"))
    arriving = make(ddl, (1, D(2024, 2, 1), 6, "new"), (1, D(2024, 2, 1), 7, "new"))
    assert rows(merge_points(known, arriving, ["p", "d", "v"]), "v", "club") == [(5, "old"), (6, "new"), (7, "new")]


def test_merge_type1(make, rows):
    first = merge_type1(None, make("k int, _src_row long, n string", (7, 0, "a"), (3, 1, "b"), (7, 2, "c")), key="k", sk="sk")
    assert first.columns == ["sk", "k", "n"]
    assert rows(first) == [(1, 7, "a"), (2, 3, "b")]
    second = merge_type1(
        first, make("k int, _src_row long, n string, more int", (5, 0, "e", 1), (3, 1, None, 1)), key="k", sk="sk"
    )
    assert rows(second) == [(1, 7, "a"), (2, 3, None), (3, 5, "e")]


def test_rolling_mean_rounds_half_even_and_skips_nulls(make):
    ddl = "valuation_sk long, player_id int, valuation_date date, market_value_in_eur long, current_club_id int, current_club_name string, is_current boolean"
    values = [110, 113, None, 125, 126]
    df = make(ddl, *[(i + 1, 1, D(2024, 1, 1 + i), v, 1, "c", False) for i, v in enumerate(values)])
    got = valuation_trend(df, 3).orderBy("valuation_date").collect()
    assert [r.rolling_average_market_value for r in got] == [110, 112, 112, 119, 126]
    ordered = Window.partitionBy("k").orderBy("o")
    assert "_rolling" in rolling_mean("x")(ordered, ordered.rowsBetween(-1, 0))


def test_conform_reports_drift_and_defaults(make):
    columns = [c for c in PLAYERS.columns if c != "is_deleted"]
    df = make(", ".join(f"{c} string" for c in ["unexpected", *reversed(columns)]), tuple(["1"] * 27))
    ready, report = conform(df, PLAYERS)
    assert ready.columns == PLAYERS.columns
    assert report.extra_columns == ("unexpected",) and report.optional_added == ("is_deleted",)
    typed = cast_declared(ready, PLAYERS)
    assert typed.schema == PLAYERS.fields
    assert typed.first().is_deleted == 0


def test_conform_requires_columns(make):
    with pytest.raises(SchemaError, match="missing required columns"):
        conform(make("game_id string, date string", ("1", "2")), GAMES)


def test_project_or_null(make):
    got = project_or_null(make("a int, b int", (1, 2)), {"b": "int", "z": "string", "a": "int"})
    assert got.columns == ["b", "z", "a"] and tuple(got.first()) == (2, None, 1)


def test_only_rows_of_repeated_keys_are_put_in_order(make, rows):
    from strataline.operators.upsert import last_per_key, one_per_key

    ddl = "k long, l string, v long, _src_file string, _src_block long, _src_row long"
    once = make(ddl, (1, "a", 5, "f", 0, 0), (None, "a", 6, "f", 0, 1), (1, None, 7, "f", 0, 2))
    assert one_per_key(once, ["k", "l"]) is once
    twice = once.unionByName(make(ddl, (None, "a", 1, "f", 0, 3), (1, None, 2, "e", 9, 9), (2, "b", 3, "g", 0, 0)))
    got = one_per_key(twice, ["k", "l"])
    assert rows(got) == rows(last_per_key(twice, ["k", "l"])) and got.count() == 4


def test_a_history_reads_what_leads_to_its_points_once(spark, tmp_path, rows):
    import datetime as dt

    from strataline.operators.history import interval_history

    spark.sql("select * from values (1L, date'2024-01-01', 5L), (1L, date'2024-02-01', 6L) as t(k, day, v)").write.parquet(f"{tmp_path}/t")
    history = interval_history(spark.read.parquet(f"{tmp_path}/t"), key="k", date="day", ties=["v"], sk="sk")
    assert not [f for f in history.inputFiles() if f"{tmp_path}" in f]
    assert rows(history, "sk", "v", "end_date") == [(1, 5, dt.date(2024, 1, 31)), (2, 6, dt.date(9999, 12, 31))]


def test_asof_lookup_shuffles_facts_once(make, spark, monkeypatch):
    monkeypatch.setattr("strataline.operators.joins.disjoint_intervals", lambda v, *_: v.select(
        "_k", F.lit(0).alias("_chunk"), F.col("_start").alias("_from"), F.col("_end").alias("_to"), "_sk"))
    facts = make("k int, day date, wide string", (1, D(2024, 1, 1), "x"), (1, None, "y"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = asof_lookup(facts, make(DIM, (1, 7, D(2024, 1, 1), OPEN, True)), fact_key="k", fact_date="day", dim_key="key", sk="sk")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Above the scan of the wide column there is one exchange, that of the join.
    above = plan[: plan.index("wide#", plan.index("Exchange"))]
    assert above.count("SortMergeJoin") == 1 and above.count("Exchange hashpartitioning") == 1
    assert [r.sk for r in got.collect()] == [7, 7]


def test_lists_all_says_whether_history_is_repeated(make):
    from strataline.operators.upsert import lists_all

    ddl = "k long, day date"
    known = make(ddl, (1, D(2024, 1, 1)), (None, D(2024, 1, 2)), (3, None))
    later = make(ddl, (4, D(2024, 1, 3)))
    assert lists_all(known, known.unionByName(later), ["k"], "day")
    assert not lists_all(known, known.filter("k = 1").unionByName(later), ["k"], "day")
    assert not lists_all(known, known.unionByName(make(ddl, (4, D(2024, 1, 2)))), ["k"], "day")
    assert lists_all(known.limit(0), later, ["k"], "day") and lists_all(make(ddl, (3, None)), make(ddl, (3, None), (4, D(2024, 1, 3))), ["k"], "day")
    assert not lists_all(make(ddl, (3, None)), make(ddl, (4, None)), ["k"], "day")
