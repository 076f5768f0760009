from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from strataline.operators.quality import column_checks, drift_check, roll_up, run_checks
from strataline.operators.topk import count_and_first
from strataline.session import shared_dir
from strataline.settings import DEFAULT_RULES, AtLeast, NotNull, QualityRules, References, Unique


def check(spark, tables, **rules):
    found = run_checks(spark, tables, QualityRules(**rules)).collect()
    return [(r.check_type, r.table, r.passed, r.violation_count, json.loads(r.details)) for r in found]


def test_null_check(spark, make):
    t = {"a": make("player_id int, game_id int", (1001, 1), (None, 2))}
    got = check(spark, t, not_null=(NotNull("a", ("player_id", "game_id")),))
    assert got == [("null_check", "a", False, 1, {"columns": {"player_id": 1}})]
    assert check(spark, t, not_null=(NotNull("a", ("absent",)),))[0][2:4] == (False, 2)
    assert check(spark, {"a": t["a"].filter("false")}, not_null=(NotNull("a", ("absent",)),))[0][2]


def test_references(spark, make):
    t = {"a": make("player_id int", (1001,), (9999,), (9999,), (None,)), "p": make("player_id int", (1001,))}
    [got] = check(spark, t, references=(References("a", "player_id", "p", "player_id"),))
    assert got[:4] == ("referential_integrity", "a", False, 1)
    assert got[4]["orphan_keys_sample"] == ["9999"]


def test_sample_is_short(spark, make):
    t = {"a": make("k int", *[(i,) for i in range(30)]), "p": make("k int", (29,))}
    [got] = check(spark, t, references=(References("a", "k", "p", "k"),))
    assert got[3] == 29 and got[4]["orphan_keys_sample"] == [str(i) for i in range(10)]


def test_ranges(spark, make):
    t = {"a": make("id int, minutes string, goals int", (1, "90", -1), (2, "-5", 0), (3, None, None), (4, "n/k", -2))}
    got = check(spark, t, ranges=(AtLeast("a", "minutes", 0), AtLeast("a", "goals", 0), AtLeast("a", "absent", 0)))
    by_column = {g[4]["column"]: g for g in got}
    assert by_column["minutes"][2:4] == (False, 1) and by_column["minutes"][4]["sample"] == ["2"]
    assert by_column["goals"][2:4] == (False, 2) and by_column["goals"][4]["sample"] == ["1", "4"]
    assert by_column["absent"][2:4] == (False, 4) and by_column["absent"][4]["missing_column"] is True
    empty = {"a": t["a"].filter("false")}
    got = check(spark, empty, ranges=(AtLeast("a", "goals", 0), AtLeast("a", "absent", 0)))
    assert {g[4]["column"]: g[2] for g in got} == {"goals": True, "absent": False}


def test_duplicates(spark, make):
    t = {"a": make("appearance_id int, v int", (3001, 1), (3001, 2), (3002, 3), (None, 4), (None, 5))}
    [got] = check(spark, t, unique=(Unique("a", ("appearance_id",)),))
    assert got[2:4] == (False, 4) and "3001" in got[4]["duplicate_keys_sample"]
    [pair] = check(spark, t, unique=(Unique("a", ("appearance_id", "v")),))
    assert pair[2:4] == (True, 0)


def test_drift(make):
    metrics = make("table string, extra_columns array<string>", ("players", ["shoe"]), ("games", []))
    row = drift_check(metrics).first()
    assert (row.passed, row.violation_count) == (False, 1)
    assert json.loads(row.details) == {"tables_with_extra_columns": {"players": ["shoe"]}}


def test_default_rules_and_roll_up(spark, make):
    tables = {
        "appearances": make(
            "appearance_id int, game_id int, player_id int, minutes_played int, goals int", (1, 1, 1, 90, 0), (2, 1, 2, -1, 0)
        ),
        "games": make("game_id int", (1,)),
        "players": make("player_id int", (1,), (2,)),
    }
    metrics = make("table string, extra_columns array<string>", ("players", []))
    assert run_checks(spark, tables, DEFAULT_RULES, metrics).count() == 8
    results = run_checks(spark, tables, DEFAULT_RULES)
    assert tuple(roll_up(results).first()) == (7, 6, 1, 1, False)
    required = QualityRules(DEFAULT_RULES.not_null, DEFAULT_RULES.references, DEFAULT_RULES.ranges)
    assert run_checks(spark, tables, required, metrics).count() == 4
    assert tuple(roll_up(run_checks(spark, tables, QualityRules())).first()) == (0, 0, 0, 0, True)


def test_count_and_first_equals_sorting(spark):
    """Every rule's count and least keys, with nulls, ties and rules that nothing breaks, over several tasks."""
    rng = random.Random(4)
    data = [(rng.choice([None, "b", "a", "ä"]), rng.choice([None, 0.5, float("nan"), -1.0]), rng.choice([True, False, None]), rng.randrange(9)) for _ in range(500)]
    df = spark.createDataFrame(data, "s string, d double, b boolean, v int").repartition(6)
    rules = [F.col("v") < 3, F.col("v") == 8, F.lit(False), F.col("d") < 0, F.lit(None).cast("boolean"), F.lit(True)]
    got = {r["rule"]: (r["n"], [tuple(x) for x in r["first"]]) for r in count_and_first(df, rules, ["s", "d", "b"], 7).collect()}
    for i, rule in enumerate(rules):
        rows = df.filter(F.coalesce(rule, F.lit(False)))
        want = [tuple(r) for r in rows.orderBy("s", "d", "b").limit(7).select("s", "d", "b").collect()]
        assert got[i][0] == rows.count() and repr(got[i][1]) == repr(want), i
    empty = count_and_first(df.limit(0), rules, ["s"], 2).collect()
    assert [(r["n"], r["first"]) for r in sorted(empty, key=lambda r: r["rule"])] == [(0, [])] * len(rules)


def test_all_rules_of_a_table_share_one_scan(spark, make):
    make("id int, a int, b int", (1, None, -1), (2, 5, 5)).write.mode("overwrite").parquet(f"{shared_dir(spark)}/one_scan")
    df = spark.read.parquet(f"{shared_dir(spark)}/one_scan")
    checked = column_checks(df, [NotNull("t", ("a", "b"))], [AtLeast("t", "a", 6), AtLeast("t", "b", 0)], ["id"])
    assert checked._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [(r.check_type, r.violation_count) for r in checked.collect()] == [("null_check", 1), ("valid_range", 1), ("valid_range", 1)]


def test_repeated_and_orphaned_keys_are_found_once_in_jobs_of_their_own(spark, tmp_path, rows):
    from strataline.operators.quality import duplicate_check, reference_check
    from strataline.settings import References, Unique

    spark.sql("select * from values (1L), (1L), (2L), (3L), (null), (null) as t(k)").write.parquet(f"{tmp_path}/t")
    table, parents = spark.read.parquet(f"{tmp_path}/t"), spark.sql("select 2L as p")
    repeated = duplicate_check(table, Unique("t", ("k",)))
    orphaned = reference_check(table, parents, References("t", "k", "p", "p"))
    # What is counted and what is ordered are the keys that were written, not the table again.
    assert not [f for df in (repeated, orphaned) for f in df.inputFiles() if f"{tmp_path}" in f]
    assert rows(repeated, "violation_count", "passed") == [(4, False)]
    assert rows(orphaned, "violation_count", "passed") == [(2, False)]
