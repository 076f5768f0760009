from __future__ import annotations

import datetime as dt
import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strataline.operators.quality import QualityError
from strataline.plans.gold import club_performance, player_performance, valuation_trend
from strataline.plans.silver import SILVER_TABLES, snapshot_day
from strataline.plans.snapshots import OutOfOrderError, pending, run_incremental, run_snapshot
from strataline.settings import Settings
from strataline.sources.store import LayerStore
from tests.conftest import write_table

D = dt.date
OPEN = D(9999, 12, 31)


@pytest.fixture(scope="module")
def done(spark, feed, tmp_path_factory):
    store = LayerStore(spark, str(tmp_path_factory.mktemp("store")))
    summary = run_incremental(store, feed)
    return store, summary, store.last_run().run_id


def test_both_snapshots_run_in_order(done):
    store, summary, _ = done
    assert (summary.processed, summary.skipped, summary.watermark) == (["week1", "week2"], [], "2024-09-01")
    stats = json.loads(store.last_run().merge_stats)
    assert stats["games"] == {"incoming_rows": 5, "new_keys": 2, "rows_after_watermark": 2, "cumulative_rows": 5}
    assert stats["appearances"] == {"incoming_rows": 9, "new_keys": 3, "rows_after_watermark": 3, "cumulative_rows": 9}
    assert stats["clubs"] == {"incoming_rows": 4, "new_keys": 1, "cumulative_rows": 4}
    first = json.loads(store.ledger().orderBy("seq").first().merge_stats)
    assert first["games"]["rows_after_watermark"] == 3 and "rows_after_watermark" not in first["appearances"]


def test_silver_tables_and_metrics(done):
    store, _, run = done
    counts = {r.table: r.row_count for r in store.metrics("silver", run).collect()}
    assert counts == {
        "dim_date": 10, "dim_competitions": 2, "dim_clubs": 4, "dim_players": 7, "dim_player_valuations": 6,
        "fact_games": 5, "fact_appearances": 9,
    }
    assert set(counts) == set(SILVER_TABLES)
    assert store.latest_quality("week2").count() == 8


def test_player_versions(done, rows):
    store, _, run = done
    dim = store.read("silver", "dim_players", run)
    assert rows(dim, "player_sk", "player_id", "current_club_id", "effective_date", "end_date", "is_current") == [
        (1, 11, 1, D(2023, 8, 1), D(2024, 8, 29), False),
        (2, 12, 1, D(2023, 8, 5), D(2023, 8, 4), False),
        (3, 13, 2, D(2023, 8, 1), D(2024, 8, 31), False),
        (4, 14, 3, D(2023, 12, 1), OPEN, True),
        (5, 11, 2, D(2024, 8, 30), OPEN, True),
        (6, 12, 1, D(2023, 8, 5), OPEN, True),
        (7, 15, 3, D(2024, 9, 1), OPEN, True),
    ]
    assert rows(dim.filter("is_current"), "player_id", "position_category", "country_of_birth_iso") == [
        (11, "Attack", "GB"), (12, "Midfield", "NO"), (14, None, "KR"), (15, "Defence", "BR"),
    ]


def test_facts_point_to_the_version_of_the_day(done, rows):
    store, _, run = done
    facts = store.read("silver", "fact_appearances", run)
    assert [sk for _, sk in rows(facts, "appearance_id", "player_sk")] == [1, 6, 3, 1, 4, 3, 5, 6, 7]
    games = store.read("silver", "fact_games", run)
    assert rows(games, "game_id", "date_sk", "season_derived", "home_club_sk", "away_club_sk", "home_result", "away_result") == [
        (101, 20230820, 2023, 1, 2, "W", "L"),
        (102, 20230910, 2023, 3, 1, "D", "D"),
        (103, 20240302, 2023, 2, None, "L", "W"),
        (104, 20240818, 2024, 1, 3, None, None),
        (105, 20240901, 2024, 2, 1, "W", "L"),
    ]
    assert rows(store.read("silver", "dim_clubs", run), "club_sk", "name") == [
        (1, "North United"), (2, "South"), (3, "East"), (4, "West"),
    ]


def test_player_mart(done, rows):
    store, _, run = done
    assert rows(store.read("gold", "gold_player_performance", run)) == sorted(
        [
            (11, 2023, 2, 1, 0, 135, "Ann", "Attack", 2, "South"),
            (11, 2024, 1, 3, 0, 90, "Ann", "Attack", 2, "South"),
            (12, 2023, 1, 1, 1, 80, "Bo", "Midfield", 1, "North"),
            (12, 2024, 1, 2, 0, 90, "Bo", "Midfield", 1, "North"),
            (13, 2023, 2, 1, 0, 180, None, None, None, None),
            (14, 2023, 1, 0, 0, 90, "Di", None, 3, "East"),
            (15, 2024, 1, 0, 1, 30, "Ed", "Defence", 3, "East"),
        ],
        key=repr,
    )


def test_club_mart(done, rows):
    store, _, run = done
    mart = store.read("gold", "gold_club_performance", run)
    assert mart.columns[:3] == ["club_id", "season", "club_name"]
    assert rows(mart) == [
        (1, 2023, "North United", 2, 1, 0, 1, 2, 1),
        (1, 2024, "North United", 2, 0, 1, 0, 2, 4),
        (2, 2023, "South", 2, 0, 2, 0, 2, 5),
        (2, 2024, "South", 1, 1, 0, 0, 4, 2),
        (3, 2023, "East", 1, 0, 0, 1, 0, 0),
        (3, 2024, "East", 1, 0, 0, 0, 0, 0),
        (9, 2023, "Guests", 1, 1, 0, 0, 3, 1),
    ]


def test_trend_mart(done, rows):
    store, _, run = done
    trend = store.read("gold", "gold_player_valuation_trend", run)
    assert rows(trend, "player_id", "market_value", "rolling_average_market_value", "is_current") == [
        (11, 100, 100.0, False), (11, 150, 125.0, False), (11, 151, 134.0, True), (12, 200, 200.0, True),
        (13, 300, 300.0, True), (14, 400, 400.0, True),
    ]


def test_unchanged_feed_is_skipped_and_force_rebuilds(done, feed, rows, spark, tmp_path):
    store, _, run = done
    again = run_incremental(store, {**feed, "week3": str(tmp_path / "absent")})
    assert (again.processed, again.skipped) == ([], ["week1", "week2", "week3"])
    forced = run_incremental(store, feed, force=True)
    assert forced.processed == ["week1", "week2"]
    new = store.last_run().run_id
    for layer, table in (("silver", "dim_players"), ("silver", "fact_appearances"), ("gold", "gold_club_performance")):
        assert rows(store.read(layer, table, new)) == rows(store.read(layer, table, run))


def test_failed_rebuild_leaves_the_published_run(done, feed, tmp_path):
    store, _, _ = done
    before = store.last_run()
    bad = tmp_path / "week2"
    shutil.copytree(feed["week2"], bad)
    lines = (bad / "appearances.csv").read_text().splitlines()
    (bad / "appearances.csv").write_text("\n".join(line.replace(",90", ",-90") for line in lines) + "\n")
    with pytest.raises(QualityError):
        run_incremental(store, {**feed, "week2": str(bad)}, force=True)
    assert store.last_run() == before


def test_failed_checks_publish_nothing(spark, feed, tmp_path):
    bad = tmp_path / "week1"
    shutil.copytree(feed["week1"], bad)
    lines = (bad / "appearances.csv").read_text().splitlines()
    (bad / "appearances.csv").write_text("\n".join(line.replace(",90", ",-90") for line in lines) + "\n")
    store = LayerStore(spark, str(tmp_path / "store"))
    with pytest.raises(QualityError, match="1 of 8 checks failed"):
        run_incremental(store, {"week1": str(bad)})
    assert store.last_run() is None
    failed = store.latest_quality("week1").filter("not passed").first()
    assert (failed.check_type, failed.violation_count) == ("valid_range", 4)
    assert not (Path(store.root) / "cumulative").exists()
    summary = run_incremental(store, {"week1": str(bad)}, Settings(fail_on_error=False))
    assert summary.processed == ["week1"]


def test_older_snapshot_is_refused(spark, make, feed, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"))
    store.publish("week1", "r1", "other content", "2024-03-02", {})
    store.publish("week2", "r2", "whatever", "2024-09-01", {})
    with pytest.raises(OutOfOrderError):
        run_incremental(store, feed)


def test_pending_compares_with_the_latest_row(make, rows):
    ledger = make("seq long, snapshot string, content_hash string", (1, "s", "A"), (2, "s", "B"), (3, "t", "A"))
    sources = make("snapshot string, content_hash string", ("s", "A"), ("t", "A"), ("u", "A"))
    assert rows(pending(sources, ledger), "snapshot") == [("s",), ("u",)]
    assert pending(sources, ledger, force=True).count() == 3


def test_empty_inputs_give_empty_marts(done, make):
    store, _, run = done
    empty = {t: store.read("silver", t, run).filter("false") for t in SILVER_TABLES}
    assert player_performance(empty["fact_appearances"], empty["dim_date"], empty["dim_players"]).count() == 0
    assert club_performance(empty["fact_games"], empty["dim_clubs"]).count() == 0
    assert valuation_trend(empty["dim_player_valuations"]).count() == 0


def test_snapshot_day_needs_games_or_a_date(make):
    empty = make("date timestamp_ntz").filter("false")
    assert snapshot_day(empty, D(2024, 1, 1)) == D(2024, 1, 1)
    with pytest.raises(ValueError):
        snapshot_day(empty)


def test_quoted_and_missing_values_survive_the_job(spark, tmp_path):
    root = tmp_path / "s"
    write_table(root, "clubs", [{"club_id": 1, "name": 'The "Reds", FC'}])
    write_table(root, "competitions", [])
    write_table(root, "players", [{"player_id": 1, "name": "N/A", "is_deleted": ""}])
    write_table(root, "games", [{"game_id": 1, "date": "2024-01-01", "home_club_id": 1, "away_club_id": "null"}])
    write_table(root, "appearances", [])
    write_table(root, "player_valuations", [])
    store = LayerStore(spark, str(tmp_path / "store"))
    run_incremental(store, {"s": str(root)})
    run = store.last_run().run_id
    assert store.read("gold", "gold_club_performance", run).first().club_name == 'The "Reds", FC'
    assert store.read("silver", "dim_players", run).first().name is None
    assert store.read("gold", "gold_player_performance", run).count() == 0


def test_older_snapshot_is_refused_whoever_calls(spark, feed, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"))
    store.publish("week1", "r1", "other content", "2024-03-02", {})
    store.publish("week2", "r2", "whatever", "2024-09-01", {})
    with pytest.raises(OutOfOrderError):
        run_snapshot(store, "week1", feed["week1"], Settings(), content_hash="changed")


def test_game_date_is_the_games_own(make, rows):
    from strataline.plans.silver import other_game_days, with_game_date

    games = make("game_id long, date date, date_sk int", (1, D(2024, 1, 1), 101), (2, D(2024, 1, 2), 102), (3, None, None))
    ddl = "appearance_id long, game_id long, date date, date_sk int"
    facts = make(
        ddl, (1, 1, D(2024, 1, 1), 101), (2, 1, D(2024, 1, 5), 105), (3, 2, None, None), (4, 3, D(2024, 1, 1), 101),
        (5, 9, D(2024, 1, 1), 101), (6, None, D(2024, 1, 1), 101), (7, 1, D(2024, 1, 5), 105), (8, None, None, None),
    )
    other = other_game_days(facts, games)
    assert other.count() == 6
    want = [(1, 101), (2, 101), (3, 102), (4, None), (5, None), (6, None), (7, 101), (8, None)]
    assert rows(with_game_date(facts, other), "appearance_id", "game_date_sk") == want


def test_names_are_read_back_for_few_games_without_a_shuffle(spark, make, tmp_path):
    games = spark.range(2000).select(
        F.col("id").alias("game_id"), F.lit(2023).alias("season_derived"), F.lit(1).alias("home_club_id"), F.lit(9).alias("away_club_id"),
        F.lit("W").alias("home_result"), F.lit("L").alias("away_result"), F.lit(1).alias("home_club_goals"), F.lit(0).alias("away_club_goals"),
        F.lit("North").alias("home_club_name"), F.concat(F.lit("Guests "), F.col("id") % 7).alias("away_club_name"),
    )
    games.write.parquet(f"{tmp_path}/games")
    mart = club_performance(spark.read.parquet(f"{tmp_path}/games"), make("club_id int, name string", (1, "North")))
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert {(r.club_id, r.club_name, r.matches_played) for r in mart.collect()} == {(1, "North", 2000), (9, "Guests 0", 2000)}


def test_repeated_days_and_valuations_of_a_day(make, rows):
    from strataline.plans.silver import build_dim_player_valuations, repeated_days

    ddl = (
        "player_id long, date timestamp_ntz, market_value_in_eur long, current_club_name string, current_club_id long, "
        "player_club_domestic_competition_id string, _src_file string, _src_block long, _src_row long"
    )
    at = dt.datetime
    one = [(1, at(2024, 1, 1), 5, "a", 1, None, "f", 0, 0), (1, at(2024, 2, 1), 6, "a", 1, None, "f", 0, 1)]
    twice = [*one, (1, at(2024, 2, 1, 9), 6, "b", 1, None, "f", 0, 2)]
    assert not repeated_days(make(ddl, *one)) and repeated_days(make(ddl, *twice))
    first = build_dim_player_valuations(make(ddl, *one), unique=True)
    assert rows(first, "valuation_sk", "market_value_in_eur") == [(1, 5), (2, 6)]
    # The later row of the same identity stays; a point that the feed dropped is kept.
    second = build_dim_player_valuations(make(ddl, *twice[1:]), first)
    assert rows(second, "valuation_sk", "current_club_name") == [(1, "a"), (2, "b")]
    third = build_dim_player_valuations(make(ddl, one[1]), first, unique=True)
    assert rows(third, "valuation_sk", "market_value_in_eur") == [(1, 5), (2, 6)]
