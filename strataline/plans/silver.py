"""Silver: the star schema — conformed dimensions, versioned dimensions and facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.functions.countries import with_country_iso
from strataline.functions.scalars import calendar_columns, category_of, outcome, season_of, to_day
from strataline.operators.dedupe import duplicated_keys
from strataline.operators.history import interval_history, merge_points
from strataline.operators.joins import asof_lookup, lookup
from strataline.operators.prepare import project_or_null
from strataline.operators.scd import merge_type1, merge_type2
from strataline.operators.upsert import one_per_key
from strataline.plans.bronze import declared, single_rows
from strataline.plans.concurrent import run_all
from strataline.schemas import SOURCE_ORDER, SOURCE_TABLES
from strataline.session import free_unused, stage
from strataline.settings import Settings
from strataline.sources.store import LayerStore, TableMetrics

SILVER_DIMENSIONS = ("dim_date", "dim_competitions", "dim_clubs", "dim_players", "dim_player_valuations")
SILVER_TABLES = (*SILVER_DIMENSIONS, "fact_games", "fact_appearances")

# Attributes of the player dimension with their types, in order.
PLAYER_ATTRIBUTES = {
    "player_id": "bigint",
    "first_name": "string",
    "last_name": "string",
    "name": "string",
    "last_season": "bigint",
    "current_club_id": "bigint",
    "player_code": "string",
    "country_of_birth": "string",
    "country_of_birth_iso": "string",
    "city_of_birth": "string",
    "country_of_citizenship": "string",
    "country_of_citizenship_iso": "string",
    "date_of_birth": "timestamp_ntz",
    "sub_position": "string",
    "position": "string",
    "position_category": "string",
    "foot": "string",
    "height_in_cm": "bigint",
    "current_club_name": "string",
    "market_value_in_eur": "bigint",
    "highest_market_value_in_eur": "bigint",
    "is_deleted": "bigint",
}

# Attributes whose change opens a new player version.
PLAYER_COMPARE = (
    "current_club_id",
    "current_club_name",
    "market_value_in_eur",
    "position_category",
    "sub_position",
    "last_season",
)

VALUATION_IDENTITY = ("player_id", "valuation_date", "market_value_in_eur", "current_club_id")


def snapshot_day(games: DataFrame, as_of: dt.date | None = None) -> dt.date:
    """The newest game day, else ``as_of``; one of them is needed."""
    day = games.agg(F.max(to_day("date")).alias("day")).first()["day"] or as_of
    if day is None:
        raise ValueError("the snapshot has no dated games; give as_of")
    return day


def build_dim_date(
    frames: Sequence[tuple[DataFrame, Sequence[str]]],
    start_month: int = 8,
    existing: DataFrame | None = None,
) -> DataFrame:
    """One row per calendar day that occurs in the given date columns or already in the dimension."""
    days = [
        df.select(F.explode(F.array(*[to_day(c) for c in present])).alias("day"))
        for df, columns in frames
        if (present := [c for c in columns if c in df.columns])
    ]
    if existing is not None:
        days.append(existing.select(F.col("full_date").alias("day")))
    # Each input is reduced to its distinct days before they are combined.
    distinct = reduce(DataFrame.union, [d.filter("day is not null").distinct() for d in days]).distinct()
    return distinct.select(*calendar_columns("day", start_month))


def prepare_players(players: DataFrame, settings: Settings, countries: DataFrame | None = None) -> DataFrame:
    """Add the position category and ISO codes. Rows neither active nor deleted are left out."""
    known = players.filter(F.coalesce("is_deleted", F.lit(0)).isin(0, 1))
    categorised = known.withColumn(
        "position_category", category_of(["sub_position", "position"], settings.taxonomy)
    )
    return with_country_iso(
        categorised,
        {"country_of_birth_iso": "country_of_birth", "country_of_citizenship_iso": "country_of_citizenship"},
        countries,
    )


def with_effective_date(
    rows: DataFrame, dated: DataFrame, *, key: str, date: str, default: dt.date, deleted: str
) -> DataFrame:
    """Add ``_effective``: the key's latest dated row, else the default; the default for deletions."""
    latest = dated.groupBy(F.col(key).alias("_latest_key")).agg(F.max(to_day(date)).alias("_latest"))
    joined = rows.join(latest, F.col(key) == F.col("_latest_key"), "left")
    day = F.lit(default)
    effective = F.when(F.coalesce(F.col(deleted), F.lit(0)) == 1, day).otherwise(F.coalesce("_latest", day))
    return joined.withColumn("_effective", effective).drop("_latest_key", "_latest")


def build_dim_players(
    players: DataFrame,
    valuations: DataFrame,
    settings: Settings,
    as_of: dt.date,
    existing: DataFrame | None = None,
    countries: DataFrame | None = None,
) -> DataFrame:
    """Versioned player dimension."""
    prepared = prepare_players(players, settings, countries)
    recorded = [(c, prepared.schema[c].dataType.simpleString()) for c in SOURCE_ORDER if c in prepared.columns]
    incoming = with_effective_date(
        project_or_null(prepared, [*PLAYER_ATTRIBUTES.items(), *recorded]),
        valuations,
        key="player_id",
        date="date",
        default=as_of,
        deleted="is_deleted",
    )
    return merge_type2(
        existing,
        incoming,
        key="player_id",
        compare=PLAYER_COMPARE,
        sk="player_sk",
        effective="_effective",
        deleted="is_deleted",
    )


def repeated_days(valuations: DataFrame) -> bool:
    """Whether a player has several valuations on a day. Without, none repeats a key or an identity either."""
    days = valuations.select("player_id", to_day("date").alias("day"))
    return not stage(duplicated_keys(days, ["player_id", "day"]), "repeated_days").isEmpty()


def build_dim_player_valuations(
    valuations: DataFrame, existing: DataFrame | None = None, unique: bool = False
) -> DataFrame:
    """Valuation history, rebuilt from all known points. ``unique`` vouches that no identity is repeated."""
    points = valuations.select(
        "player_id",
        to_day("date").alias("valuation_date"),
        "market_value_in_eur",
        "current_club_id",
        "current_club_name",
        "player_club_domestic_competition_id",
        *[c for c in SOURCE_ORDER if c in valuations.columns],
    )
    points = declared(points if unique else one_per_key(points, VALUATION_IDENTITY))
    known = existing.select(*points.columns) if existing is not None else None
    merged = merge_points(known, points, VALUATION_IDENTITY, unique=True, date="valuation_date")
    return interval_history(
        merged,
        written=unique and merged is points,
        key="player_id",
        date="valuation_date",
        ties=["market_value_in_eur", "current_club_id"],
        sk="valuation_sk",
    )


def build_fact_games(
    games: DataFrame, dim_date: DataFrame, dim_competitions: DataFrame, dim_clubs: DataFrame, start_month: int = 8
) -> DataFrame:
    """Games with results, derived season and surrogate keys."""
    day = games.withColumn("date", to_day("date"))
    keyed = lookup(day, dim_date, {"date": "full_date"}, {"date_sk": "date_sk"}, bounded=True)
    keyed = lookup(keyed, dim_competitions, {"competition_id": "competition_id"}, {"competition_sk": "competition_sk"})
    keyed = lookup(keyed, dim_clubs, {"home_club_id": "club_id"}, {"home_club_sk": "club_sk"})
    keyed = lookup(keyed, dim_clubs, {"away_club_id": "club_id"}, {"away_club_sk": "club_sk"})
    return keyed.select(
        "game_id",
        "competition_id",
        "competition_sk",
        "season",
        season_of("date", start_month).alias("season_derived"),
        "round",
        "date",
        "date_sk",
        "home_club_id",
        "away_club_id",
        "home_club_sk",
        "away_club_sk",
        "home_club_goals",
        "away_club_goals",
        outcome("home_club_goals", "away_club_goals").alias("home_result"),
        outcome("away_club_goals", "home_club_goals").alias("away_result"),
        "home_club_name",
        "away_club_name",
        "stadium",
        "attendance",
        "competition_type",
        *[c for c in SOURCE_ORDER if c in games.columns],
    )


def build_fact_appearances(
    appearances: DataFrame,
    dim_players: DataFrame,
    dim_clubs: DataFrame,
    dim_competitions: DataFrame,
    dim_date: DataFrame,
    fact_games: DataFrame,
) -> DataFrame:
    """Appearances with surrogate keys; the player key is the version valid on the day.

    The rows are shuffled once, for the player's version. The day of the game depends on the game only, and mostly is the
    row's own: distinct (game, date) are compared with the games, and only those of another day are joined to the rows.
    """
    day = appearances.withColumn("date", to_day("date"))
    keyed = asof_lookup(day, dim_players, fact_key="player_id", fact_date="date", dim_key="player_id", sk="player_sk")
    keyed = lookup(keyed, dim_clubs, {"player_club_id": "club_id"}, {"player_club_sk": "club_sk"})
    keyed = lookup(keyed, dim_competitions, {"competition_id": "competition_id"}, {"competition_sk": "competition_sk"})
    keyed = lookup(keyed, dim_date, {"date": "full_date"}, {"date_sk": "date_sk"}, bounded=True)
    keyed = with_game_date(keyed, other_game_days(day, fact_games))
    return keyed.select(
        "appearance_id",
        "game_id",
        "player_id",
        "player_sk",
        "player_club_id",
        "player_club_sk",
        "player_current_club_id",
        "date",
        "date_sk",
        "game_date_sk",
        "player_name",
        "competition_id",
        "competition_sk",
        "yellow_cards",
        "red_cards",
        "goals",
        "assists",
        "minutes_played",
        *[c for c in SOURCE_ORDER if c in appearances.columns],
    )


def other_game_days(appearances: DataFrame, fact_games: DataFrame) -> DataFrame:
    """(_game, _date, _game_date_sk) of the appearances' games and dates that no game has."""
    pairs = appearances.select("game_id", "date").distinct()
    days = fact_games.select(F.col("game_id").alias("_game"), F.col("date").alias("_date"))
    same = (F.col("game_id") == F.col("_game")) & (F.col("date") == F.col("_date"))
    # Both sides are large and shuffled by the same columns, the pairs as distinct ones; an anti join would be pushed
    # below that and shuffle all rows.
    unmatched = pairs.join(days.hint("merge"), same, "left").filter("_game is null").select("game_id", "date")
    other = lookup(stage(unmatched, "other_days"), fact_games, {"game_id": "game_id"}, {"_game_date_sk": "date_sk"})
    return stage(other.select(F.col("game_id").alias("_game"), F.col("date").alias("_date"), "_game_date_sk"), "other_days")


def with_game_date(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Add ``game_date_sk``: the row's ``date_sk``, or what ``other`` has for its game and date."""
    same = rows["game_id"].eqNullSafe(other["_game"]) & rows["date"].eqNullSafe(other["_date"])
    found = rows.join(other.withColumn("_other", F.lit(True)), same, "left")
    day = F.when(F.col("_other"), F.col("_game_date_sk")).otherwise(F.col("date_sk"))
    return found.withColumn("game_date_sk", day).drop("_game", "_date", "_game_date_sk", "_other")


def transform_snapshot(
    store: LayerStore,
    snapshot: str,
    run_id: str,
    previous_run: str | None,
    settings: Settings,
    as_of: dt.date | None = None,
    countries: DataFrame | None = None,
    unique: Collection[str] = (),
    daily: bool = False,
) -> tuple[list[TableMetrics], dt.date]:
    """Merge a snapshot's bronze tables into the previous silver version and write the next one.

    Dimensions are written first and facts read them back, so nothing is computed twice. Rows that repeat a key go
    before the lookups, which keep every row once; ``unique`` names the tables that are known to have none, ``daily``
    says that no player is known to have two valuations on a day.
    """
    bronze: Mapping[str, DataFrame] = store.read_all("bronze", list(SOURCE_TABLES), run_id)
    old = store.read_present("silver", SILVER_DIMENSIONS, previous_run)
    day = snapshot_day(bronze["games"], as_of)
    month = settings.season_start_month

    def write(name: str, df: DataFrame) -> TableMetrics:
        return store.write(df, "silver", name, run_id)

    dated = [(bronze[t], ["date"]) for t in ("games", "appearances", "player_valuations")]
    metrics = run_all(
        [
            lambda: write("dim_date", build_dim_date(dated, month, old.get("dim_date"))),
            lambda: write(
                "dim_competitions",
                merge_type1(
                    old.get("dim_competitions"), bronze["competitions"], key="competition_id", sk="competition_sk"
                ),
            ),
            lambda: write(
                "dim_clubs", merge_type1(old.get("dim_clubs"), bronze["clubs"], key="club_id", sk="club_sk")
            ),
            lambda: write(
                "dim_players",
                build_dim_players(
                    bronze["players"], bronze["player_valuations"], settings, day, old.get("dim_players"), countries
                ),
            ),
            lambda: write(
                "dim_player_valuations",
                build_dim_player_valuations(bronze["player_valuations"], old.get("dim_player_valuations"), daily),
            ),
        ]
    )
    free_unused(store.spark)
    dims = store.read_all("silver", ["dim_date", "dim_competitions", "dim_clubs", "dim_players"], run_id)

    def upsert(name: str, table: str, build: Callable[[DataFrame], DataFrame]) -> None:
        spec = SOURCE_TABLES[table]
        facts, rows = build(single_rows(bronze[table], spec, unique)), bronze[table].count()
        metrics.append(store.upsert(facts, "silver", name, run_id, previous_run, list(spec.key), unique=True, at_most=rows, date="date"))

    shared = (dims["dim_date"], dims["dim_competitions"], dims["dim_clubs"])
    upsert("fact_games", "games", lambda games: build_fact_games(games, *shared, month))
    free_unused(store.spark)
    upsert(
        "fact_appearances",
        "appearances",
        lambda appearances: build_fact_appearances(
            appearances,
            dims["dim_players"],
            dims["dim_clubs"],
            dims["dim_competitions"],
            dims["dim_date"],
            store.read("silver", "fact_games", run_id),
        ),
    )
    store.record_metrics(run_id, snapshot, "silver", metrics)
    return metrics, day
