"""Gold: analyst marts, rebuilt in full from silver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions.scalars import half_even, to_day
from strataline.operators.dedupe import keep_first
from strataline.operators.joins import lookup
from strataline.operators.windows import offset_window
from strataline.plans.concurrent import run_all
from strataline.session import stage
from strataline.settings import Settings
from strataline.sources.store import LayerStore, TableMetrics

GOLD_TABLES = ("gold_player_performance", "gold_club_performance", "gold_player_valuation_trend")


def total(c: str) -> Column:
    """Sum that is 0, not null, when every value is null."""
    return F.coalesce(F.sum(c), F.lit(0))


def performance(
    rows: DataFrame, subjects: DataFrame, *, key: str, game: str, measures: dict[str, str], attributes: dict[str, str]
) -> DataFrame:
    """Subject by season: distinct games and summed measures, with the subject's attributes.

    Rows without a key or a season do not count. ``subjects`` has one row per key; subjects without
    one keep null attributes.
    """
    measured = (
        rows.dropna(subset=[key, "season"])
        .groupBy(key, "season")
        .agg(F.countDistinct(game).alias("matches_played"), *[total(c).alias(out) for out, c in measures.items()])
    )
    return lookup(measured, subjects, {key: key}, attributes)


def player_performance(fact_appearances: DataFrame, dim_date: DataFrame, dim_players: DataFrame) -> DataFrame:
    """Player by season: games, goals, assists, minutes, and the player's current attributes.

    The season is that of the appearance's day in the calendar.
    """
    current = keep_first(dim_players.filter("is_current"), ["player_id"], ["effective_date", "player_sk"])
    return performance(
        lookup(fact_appearances, dim_date, {"date_sk": "date_sk"}, {"season": "season"}, bounded=True),
        current,
        key="player_id",
        game="game_id",
        measures={"total_goals": "goals", "total_assists": "assists", "total_minutes": "minutes_played"},
        attributes={a: a for a in ("name", "position_category", "current_club_id", "current_club_name")},
    )


def two_sided(games: DataFrame, sides: list[dict[str, str]]) -> DataFrame:
    """One row per side of each row: ``side`` (0, 1, ...) and the side's columns, from a single scan."""
    structs = [
        F.struct(F.lit(i).alias("side"), *[F.col(c).alias(out) for out, c in side.items()])
        for i, side in enumerate(sides)
    ]
    shared = [c for c in games.columns if not any(c in side.values() for side in sides)]
    return games.select(*shared, F.inline(F.array(*structs)))


# The sides of a game: home first.
SIDES = 2


def club_performance(fact_games: DataFrame, dim_clubs: DataFrame) -> DataFrame:
    """Club by derived season: games, wins, losses, draws and goals over home and away games.

    A game without a result counts as played. The name is the dimension's, else the first one recorded
    with the club's games of that season, home games first.
    """
    home = {
        "club_id": "home_club_id", "named": "_home_named", "result": "home_result",
        "scored": "home_club_goals", "conceded": "_conceded_home",
    }
    away = {
        "club_id": "away_club_id", "named": "_away_named", "result": "away_result",
        "scored": "away_club_goals", "conceded": "_conceded_away",
    }
    games = fact_games.select(
        "game_id", F.col("season_derived").alias("season"), "home_club_id", "away_club_id", "home_result", "away_result",
        "home_club_goals", "away_club_goals", F.col("home_club_goals").alias("_conceded_away"),
        F.col("away_club_goals").alias("_conceded_home"), F.col("home_club_name").isNotNull().alias("_home_named"),
        F.col("away_club_name").isNotNull().alias("_away_named"),
    )
    perspectives = two_sided(games, [home, away]).dropna(subset=["club_id", "season"])

    def recorded(winners: DataFrame) -> DataFrame:
        named = fact_games.select(
            "game_id", F.col("season_derived").alias("season"), "home_club_id", "away_club_id", "home_club_name", "away_club_name"
        )
        first = named.join(winners.select("game_id").distinct(), "game_id", "left_semi")
        sides = [{"club_id": f"{x}_club_id", "recorded_name": f"{x}_club_name"} for x in ("home", "away")]
        return two_sided(first, sides)

    names = dim_clubs.select("club_id", "name")
    return side_performance(perspectives, names, recorded, key="club_id", name="club_name")


def side_performance(
    perspectives: DataFrame, names: DataFrame, recorded: Callable[[DataFrame], DataFrame], *, key: str, name: str
) -> DataFrame:
    """Results per ``key`` and season from rows (key, season, side, game_id, named, result, scored, conceded).

    ``names`` has one row (key, name) per known key. A key that it doesn't name takes the first name recorded with
    its games, in order of side and game. Rows are aggregated by key and season alone, together with the first
    ``named`` game of each side, in a hash table with fixed-size buffers. Only for keys without a name are those
    games' names read: ``recorded`` takes (key, season, side, game_id) of these few and gives rows (key, season, side,
    game_id, recorded_name) that hold them.
    """
    first = [F.min(F.when(F.col("named") & (F.col("side") == i), F.col("game_id"))).alias(f"_first_{i}") for i in range(SIDES)]
    measured = perspectives.groupBy(key, "season").agg(
        F.count("game_id").alias("matches_played"),
        F.count_if(F.col("result") == "W").alias("wins"),
        F.count_if(F.col("result") == "L").alias("losses"),
        F.count_if(F.col("result") == "D").alias("draws"),
        total("scored").alias("goals_scored"),
        total("conceded").alias("goals_conceded"),
        *first,
    )
    known = names.filter(F.col("name").isNotNull())
    # One row per key and season, written so that the few without a name are known before games are read for them.
    named = stage(lookup(measured, known, {key: key}, {"_name": "name"}), "sides")
    side = F.coalesce(*[F.when(F.col(f"_first_{i}").isNotNull(), i) for i in range(SIDES)])
    winners = named.filter(F.col("_name").isNull() & side.isNotNull()).select(
        key, "season", side.alias("side"), F.coalesce(*[f"_first_{i}" for i in range(SIDES)]).alias("game_id")
    )
    place = [key, "season", "side", "game_id"]
    held = recorded(winners).select(*place, "recorded_name").filter(F.col("recorded_name").isNotNull())
    found = (
        held.join(winners, place, "left_semi")
        .groupBy(F.col(key).alias("_of"), F.col("season").alias("_in"))
        .agg(F.min("recorded_name").alias("_recorded"))
    )
    measures = ("matches_played", "wins", "losses", "draws", "goals_scored", "goals_conceded")
    return named.join(found, (F.col(key) == F.col("_of")) & (F.col("season") == F.col("_in")), "left").select(
        key, "season", F.coalesce("_name", "_recorded").alias(name), *measures
    )


def rolling_mean(value: str):
    """Mean of the rows of a frame, nulls skipped, rounded half-even."""
    return lambda _, frame: {"_rolling": half_even(F.avg(value).over(frame))}


def valuation_trend(dim_player_valuations: DataFrame, rolling_window: int = 3) -> DataFrame:
    """Valuations with a rolling mean per player."""
    value, span = "market_value_in_eur", rolling_window - 1
    rows = dim_player_valuations.withColumn("valuation_date", to_day("valuation_date"))
    rolled = offset_window(rows, ["player_id"], ["valuation_date", "valuation_sk"], rolling_mean(value), preceding=span)
    return rolled.select(
        "player_id",
        "valuation_date",
        F.col(value).alias("market_value"),
        F.col("_rolling").alias("rolling_average_market_value"),
        "current_club_id",
        "current_club_name",
        "is_current",
    )


def build_marts(store: LayerStore, snapshot: str | None, run_id: str, settings: Settings) -> list[TableMetrics]:
    """Rebuild all marts from the silver version of a run. Rows are written in mart order per file."""
    silver = store.read_all(
        "silver",
        ["dim_date", "dim_clubs", "dim_players", "dim_player_valuations", "fact_games", "fact_appearances"],
        run_id,
    )

    def write(name: str, df: DataFrame, *order: str) -> TableMetrics:
        return store.write(df.sortWithinPartitions(*order), "gold", name, run_id)

    performance = player_performance(silver["fact_appearances"], silver["dim_date"], silver["dim_players"])
    clubs = club_performance(silver["fact_games"], silver["dim_clubs"])
    trend = valuation_trend(silver["dim_player_valuations"], settings.rolling_window)
    metrics = run_all(
        [
            lambda: write("gold_player_performance", performance, "player_id", "season"),
            lambda: write("gold_club_performance", clubs, "club_id", "season"),
            lambda: write("gold_player_valuation_trend", trend, "player_id", "valuation_date"),
        ]
    )
    store.record_metrics(run_id, snapshot, "gold", metrics)
    return metrics
