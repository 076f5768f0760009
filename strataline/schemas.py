"""Declared tables of the snapshot feed: columns, types, natural keys, optional columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """What a raw table must contain and what it becomes.

    ``fields`` are the declared columns in order. ``optional`` maps a column that a feed may omit to
    the value it then takes; every other declared column is required.
    """

    name: str
    fields: T.StructType
    key: tuple[str, ...]
    optional: dict[str, object] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.fields.fieldNames()


_TYPES = {"bigint": T.LongType(), "string": T.StringType(), "timestamp_ntz": T.TimestampNTZType()}


def table(name: str, columns: str, key: tuple[str, ...], optional: dict[str, object] | None = None) -> TableSpec:
    """Declare a table from "column type, ..." text (readable without a running session)."""
    pairs = [c.split() for c in columns.split(", ")]
    fields = T.StructType([T.StructField(column, _TYPES[kind]) for column, kind in pairs])
    return TableSpec(name, fields, key, optional or {})


# The feed's published columns and types, in file order.
PLAYERS = table(
    "players",
    "player_id bigint, first_name string, last_name string, name string, last_season bigint, "
    "current_club_id bigint, player_code string, country_of_birth string, city_of_birth string, "
    "country_of_citizenship string, date_of_birth timestamp_ntz, sub_position string, position string, "
    "foot string, height_in_cm bigint, contract_expiration_date timestamp_ntz, agent_name string, "
    "image_url string, international_caps bigint, international_goals bigint, "
    "current_national_team_id bigint, url string, current_club_domestic_competition_id string, "
    "current_club_name string, market_value_in_eur bigint, highest_market_value_in_eur bigint, "
    "is_deleted bigint",
    ("player_id",),
    {"is_deleted": 0},
)
GAMES = table(
    "games",
    "game_id bigint, competition_id string, season bigint, round string, date timestamp_ntz, "
    "home_club_id bigint, away_club_id bigint, home_club_goals bigint, away_club_goals bigint, "
    "home_club_position bigint, away_club_position bigint, home_club_manager_name string, "
    "away_club_manager_name string, stadium string, attendance bigint, referee string, url string, "
    "home_club_formation string, away_club_formation string, home_club_name string, "
    "away_club_name string, aggregate string, competition_type string",
    ("game_id",),
)
APPEARANCES = table(
    "appearances",
    "appearance_id bigint, game_id bigint, player_id bigint, player_club_id bigint, "
    "player_current_club_id bigint, date timestamp_ntz, player_name string, competition_id string, "
    "yellow_cards bigint, red_cards bigint, goals bigint, assists bigint, minutes_played bigint",
    ("appearance_id",),
)
CLUBS = table(
    "clubs",
    "club_id bigint, club_code string, name string, domestic_competition_id string, "
    "total_market_value bigint, squad_size bigint, average_age string, foreigners_number bigint, "
    "foreigners_percentage string, national_team_players bigint, stadium_name string, "
    "stadium_seats bigint, net_transfer_record string, coach_name string, last_season bigint, "
    "filename string, url string",
    ("club_id",),
)
COMPETITIONS = table(
    "competitions",
    "competition_id string, competition_code string, name string, sub_type string, type string, "
    "country_id bigint, country_name string, domestic_league_code string, confederation string, "
    "total_clubs bigint, url string",
    ("competition_id",),
)
PLAYER_VALUATIONS = table(
    "player_valuations",
    "player_id bigint, date timestamp_ntz, market_value_in_eur bigint, current_club_name string, "
    "current_club_id bigint, player_club_domestic_competition_id string",
    ("player_id", "date"),
)

SOURCE_TABLES: dict[str, TableSpec] = {
    spec.name: spec for spec in (PLAYERS, GAMES, APPEARANCES, CLUBS, COMPETITIONS, PLAYER_VALUATIONS)
}

# Position of a row in its source, kept beside the declared columns so that "last row wins" is exact
# however the file was split.
SOURCE_ORDER = ("_src_file", "_src_block", "_src_row")

# The raw text of a row whose number of fields differs from the header's.
MALFORMED = "_src_malformed"
