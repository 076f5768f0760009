"""Job parameters with the feed's published defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# Position names and the coarse category each belongs to.
POSITION_TAXONOMY: dict[str, list[str]] = {
    "Attack": ["Attack", "Centre-Forward", "Left Winger", "Right Winger", "Second Striker"],
    "Midfield": ["Midfield", "Defensive Midfield", "Central Midfield", "Attacking Midfield"],
    "Defence": ["Defence", "Centre-Back", "Left-Back", "Right-Back"],
    "Goalkeeper": ["Goalkeeper"],
}


@dataclass(frozen=True)
class NotNull:
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class References:
    child_table: str
    child_column: str
    parent_table: str
    parent_column: str


@dataclass(frozen=True)
class AtLeast:
    table: str
    column: str
    min: float


@dataclass(frozen=True)
class Unique:
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class QualityRules:
    """Checks run on a snapshot before anything derived from it is published."""

    not_null: tuple[NotNull, ...] = ()
    references: tuple[References, ...] = ()
    ranges: tuple[AtLeast, ...] = ()
    unique: tuple[Unique, ...] = ()
    schema_drift: bool = False


DEFAULT_RULES = QualityRules(
    not_null=(NotNull("appearances", ("player_id", "game_id")),),
    references=(References("appearances", "player_id", "players", "player_id"),),
    ranges=(AtLeast("appearances", "minutes_played", 0), AtLeast("appearances", "goals", 0)),
    unique=(
        Unique("appearances", ("appearance_id",)),
        Unique("games", ("game_id",)),
        Unique("players", ("player_id",)),
    ),
    schema_drift=True,
)


@dataclass(frozen=True)
class Settings:
    taxonomy: dict[str, list[str]] = field(default_factory=lambda: dict(POSITION_TAXONOMY))
    season_start_month: int = 8
    rolling_window: int = 3
    game_date_column: str = "date"
    rules: QualityRules = DEFAULT_RULES
    fail_on_error: bool = True
