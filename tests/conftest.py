from __future__ import annotations

import csv
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strataline.schemas import SOURCE_TABLES  # noqa: E402
from strataline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=os.environ.get("TEST_CPUS", "4"), shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """make("a int, b string", (1, "x"), ...) -> DataFrame"""
    return lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, so that order does not matter."""
    return lambda df, *cols: sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def write_table(directory: Path, name: str, records: list[dict], drop=(), extra=None) -> None:
    """A raw file with all declared columns; absent values are empty fields."""
    columns = [c for c in SOURCE_TABLES[name].columns if c not in drop] + list(extra or {})
    directory.mkdir(parents=True, exist_ok=True)
    with open(directory / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, columns)
        out.writeheader()
        for record in records:
            out.writerow({**(extra or {}), **{k: v for k, v in record.items() if k in columns}})


def _player(pid, name, club, club_name, value, season, position, sub, country, deleted=0):
    return {
        "player_id": pid, "name": name, "current_club_id": club, "current_club_name": club_name,
        "market_value_in_eur": value, "last_season": season, "position": position, "sub_position": sub,
        "country_of_birth": country, "country_of_citizenship": country, "is_deleted": deleted,
        "date_of_birth": "1999-02-03 00:00:00", "height_in_cm": "181.0",
    }


def _game(gid, day, home, away, hg, ag, season, names):
    return {
        "game_id": gid, "competition_id": "LG", "season": season, "round": "1", "date": f"{day} 15:00:00",
        "home_club_id": home, "away_club_id": away, "home_club_goals": hg, "away_club_goals": ag,
        "home_club_name": names[home], "away_club_name": names[away], "competition_type": "league",
    }


def _appearance(aid, gid, pid, club, day, goals, assists, minutes):
    return {
        "appearance_id": aid, "game_id": gid, "player_id": pid, "player_club_id": club, "date": f"{day} 15:00:00",
        "competition_id": "LG", "goals": goals, "assists": assists, "minutes_played": minutes,
    }


def _value(pid, day, value, club):
    return {"player_id": pid, "date": day, "market_value_in_eur": value, "current_club_id": club}


NAMES = {1: "North", 2: "South", 3: "East", 9: "Guests"}


@pytest.fixture(scope="session")
def feed(tmp_path_factory) -> dict[str, str]:
    """Two snapshots. In the second: 11 moves with a new valuation, 12 changes value without one,
    13 is deleted, 14 is unchanged, 15 is new; two more games, one without a result."""
    root = tmp_path_factory.mktemp("feed")
    one, two = root / "week1", root / "week2"
    clubs = [{"club_id": i, "name": NAMES[i]} for i in (1, 2, 3)]
    competitions = [{"competition_id": "LG", "name": "League"}, {"competition_id": "CP", "name": "Cup"}]
    players1 = [
        _player(11, "Ann", 1, "North", 100, 2023, "Attack", "Left Winger", "England"),
        _player(12, "Bo", 1, "North", 200, 2023, "Midfield", "Sweeper", "Norway"),
        _player(13, "Cy", 2, "South", 300, 2023, "Goalkeeper", "", "NA"),
        _player(14, "Di", 3, "East", 400, 2023, "Wingback", "Wingback", "Korea, South"),
    ]
    games1 = [
        _game(101, "2023-08-20", 1, 2, 2, 1, 2023, NAMES),
        _game(102, "2023-09-10", 3, 1, 0, 0, 2023, NAMES),
        _game(103, "2024-03-02", 2, 9, 1, 3, 2023, NAMES),
    ]
    appearances1 = [
        _appearance(1, 101, 11, 1, "2023-08-20", 1, 0, 90),
        _appearance(2, 101, 12, 1, "2023-08-20", 1, 1, 80),
        _appearance(3, 101, 13, 2, "2023-08-20", 0, 0, 90),
        _appearance(4, 102, 11, 1, "2023-09-10", 0, 0, 45),
        _appearance(5, 102, 14, 3, "2023-09-10", "", 0, 90),
        _appearance(6, 103, 13, 2, "2024-03-02", 1, 0, 90),
    ]
    values1 = [
        _value(11, "2023-08-01", 100, 1),
        _value(12, "2023-08-05", 200, 1),
        _value(13, "2023-08-01", 300, 2),
        _value(14, "2023-12-01", 400, 3),
    ]
    for name, records in {
        "clubs": clubs, "competitions": competitions, "games": games1, "appearances": appearances1,
        "player_valuations": values1,
    }.items():
        write_table(one, name, records)
    write_table(one, "players", players1, drop=("is_deleted",))

    players2 = [
        _player(11, "Ann", 2, "South", 150, 2024, "Attack", "Left Winger", "England"),
        _player(12, "Bo", 1, "North", 250, 2023, "Midfield", "Sweeper", "Norway"),
        _player(13, "Cy", 2, "South", 300, 2023, "Goalkeeper", "", "NA", deleted=1),
        _player(14, "Di", 3, "East", 400, 2023, "Wingback", "Wingback", "Korea, South"),
        _player(15, "Ed", 3, "East", 50, 2024, "Defence", "Left-Back", "Brazil"),
    ]
    games2 = [*games1, _game(104, "2024-08-18", 1, 3, "", "", 2024, NAMES), _game(105, "2024-09-01", 2, 1, 4, 2, 2024, NAMES)]
    appearances2 = [
        *appearances1,
        _appearance(7, 105, 11, 2, "2024-09-01", 3, 0, 90),
        _appearance(8, 105, 12, 1, "2024-09-01", 2, 0, 90),
        _appearance(9, 105, 15, 3, "2024-09-01", 0, 1, 30),
    ]
    values2 = [*values1, _value(11, "2024-07-15", 150, 2), _value(11, "2024-08-30", 151, 2)]
    clubs2 = [{"club_id": 1, "name": "North United"}, *clubs[1:], {"club_id": 4, "name": "West"}]
    for name, records in {
        "clubs": clubs2, "competitions": competitions, "games": games2, "appearances": appearances2,
        "player_valuations": values2, "players": players2,
    }.items():
        write_table(two, name, records)
    return {"week1": str(one), "week2": str(two)}
