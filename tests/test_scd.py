from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strataline.operators.scd import inverted_versions, merge_type2

D = dt.date
OPEN = D(9999, 12, 31)
DDL = "player_id int, club int, value long, height int, eff date, is_deleted int, o int"


def merge(existing, incoming):
    return merge_type2(
        existing, incoming, key="player_id", compare=["club", "value"], sk="sk", effective="eff",
        deleted="is_deleted", order=["o"],
    )


def test_change_closes_and_opens(make, rows):
    first = merge(None, make(DDL, (1, 102, 5, 180, D(2024, 8, 1), 0, 0)))
    assert first.columns == ["player_id", "club", "value", "height", "is_deleted", "o", "sk", "effective_date", "end_date", "is_current"]
    second = merge(first, make(DDL, (1, 103, 5, 180, D(2026, 3, 1), 0, 0)))
    assert rows(second, "sk", "club", "effective_date", "end_date", "is_current") == [
        (1, 102, D(2024, 8, 1), D(2026, 2, 28), False),
        (2, 103, D(2026, 3, 1), OPEN, True),
    ]


def test_unchanged_rows_keep_their_untracked_columns(make, rows):
    first = merge(None, make(DDL, (1, 102, None, 180, D(2024, 8, 1), 0, 0)))
    second = merge(first, make(DDL, (1, 102, None, 199, D(2026, 3, 1), 0, 0)))
    assert rows(second, "sk", "height", "end_date") == [(1, 180, OPEN)]


def test_null_and_value_differ(make):
    first = merge(None, make(DDL, (1, 102, None, 180, D(2024, 8, 1), 0, 0)))
    assert merge(first, make(DDL, (1, 102, 7, 180, D(2026, 3, 1), 0, 0))).count() == 2


def test_deleted_keys_close_and_never_open(make, rows):
    assert merge(None, make(DDL, (1, 1, 1, 1, D(2024, 8, 1), 1, 0), (2, 1, 1, 1, D(2024, 8, 1), None, 1))).count() == 1
    first = merge(None, make(DDL, (1, 1, 1, 1, D(2024, 8, 1), 0, 0)))
    gone = merge(first, make(DDL, (1, 1, 1, 1, D(2026, 3, 22), 1, 0)))
    assert rows(gone, "sk", "end_date", "is_current", "is_deleted") == [(1, D(2026, 3, 21), False, 0)]
    assert rows(merge(gone, make(DDL, (1, 1, 1, 1, D(2026, 4, 1), 1, 0)))) == rows(gone)
    back = merge(gone, make(DDL, (1, 1, 1, 1, D(2026, 5, 1), 0, 0)))
    assert rows(back, "sk", "effective_date", "is_current") == [(1, D(2024, 8, 1), False), (2, D(2026, 5, 1), True)]


def test_same_effective_date_inverts_the_old_version(make):
    first = merge(None, make(DDL, (1, 1, 1, 1, D(2024, 8, 1), 0, 0)))
    second = merge(first, make(DDL, (1, 1, 2, 1, D(2024, 8, 1), 0, 0)))
    assert inverted_versions(second).first().inverted == 1


def test_last_incoming_row_counts_and_deletion_beats_order(make, rows):
    incoming = make(DDL, (1, 1, 1, 1, D(2024, 8, 1), 0, 0), (1, 2, 1, 1, D(2024, 8, 1), 0, 1), (2, 5, 1, 1, D(2024, 8, 1), 0, 2))
    first = merge(None, incoming)
    assert rows(first, "sk", "player_id", "club") == [(1, 1, 2), (2, 2, 5)]
    again = make(DDL, (2, 5, 1, 1, D(2024, 9, 1), 1, 0), (2, 6, 1, 1, D(2024, 9, 1), 0, 1))
    assert rows(merge(first, again).filter("is_current"), "player_id") == [(1,)]


record = st.tuples(st.integers(1, 4), st.sampled_from([1, 2, None]), st.sampled_from([10, 20]), st.sampled_from([0, 0, 0, 1]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(record, max_size=5), min_size=1, max_size=3))
def test_versions_are_consistent(make, rows, snapshots):
    dim = None
    for n, records in enumerate(snapshots):
        eff = D(2024, 1, 1) + dt.timedelta(days=30 * n)
        incoming = make(DDL, *[(k, c, v, 0, eff, d, i) for i, (k, c, v, d) in enumerate(records)])
        dim = merge(dim, incoming)
        # Reprocessing the same snapshot changes nothing.
        assert rows(merge(dim, incoming)) == rows(dim)
    versions = [r.asDict() for r in dim.collect()]
    assert sorted(v["sk"] for v in versions) == list(range(1, len(versions) + 1))
    for key in {v["player_id"] for v in versions}:
        mine = sorted((v for v in versions if v["player_id"] == key), key=lambda v: v["sk"])
        assert sum(v["is_current"] for v in mine) <= 1
        assert all(a["end_date"] < b["effective_date"] for a, b in zip(mine, mine[1:], strict=False))
    seen: dict[int, tuple] = {}
    for records in snapshots:
        last = {}
        for k, c, v, d in sorted(records, key=lambda r: r[3]):
            last[k] = (c, v, d)
        for k, (c, v, d) in last.items():
            if d:
                seen.pop(k, None)
            else:
                seen[k] = (c, v)
    assert {v["player_id"]: (v["club"], v["value"]) for v in versions if v["is_current"]} == seen
