from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strataline.functions.casts import NA_TOKENS, has_fraction, lenient_bigint, lenient_timestamp, na_to_null
from strataline.functions.countries import with_country_iso
from strataline.functions.scalars import (
    calendar_columns,
    category_of,
    date_key,
    differs,
    half_even,
    outcome,
    season_of,
    strip,
)
from strataline.settings import POSITION_TAXONOMY


def test_season_starts_in_august(make, rows):
    df = make("d date", (dt.date(2024, 8, 17),), (dt.date(2026, 3, 15),), (dt.date(2025, 7, 31),), (None,))
    assert rows(df.select(season_of("d"))) == [(2024,), (2024,), (2025,), (None,)]
    assert df.select(season_of("d", 1).alias("s")).first().s == 2024


def test_outcome_is_null_without_both_scores(make):
    df = make("i int, a long, b long", (0, 2, 1), (1, 0, 2), (2, 1, 1), (3, None, 1), (4, 1, None))
    got = [tuple(r) for r in df.orderBy("i").select(outcome("a", "b"), outcome("b", "a")).collect()]
    assert got == [("W", "L"), ("L", "W"), ("D", "D"), (None, None), (None, None)]


def test_category_prefers_first_candidate_and_is_case_sensitive(make):
    df = make(
        "i int, sub string, pos string",
        (0, "Right Winger", "Attack"),
        (1, " Centre-Back\t", "Defence"),
        (2, "Unheard", "Midfield"),
        (3, None, "Goalkeeper"),
        (4, "attack", "defence"),
    )
    got = df.orderBy("i").select(category_of(["sub", "pos"], POSITION_TAXONOMY).alias("c")).collect()
    assert [r.c for r in got] == ["Attack", "Defence", "Midfield", "Goalkeeper", None]


def test_category_listed_twice_belongs_to_the_first(make):
    df = make("p string", ("x",))
    assert df.select(category_of(["p"], {"one": ["x"], "two": ["x"]}).alias("c")).first().c == "one"
    assert df.select(category_of(["p"], {}).alias("c")).first().c is None


def test_country_iso_aliases_names_and_codes(make):
    names = ["England", " wales ", "Korea, South", "USA", "Egypt", "NETHERLANDS", "gb", "NOR", "Atlantis", "", None]
    df = make("i int, c string", *enumerate(names))
    got = with_country_iso(df, {"iso": "c"}).orderBy("i").collect()
    assert [r.iso for r in got] == ["GB", "GB", "KR", "US", "EG", "NL", "GB", "NO", None, None, None]


def test_country_register_can_be_replaced(make):
    register = make("country_text string, iso string", ("atlantis", "AX"), ("atlantis", "AY"))
    df = make("c string", ("Atlantis",))
    assert [r.iso for r in with_country_iso(df, {"iso": "c"}, register).collect()] == ["AX"]


def test_official_country_names(make):
    names = {"Russian Federation": "RU", "Korea, Republic of": "KR", "Iran, Islamic Republic of": "IR", "Viet Nam": "VN",
             "Türkiye": "TR", "Cabo Verde": "CV", "Moldova, Republic of": "MD", "Tanzania, United Republic of": "TZ",
             "Bolivia, Plurinational State of": "BO", "Venezuela, Bolivarian Republic of": "VE",
             "Congo, The Democratic Republic of the": "CD", "Cote d'Ivoire": "CI", "Curacao": "CW"}
    df = make("c string", *[(n,) for n in names])
    assert {r.c: r.iso for r in with_country_iso(df, {"iso": "c"}).collect()} == names


def test_na_tokens_become_null(make):
    df = make("t string", *[(t,) for t in NA_TOKENS], ("x",), ("none",))
    assert len(NA_TOKENS) == 19
    assert sorted(r.t for r in df.select(na_to_null("t").alias("t")).collect() if r.t) == ["none", "x"]


def test_lenient_bigint(make):
    texts = ["25", "25.0", " 25\t", "1e3", "x", None, "25.5", "9223372036854775807"]
    df = make("i int, t string", *enumerate(texts)).orderBy("i")
    assert [r.v for r in df.select(lenient_bigint("t").alias("v")).collect()] == [
        25, 25, 25, 1000, None, None, None, 9223372036854775807,
    ]
    assert [r.f for r in df.select(has_fraction("t").alias("f")).collect()] == [False] * 6 + [True, False]


def test_lenient_timestamp_reads_both_formats(make):
    df = make("i int, t string", (0, "2024-08-17"), (1, "2024-08-17 15:30:00"), (2, "soon"), (3, None)).orderBy("i")
    assert [r.v for r in df.select(lenient_timestamp("t").alias("v")).collect()] == [
        dt.datetime(2024, 8, 17), dt.datetime(2024, 8, 17, 15, 30), None, None,
    ]


def test_small_scalars(make):
    df = make("a double, b double, s string", (2.5, None, " \ta b\n"), (3.5, 3.5, "x"))
    got = df.select(half_even("a"), strip("s"), differs("a", "b"), differs("b", F.lit(None))).collect()
    assert [tuple(r) for r in got] == [(2.0, "a b", True, False), (4.0, "x", False, True)]


def test_calendar_columns(make):
    df = make("d date", (dt.date(2026, 3, 22),)).select(*calendar_columns("d"))
    assert tuple(df.first()) == (20260322, dt.date(2026, 3, 22), 2026, 3, 22, 1, "Sunday", 2025)
    assert make("d date", (dt.date(2024, 12, 1),)).select(date_key("d").alias("k")).first().k == 20241201
