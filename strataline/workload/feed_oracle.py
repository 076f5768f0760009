"""DuckDB SQL for the tables that the replayed feed leads to. Columns without a counterpart in the feed are left out."""

from __future__ import annotations

from strataline.workload.oracle_parts import OPEN, asof_sql, cents_sql, season_sql

_CUTS = {"before_1999": "o_orderdate < timestamp '1999-01-01'", "all": "true"}
_POSITIONS = """case c_mktsegment when 'AUTOMOBILE' then 'Left Winger' when 'BUILDING' then 'Centre-Back'
               when 'FURNITURE' then 'Goalkeeper' when 'MACHINERY' then 'Central Midfield' end"""
_CATEGORIES = """case c_mktsegment when 'AUTOMOBILE' then 'Attack' when 'BUILDING' then 'Defence'
               when 'FURNITURE' then 'Goalkeeper' when 'MACHINERY' then 'Midfield' end"""


def _players(cut: str) -> str:
    return f"""
    select c_custkey as player_id, c_name as name, {season_sql("l.o_orderdate")}::bigint as last_season,
           c_nationkey::bigint as current_club_id, n_name as current_club_name, {_POSITIONS} as position,
           {_CATEGORIES} as position_category, {cents_sql("l.o_totalprice")} as market_value_in_eur,
           cast(l.o_orderdate as date) as latest,
           coalesce(l.o_orderstatus = 'F' and l.o_orderpriority = '1-URGENT', false) as gone
    from customer join nation on n_nationkey = c_nationkey left join (
        select * from orders where {cut}
        qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1) l
      on l.o_custkey = c_custkey"""


def _last_game(cut: str) -> str:
    return f"(select max(cast(o_orderdate as date)) from orders join lineitem on l_orderkey = o_orderkey where {cut})"


_DIM_PLAYERS = f"""
    with p1 as ({_players(_CUTS["before_1999"])}), p2 as ({_players("true")}),
    v1 as (select *, row_number() over (order by player_id) as player_sk,
                  coalesce(latest, {_last_game(_CUTS["before_1999"])}) as effective_date from p1),
    m as (select p2.*, case when gone then {_last_game("true")} else coalesce(latest, {_last_game("true")}) end as eff,
                 gone or v1.last_season is distinct from p2.last_season
                     or v1.market_value_in_eur is distinct from p2.market_value_in_eur as changed
          from p2 join (select player_id, last_season, market_value_in_eur from v1) v1 using (player_id)),
    added as (
        select * exclude (latest, gone, eff, changed), eff as effective_date, {OPEN} as end_date, true as is_current,
               (select max(player_sk) from v1) + row_number() over (order by player_id) as player_sk
        from m where changed and not gone),
    kept as (
        select v1.* exclude (latest, gone), case when m.changed then m.eff - 1 else {OPEN} end as end_date,
               not m.changed as is_current
        from v1 join m using (player_id))
    select *, null::varchar as country_of_birth_iso, 0::bigint as is_deleted
    from (select * from kept union all by name select * from added)"""

_VALUATIONS = f"""
    select row_number() over (order by player_id, valuation_date) as valuation_sk, *,
           valuation_date as effective_date, coalesce(lead(valuation_date) over w - 1, {OPEN}) as end_date,
           lead(valuation_date) over w is null as is_current
    from (select o_custkey as player_id, cast(o_orderdate as date) as valuation_date,
                 max({cents_sql("o_totalprice")}) as market_value_in_eur from orders group by all)
    window w as (partition by player_id order by valuation_date)"""

_PER_ORDER = """
    select l_orderkey, count(*) filter (where l_returnflag = 'R') as home_club_goals,
           count(*) filter (where l_returnflag = 'A') as away_club_goals, min(l_suppkey) as first_supplier
    from lineitem group by 1"""


def _day_key(column: str) -> str:
    return f"cast(strftime({column}, '%Y%m%d') as integer)"


# Surrogate keys of clubs and competitions follow their natural keys.
_CLUBS = "(select n_nationkey as club, row_number() over (order by n_nationkey) as club_sk, n_name, n_regionkey from nation)"
_COMPETITIONS = "(select r_regionkey, r_name, row_number() over (order by r_name) as competition_sk from region)"


def _result(own: str, other: str) -> str:
    return f"case when {own} > {other} then 'W' when {own} < {other} then 'L' else 'D' end"


_FACT_GAMES = f"""
    select o_orderkey as game_id, r_name as competition_id, competition_sk, cast(year(o_orderdate) as bigint) as season,
           {season_sql("o_orderdate")} as season_derived, o_orderpriority as round, cast(o_orderdate as date) as date,
           {_day_key("o_orderdate")} as date_sk, home.club::bigint as home_club_id, away.club::bigint as away_club_id,
           home.club_sk as home_club_sk, away.club_sk as away_club_sk, home_club_goals, away_club_goals,
           {_result("home_club_goals", "away_club_goals")} as home_result,
           {_result("away_club_goals", "home_club_goals")} as away_result,
           home.n_name as home_club_name, null::varchar as away_club_name, 'cup' as competition_type
    from orders join customer on c_custkey = o_custkey join {_CLUBS} home on home.club = c_nationkey
    join {_COMPETITIONS} r on r.r_regionkey = home.n_regionkey join ({_PER_ORDER}) on l_orderkey = o_orderkey
    join supplier on s_suppkey = first_supplier join {_CLUBS} away on away.club = s_nationkey"""

_FACT_APPEARANCES = f"""
    select o_orderkey * 10 + l_linenumber as appearance_id, o_orderkey as game_id, o_custkey as player_id,
           club::bigint as player_club_id, club_sk as player_club_sk, cast(o_orderdate as date) as date,
           {_day_key("o_orderdate")} as date_sk, {_day_key("o_orderdate")} as game_date_sk, c_name as player_name,
           r_name as competition_id, competition_sk, goals, assists, minutes_played
    from orders join customer on c_custkey = o_custkey join {_CLUBS} home on club = c_nationkey
    join {_COMPETITIONS} r on r.r_regionkey = home.n_regionkey
    join (select l_orderkey, l_linenumber, cast(sum(cast(l_quantity as bigint)) as bigint) as goals, count(*) as assists,
                 cast(sum({cents_sql("l_discount")}) as bigint) as minutes_played from lineitem group by 1, 2)
      on l_orderkey = o_orderkey"""


def _merged(seq: int, snapshot: str) -> str:
    """Ledger rows of a snapshot by table. The second snapshot repeats all rows of the first."""
    cut, earlier = _CUTS[snapshot], _CUTS["before_1999"] if seq == 2 else "false"
    games = "select o_orderkey, o_orderdate from orders where o_orderkey in (select l_orderkey from lineitem)"
    lines = "select distinct l_orderkey, l_linenumber, o_orderdate from lineitem join orders on o_orderkey = l_orderkey"
    values = "select distinct o_custkey, o_orderdate from orders"
    later = f"o_orderdate::date > {_last_game(earlier)}"

    def of(table: str, rows: str, after: str | None) -> str:
        counted = f"count(*) filter (where {after})" if after else "null::bigint"
        return f"""
        select '{table}' as "table", count(*) as incoming_rows, count(*) filter (where not ({earlier})) as new_keys,
               {counted} as rows_after_watermark, count(*) as cumulative_rows from ({rows}) where {cut}"""

    def whole(table: str, source: str) -> str:
        new = "0" if seq == 2 else "count(*)"
        return f"select '{table}', count(*), {new}, null, count(*) from {source}"

    parts = [
        of("games", games, later if seq == 2 else "true"), of("appearances", lines, later if seq == 2 else None),
        of("player_valuations", values, None),
        whole("players", "customer"), whole("clubs", "nation"), whole("competitions", "region"),
    ]
    day = f"strftime({_last_game(cut)}, '%Y-%m-%d')"
    return f"""select {seq}::bigint as seq, '{snapshot}' as snapshot, {day} as game_date_max, {day} as watermark, *
        from ({" union all ".join(parts)})"""


def _rows_written(seq: int, snapshot: str) -> str:
    """(layer, table, row_count) of a run. Cumulative bronze and facts hold the rows of the snapshot."""
    cut = _CUTS[snapshot]
    merged = f"""(select "table" as name, cumulative_rows as n from ({_merged(seq, snapshot)}))"""
    versions = f"select count(*) from ({_DIM_PLAYERS})" if seq == 2 else "select count(*) from customer"
    days = f"select count(distinct (o_custkey, o_orderdate::date)) from orders where {cut}"
    seasons = f"select count(distinct (o_custkey, {season_sql('o_orderdate')})) from orders join lineitem on l_orderkey = o_orderkey where {cut}"
    clubs = f"""select count(distinct (club, season)) from (
        select season_derived as season, unnest([home_club_id, away_club_id]) as club, date as o_orderdate from ({_FACT_GAMES})) where {cut}"""
    counts = [
        ("silver", "dim_players", versions), ("silver", "dim_player_valuations", days),
        ("silver", "dim_date", f"select count(distinct o_orderdate::date) from orders where {cut}"),
        ("gold", "gold_player_performance", seasons), ("gold", "gold_club_performance", clubs),
        ("gold", "gold_player_valuation_trend", days),
    ]
    single = " union all ".join(f"select '{layer}' as layer, '{name}' as name, ({count}) as n" for layer, name, count in counts)
    return f"""
        select '{snapshot}' as snapshot, layer, name as "table", n as row_count, 0::int as n_extra,
               case when layer = 'bronze' and name = 'players' and {seq} = 1 then 'is_deleted' else '' end as added
        from (
            select 'bronze' as layer, name, n from {merged} union all select 'cumulative', name, n from {merged}
            union all select 'silver', 'dim_' || name, n from {merged} where name in ('clubs', 'competitions')
            union all select 'silver', 'fact_' || name, n from {merged} where name in ('games', 'appearances')
            union all {single})"""


# The feed has no faults, so every check passes without violations.
_CHECKS = """
    select unnest(['null_check', 'referential_integrity', 'valid_range', 'valid_range', 'duplicate_check',
                   'duplicate_check', 'duplicate_check', 'schema_drift']) as check_type,
           unnest(['appearances', 'appearances', 'appearances', 'appearances', 'appearances', 'games', 'players',
                   'bronze']) as "table",
           true as passed,
           (select count(*) from orders where o_custkey not in (select c_custkey from customer)) as violation_count"""

FEED_SQL: dict[str, str] = {
    "medallion_dim_players": _DIM_PLAYERS,
    "medallion_valuations": _VALUATIONS,
    "medallion_fact_games": _FACT_GAMES,
    "medallion_fact_appearances": asof_sql(_FACT_APPEARANCES, "player_id", "date", _DIM_PLAYERS, "player_id", "player_sk"),
    "medallion_club_mart": f"""
        with games as ({_FACT_GAMES}), sides as (
            select home_club_id as club_id, season_derived as season, home_result as result, home_club_goals as own, away_club_goals as opp from games
            union all select away_club_id, season_derived, away_result, away_club_goals, home_club_goals from games)
        select club_id, season, max(n_name) as club_name, count(*) as matches_played, count(*) filter (where result = 'W') as wins,
               count(*) filter (where result = 'L') as losses, count(*) filter (where result = 'D') as draws,
               cast(sum(own) as bigint) as goals_scored, cast(sum(opp) as bigint) as goals_conceded
        from sides join nation on n_nationkey = club_id group by club_id, season""",
    "medallion_trend_mart": f"""
        select player_id, valuation_date, market_value_in_eur as market_value,
               round_even(avg(market_value_in_eur) over (partition by player_id order by valuation_date
                   rows between 2 preceding and current row), 0) as rolling_average_market_value, is_current
        from ({_VALUATIONS})""",
    "medallion_cumulative": f"""
        select 'games' as "table", game_id as id, date as day, home_club_id as club, home_club_goals as goals, season as extra
        from ({_FACT_GAMES}) union all
        select 'appearances', appearance_id, date, player_club_id, goals, minutes_played from ({_FACT_APPEARANCES})""",
    "medallion_ledger": f"{_merged(1, 'before_1999')} union all {_merged(2, 'all')}",
    "medallion_metrics": f"{_rows_written(1, 'before_1999')} union all {_rows_written(2, 'all')}",
    "medallion_quality": f"select s.snapshot, c.* from (values ('before_1999'), ('all')) s(snapshot) cross join ({_CHECKS}) c",
}
