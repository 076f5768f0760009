"""DuckDB SQL for the queries, over views of the same tables. Integer and text results are exact."""

from __future__ import annotations

from strataline.workload.feed_oracle import FEED_SQL
from strataline.workload.oracle_parts import OPEN, asof_sql, cents_sql, season_sql

_POINTS = f"""
    select l_partkey as part, cast(l_shipdate as date) as day, {cents_sql("l_extendedprice")} as price,
           l_suppkey as supplier, max(l_returnflag) as flag
    from lineitem group by all"""


def _history(points: str) -> str:
    return f"""
    select row_number() over (order by part, day, price, supplier) as price_sk, part, day, price, supplier, flag,
           day as effective_date,
           coalesce(lead(day) over w - 1, {OPEN}) as end_date,
           lead(day) over w is null as is_current
    from ({points}) p
    window w as (partition by part order by day, price, supplier)"""


# The customer's latest order as of a cut, with the deletion flag and effective date of the merge.
def _state(cut: str) -> str:
    return f"""
    select o_custkey, o_orderpriority, o_orderstatus, {cents_sql("o_totalprice")} as total,
           cast(o_orderstatus = 'F' and o_orderpriority = '1-URGENT' as integer) as is_deleted,
           case when o_orderstatus = 'F' and o_orderpriority = '1-URGENT'
                then (select max(cast(o_orderdate as date)) from orders where {cut})
                else cast(o_orderdate as date) end as eff
    from orders where {cut}
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"""


_SCD2 = f"""
    with s1 as ({_state("o_orderdate < timestamp '1998-01-01'")}), s2 as ({_state("true")}),
    v1 as (select *, row_number() over (order by o_custkey) as customer_sk from s1 where is_deleted = 0),
    m as (
        select s2.*, v1.customer_sk as old_sk,
               s2.is_deleted = 1 or v1.o_orderpriority is distinct from s2.o_orderpriority
                   or v1.o_orderstatus is distinct from s2.o_orderstatus as changed
        from s2 left join v1 using (o_custkey)),
    kept as (
        select v1.o_custkey, v1.o_orderpriority, v1.o_orderstatus, v1.total, v1.is_deleted, v1.customer_sk,
               v1.eff as effective_date,
               case when m.changed then m.eff - 1 else {OPEN} end as end_date,
               not coalesce(m.changed, false) as is_current
        from v1 left join m using (o_custkey)),
    added as (
        select o_custkey, o_orderpriority, o_orderstatus, total, is_deleted,
               (select max(customer_sk) from v1) + row_number() over (order by o_custkey) as customer_sk,
               eff as effective_date, {OPEN} as end_date, true as is_current
        from m where is_deleted = 0 and (old_sk is null or changed))
    select * from kept union all select * from added"""


def _totals(cut: str) -> str:
    return f"""
    select o_custkey, count(*) as n_orders, cast(sum({cents_sql("o_totalprice")}) as bigint) as total,
           max(cast(o_orderdate as date)) as last_day
    from orders where {cut} group by 1"""


_LINE = f"""
    select l_orderkey, l_linenumber, cast(l_shipdate as date) as ship_day, l_partkey, l_suppkey,
           {cents_sql("l_extendedprice")} as price, l_returnflag from lineitem"""

_LAST = """qualify row_number() over (partition by l_orderkey, l_linenumber
            order by ship_day desc, l_partkey desc, l_suppkey desc, price desc, l_returnflag desc) = 1"""

_FAULTY = """
    select l_orderkey, l_linenumber, l_quantity, l_extendedprice,
           case when l_returnflag = 'R' and year(l_shipdate) = 1995 then null else l_partkey end as l_partkey,
           case when l_tax < 0.075 then l_suppkey end as l_suppkey
    from lineitem"""

_ORPHANS = """
    select distinct l_partkey as key from lineitem
    where l_partkey is not null and l_partkey not in (select p_partkey from part where p_size > 25)"""

_DUPLICATES = "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1"


def _sample(rows: str, order: str, limit: int, text: str) -> str:
    """JSON array of the first rows' texts."""
    return f"""(select '[' || coalesce(string_agg(txt, ',' order by {order}), '') || ']'
        from (select *, {text} as txt from ({rows}) order by {order} limit {limit}))"""


_KEY_TEXT = """'"{\\"l_orderkey\\":' || l_orderkey || ',\\"l_linenumber\\":' || l_linenumber || '}"'"""


def _range(column: str, minimum: str, violating: str) -> str:
    return f"""
    select 'valid_range' as check_type, 'lineitem' as "table", count(*) = 0 as passed, count(*) as violation_count,
           '{{"column":"{column}","min":{minimum},"sample_of":"l_orderkey,l_linenumber","sample":'
           || {_sample(violating, "l_orderkey, l_linenumber", 5, _KEY_TEXT)} || '}}' as details
    from ({violating})"""


_NULL_COUNTS = """
    select count(*) filter (where l_orderkey is null) as a, count(*) filter (where l_partkey is null) as b,
           count(*) filter (where l_suppkey is null) as c"""

_MONTHS = f"""
    select strftime(o_orderdate, '%Y-%m') as snapshot,
           md5(count(*) || '|' || cast(sum({cents_sql("o_totalprice")}) as bigint) || '|' || max(o_orderkey)) as content_hash
    from orders"""


def _fingerprint(name: str, line: str) -> str:
    """Count and digest of a table's lines: sums of MD5 prefixes, plain and by position."""
    return f"""
    select '{name}' as table_name, count(*) as lines,
           md5('line|line|' || count(*) || '|' || sum(h) || '|' || sum(h * (n - 1))) as digest
    from (select cast(('0x' || md5(line)[:10]) as bigint)::hugeint as h, row_number() over (order by line) as n
          from (select {line} as line from {name}))"""


# ISO codes by nation key as the country query writes the names; key 22 has no country.
_NATION_ISO = ["DZ", "AR", "BR", "CA", "EG", "ET", "FR", "DE", "IN", "ID", "IR", "IQ", "JP", "JO", "KE", "MA", "MZ",
               "PE", "CN", "RO", "SA", "KR", None, "GB", "US"]
_ISO_CASE = "case c_nationkey " + " ".join(f"when {i} then '{c}'" for i, c in enumerate(_NATION_ISO) if c) + " end"

ORACLE_SQL: dict[str, str] = {
    "season_performance": f"""
        select m.*, c_name as name, c_mktsegment as segment, c_nationkey as nation from (
            select o_custkey as c_custkey, {season_sql("o_orderdate")} as season,
                   count(distinct o_orderkey) as matches_played,
                   cast(sum(cast(l_quantity as bigint)) as bigint) as total_quantity,
                   cast(sum({cents_sql("l_extendedprice")}) as bigint) as total_cents
            from orders join lineitem on l_orderkey = o_orderkey group by all) m
        left join customer using (c_custkey)""",
    "performance_gaps": f"""
        with r as (
            select o_orderkey, case when o_orderpriority <> '1-URGENT' then o_custkey end as c_custkey,
                   case when o_orderpriority <> '5-LOW' then {season_sql("o_orderdate")} end as season,
                   case when o_orderstatus <> 'P' then quantity end as quantity
            from orders left join (select l_orderkey, sum(cast(l_quantity as bigint)) as quantity from lineitem group by 1)
              on l_orderkey = o_orderkey)
        select r.c_custkey, season, count(distinct o_orderkey) as matches_played, cast(coalesce(sum(quantity), 0) as bigint) as total_quantity,
               'again ' || any_value(c_name) as name, any_value(c_nationkey) - 1 as nation
        from r join customer c on c.c_custkey = r.c_custkey where season is not null group by 1, 2""",
    "two_sided_results": f"""
        with g as (
            select l_orderkey as game_id, {season_sql("l_shipdate")} as season, c_nationkey as nb,
                   case when l_linenumber = 7 then s_nationkey + 100 else s_nationkey end as na,
                   s_name, c_name, cast(l_quantity as bigint) as a, cast(round(l_discount * 500) as bigint) as b
            from lineitem left join orders on o_orderkey = l_orderkey left join customer on c_custkey = o_custkey
            left join supplier on s_suppkey = l_suppkey),
        p as (
            select 0 as side, game_id, season, na as nation, s_name as rec, a as own, b as opp from g
            union all select 1, game_id, season, nb, c_name, b, a from g)
        select p.nation, season,
               coalesce(max(n_name), arg_min(rec, (side, game_id, rec))) as nation_name,
               count(game_id) as matches_played, count(*) filter (where own > opp) as wins,
               count(*) filter (where own < opp) as losses, count(*) filter (where own = opp) as draws,
               cast(sum(own) as bigint) as goals_scored, cast(sum(opp) as bigint) as goals_conceded
        from p left join nation on n_nationkey = p.nation
        where p.nation is not null and season is not null group by p.nation, season""",
    "rolling_trend": f"""
        with p as (select l_partkey, cast(l_shipdate as date) as ship_day, l_orderkey, l_linenumber, l_suppkey,
                          {cents_sql("l_extendedprice")} as price from lineitem)
        select *, round_even(avg(price) over (partition by l_partkey
            order by ship_day, l_orderkey, l_linenumber, l_suppkey, price rows between 2 preceding and current row), 0)
            as rolling_price from p""",
    "price_history_scd2": _history(_POINTS),
    "history_gaps": f"""
        select * from ({_history(_POINTS.replace("select l_partkey as part", "select case when l_returnflag <> 'R' then l_partkey end as part")
            .replace("group by all", "group by all having part is not null"))})""",
    "history_union_rebuild": _history(f"""
        with known as ({_POINTS.replace("group by all", "where year(l_shipdate) <= 1998 group by all")}),
        arriving as ({_POINTS.replace("group by all", "where year(l_shipdate) >= 1997 group by all")})
        select * from arriving union all
        select * from known where (part, day, price, supplier) not in (select (part, day, price, supplier) from arriving)
        """),
    "scd2_merge": _SCD2,
    "scd2_inverted": f"select count(*) as inverted from ({_history(_POINTS)}) where end_date < effective_date",
    "asof_lookup": asof_sql(
        "select l_orderkey, l_linenumber, l_partkey, cast(l_shipdate as date) as ship_day from lineitem",
        "l_partkey", "ship_day",
        _history(_POINTS.replace("group by all", "where year(l_shipdate) >= 1998 group by all")), "part", "price_sk",
    ),
    "asof_customer": asof_sql(
        "select o_orderkey, o_custkey, cast(o_orderdate as date) as order_day from orders",
        "o_custkey",
        "order_day",
        f"""select o_custkey, customer_sk, effective_date, end_date, is_current from ({_SCD2})
            union all
            select o_custkey, o_orderkey + 1000000000, cast(o_orderdate as date) - 30, cast(o_orderdate as date) + 90, false
            from orders where o_orderpriority = '5-LOW'""",
        "o_custkey",
        "customer_sk",
    ),
    "scd1_merge": f"""
        with old as (select row_number() over (order by o_custkey) as customer_sk, *
                     from ({_totals("o_orderdate < timestamp '1995-07-01'")})),
        inc as ({_totals("o_orderdate >= timestamp '1995-07-01'")})
        select customer_sk, old.o_custkey, coalesce(inc.n_orders, old.n_orders) as n_orders,
               coalesce(inc.total, old.total) as total, coalesce(inc.last_day, old.last_day) as last_day
        from old left join inc on inc.o_custkey = old.o_custkey
        union all
        select (select max(customer_sk) from old) + row_number() over (order by o_custkey), *
        from inc where o_custkey not in (select o_custkey from old)""",
    "fact_lookup": f"""
        with n as (select n_nationkey, n_regionkey, row_number() over (order by n_nationkey) as nation_sk from nation),
        r as (select r_regionkey, row_number() over (order by r_regionkey) as region_sk from region)
        select o_orderkey, cast(o_orderdate as date) as order_day, {season_sql("o_orderdate")} as season,
               cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_sk, nation_sk, region_sk
        from orders left join customer on c_custkey = o_custkey left join n on n_nationkey = c_nationkey and o_orderpriority <> '5-LOW'
        left join r on r_regionkey = n_regionkey""",
    "lookup_last": """
        select c_custkey, o_orderkey as last_order, o_orderpriority as last_priority
        from customer left join (
            select * from orders where o_orderstatus <> 'P'
            qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
          on o_custkey = c_custkey""",
    "dim_date": f"""
        select cast(strftime(d, '%Y%m%d') as integer) as date_sk, d as full_date, cast(year(d) as integer) as year,
               cast(month(d) as integer) as month, cast(day(d) as integer) as day,
               cast(quarter(d) as integer) as quarter, dayname(d) as day_of_week, {season_sql("d")} as season
        from (select cast(o_orderdate as date) as d from orders union select cast(l_shipdate as date) from lineitem
              union select cast(ts as date) from events) where d is not null""",
    "upsert_last": f"""
        with l as ({_LINE}), inc as (select * from l where year(ship_day) >= 1998 {_LAST}),
        old as (select * from l where year(ship_day) < 1999 {_LAST})
        select * from inc union all
        select * from old where (l_orderkey, l_linenumber) not in (select (l_orderkey, l_linenumber) from inc)""",
    "merge_stats": """
        with old as (select distinct l_orderkey, l_linenumber from lineitem where l_shipdate < timestamp '1999-01-01'),
        inc as (select * from lineitem where l_shipdate >= timestamp '1998-01-01')
        select count(*) as incoming_rows,
               count(*) filter (where (l_orderkey, l_linenumber) not in (select (l_orderkey, l_linenumber) from old))
                   as new_keys,
               count(*) filter (where cast(l_shipdate as date) > date '2000-06-30') as rows_after_watermark,
               strftime(max(l_shipdate), '%Y-%m-%d') as day
        from inc""",
    "new_natural_keys": f"""
        with l as ({_LINE})
        select * from l where year(ship_day) >= 1998 and (l_orderkey, l_linenumber) not in
            (select (l_orderkey, l_linenumber) from l where year(ship_day) < 1999)""",
    "dq_nulls": f"""
        select 'null_check' as check_type, 'lineitem' as "table", a + b + c = 0 as passed, a + b + c as violation_count,
               '{{"columns":{{' || concat_ws(',', case when a > 0 then '"l_orderkey":' || a end,
                   case when b > 0 then '"l_partkey":' || b end, case when c > 0 then '"l_suppkey":' || c end)
               || '}}}}' as details
        from ({_NULL_COUNTS} from ({_FAULTY}))""",
    "dq_orphans": f"""
        select 'referential_integrity' as check_type, 'lineitem' as "table", count(*) = 0 as passed,
               count(*) as violation_count,
               '{{"child_column":"l_partkey","parent_table":"part","parent_column":"p_partkey","orphan_keys_sample":'
               || {_sample(_ORPHANS, "key", 10, "'\"' || key || '\"'")} || '}}' as details
        from ({_ORPHANS})""",
    "dq_ranges": f"""
        {_range("quantity_text", "5.0", f"select * from ({_FAULTY}) where l_quantity < 5 and l_quantity <> 3")}
        union all
        {_range("l_extendedprice", "0.0", f"select * from ({_FAULTY}) where l_extendedprice < 0")}""",
    "dq_duplicates": f"""
        select 'duplicate_check' as check_type, 'lineitem' as "table", count(*) = 0 as passed,
               cast(coalesce(sum(n), 0) as bigint) as violation_count,
               '{{"columns":"l_orderkey,l_linenumber","duplicate_keys_sample":'
               || {_sample(_DUPLICATES, "l_orderkey, l_linenumber", 5, _KEY_TEXT)} || '}}' as details
        from ({_DUPLICATES})""",
    "dq_duplicate_rows": f"""
        {_LINE} qualify count(*) over (partition by l_orderkey, l_linenumber) > 1""",
    "dq_report": f"""
        with v(n, ok) as (
            select a + b + c, a + b + c = 0 from ({_NULL_COUNTS} from ({_FAULTY}))
            union all select count(*), count(*) = 0 from (
                select distinct l_partkey from ({_FAULTY}) where l_partkey is not null
                    and l_partkey not in (select p_partkey from part where p_size > 25))
            union all select count(*), count(*) = 0 from ({_FAULTY}) where l_quantity < 5 and l_quantity <> 3
            union all select count(*), count(*) = 0 from ({_FAULTY}) where l_extendedprice < 0
            union all select coalesce(sum(n), 0), count(*) = 0 from ({_DUPLICATES})
            union all select coalesce(sum(n), 0), count(*) = 0
                from (select o_orderkey, count(*) as n from orders group by 1 having count(*) > 1))
        select count(*) as total_checks, count(*) filter (where ok) as passed_checks,
               count(*) filter (where not ok) as failed_checks, cast(sum(n) as bigint) as total_violations,
               bool_and(ok) as passed
        from v""",
    "schema_prepare": """
        select o_orderkey, o_custkey, cast(null as varchar) as o_clerk, o_orderstatus, 0 as is_deleted from orders""",
    "schema_drift": """
        select 'schema_drift' as check_type, 'bronze' as "table", false as passed, count(distinct t) as violation_count,
               '{"tables_with_extra_columns":{"orders":["o_orderpriority"]}}' as details
        from (select 'orders' as t from orders)""",
    "lenient_casts": """
        select o_orderkey,
               case o_orderpriority when '1-URGENT' then o_custkey when '2-HIGH' then o_custkey
                   when '3-MEDIUM' then o_custkey * 100 end as whole,
               o_orderpriority = '4-NOT SPECIFIED' as fractional,
               cast(case o_orderpriority when '1-URGENT' then o_custkey when '2-HIGH' then o_custkey
                   when '3-MEDIUM' then o_custkey * 100 when '4-NOT SPECIFIED' then o_custkey + 0.5 end as double)
                   as number,
               case when o_orderstatus in ('O', 'F') then cast(o_orderdate as date) end as day,
               case o_orderstatus when 'O' then 0 when 'F' then 17 end as hour
        from orders""",
    "taxonomy_map": """
        select p_partkey, case string_split(p_name, ' ')[-1] when 'bolt' then 'fastener' when 'rod' then 'fastener'
            when 'gear' then 'machine' when 'gizmo' then 'machine' when 'plate' then 'bulk'
            else case p_type when 'LARGE' then 'bulk' when 'PROMO' then 'bulk' when 'SMALL' then 'retail'
                when 'ECONOMY' then 'retail' end end as category
        from part""",
    "country_iso": f"""
        select case when c_mktsegment <> 'HOUSEHOLD' then {_ISO_CASE} end as iso, count(*) as n_customers,
               cast(sum({cents_sql("c_acctbal")}) as bigint) as balance
        from customer group by 1""",
    "pending_snapshots": f"""
        with src as ({_MONTHS} group by 1), settled as ({_MONTHS} where o_orderstatus <> 'P' group by 1),
        ledger as (
            select snapshot, content_hash, 1 as seq from src where snapshot < '2000-01' union all
            select snapshot, content_hash, 2 from settled where snapshot >= '1998-01' and snapshot < '2001-01'),
        latest as (select snapshot, arg_max(content_hash, seq) as seen from ledger group by 1)
        select src.* from src left join latest using (snapshot)
        where seen is distinct from content_hash""",
    "source_fingerprint": _fingerprint(
        "orders",
        f"""concat_ws('|', o_orderkey, o_custkey, o_orderstatus, {cents_sql("o_totalprice")},
                      strftime(o_orderdate, '%Y-%m-%d'))""",
    )
    + " union all "
    + _fingerprint("documents", "concat_ws('|', doc_id, translate(coalesce(text, ''), chr(13) || chr(10), '  '))"),
    "ingest_csv": f"""
        select o_custkey as player_id, cast(o_orderdate as date) as date,
               case when o_orderstatus <> 'P' then {cents_sql("o_totalprice")} end as market_value_in_eur,
               case o_orderpriority when '4-NOT SPECIFIED' then null
                   when '5-LOW' then 'two' || chr(10) || '"lines",' || chr(10) || chr(10) || o_orderpriority
                   else '"' || o_orderpriority || '", say' end as current_club_name,
               o_orderkey as current_club_id, o_orderstatus as player_club_domestic_competition_id
        from orders""",
    "medallion_run": f"""
        with latest as (
            select * from orders
            qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1),
        current as (
            select c_custkey as player_id, c_name as name,
                   case c_mktsegment when 'AUTOMOBILE' then 'Attack' when 'BUILDING' then 'Defence'
                       when 'FURNITURE' then 'Goalkeeper' when 'MACHINERY' then 'Midfield' end as position_category,
                   cast(c_nationkey as bigint) as current_club_id, n_name as current_club_name
            from customer join nation on n_nationkey = c_nationkey left join latest on o_custkey = c_custkey
            where not coalesce(o_orderstatus = 'F' and o_orderpriority = '1-URGENT', false))
        select m.*, name, position_category, current_club_id, current_club_name from (
            select o_custkey as player_id, {season_sql("o_orderdate")} as season,
                   count(distinct o_orderkey) as matches_played,
                   cast(sum(cast(l_quantity as bigint)) as bigint) as total_goals, count(*) as total_assists,
                   cast(sum({cents_sql("l_discount")}) as bigint) as total_minutes
            from orders join lineitem on l_orderkey = o_orderkey group by all) m
        left join current using (player_id)""",
} | FEED_SQL
