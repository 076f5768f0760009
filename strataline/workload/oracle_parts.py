"""SQL that the queries' DuckDB counterparts share."""

from __future__ import annotations

OPEN = "date '9999-12-31'"


def season_sql(day: str) -> str:
    return f"cast(year({day}) - case when month({day}) >= 8 then 0 else 1 end as integer)"


def cents_sql(column: str) -> str:
    return f"cast(round({column} * 100) as bigint)"


def asof_sql(facts: str, key: str, day: str, dim: str, dim_key: str, sk: str) -> str:
    """Facts left-joined with the winning version of each distinct (key, day)."""
    return f"""
    with f as ({facts}), d as ({dim}),
    probes as (select distinct {key} as k, {day} as probe_day from f),
    valid as (
        select k, probe_day, arg_max(d.{sk}, (d.effective_date, d.{sk})) as sk
        from probes join d on d.{dim_key} = k and probe_day between d.effective_date and d.end_date
        group by k, probe_day),
    cur as (select {dim_key} as k, max({sk}) as sk from d where is_current group by 1)
    select f.*, coalesce(valid.sk, cur.sk) as {sk}
    from f left join valid on valid.k = f.{key} and valid.probe_day = f.{day} left join cur on cur.k = f.{key}"""
