"""DuckDB SQL with the rows of those corpus queries that SQL can express."""

from __future__ import annotations

from strataline.llm.mixing import OTHER, Mix


def _weight(level: str, mix: Mix) -> str:
    cases = " ".join(f"when '{name}' then {w}" for name, w in sorted(mix.weights.get(level, {}).items()))
    return f"case {level} {cases} else {OTHER} end" if cases else str(OTHER)


def _level(name: str, keys: list[str], above: str, mix: Mix) -> str:
    """Budget of the parent shared among its children; see ``mixing._shared``."""
    parent = ", ".join(keys[:-1]) or "1"
    join = f"join {above} using ({', '.join(keys[:-1])})" if keys[:-1] else f"cross join {above}"
    return f"""
{name}_0 as (select {', '.join(keys)}, sum(capacity) as capacity, any_value({_weight(keys[-1], mix)}) as weight
  from leaves group by {', '.join(keys)}),
{name}_1 as (select *, coalesce(sum(capacity) over (o rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (o rows between current row and unbounded following) as heavier
  from {name}_0 {join} window o as (partition by {parent} order by capacity / weight, {keys[-1]})),
{name}_2 as (select *, capacity::hugeint * heavier <= weight * (budget - before)::hugeint as is_full from {name}_1),
{name}_3 as (select *, sum(case when not is_full then weight end) over f as open_weight,
    sum(case when is_full then capacity else 0 end) over f as filled
  from {name}_2 window f as (partition by {parent})),
{name}_4 as (select *, case when not is_full then weight * (budget - filled)::hugeint // open_weight end as share
  from {name}_3),
{name}_5 as (select *, budget - filled - sum(case when not is_full then share else 0 end) over (partition by {parent}) as odd,
    row_number() over (partition by {parent} order by is_full, capacity / weight, {keys[-1]}) as turn from {name}_4),
{name} as (select {', '.join(keys)}, case when is_full then capacity
    else share + case when turn <= odd then 1 else 0 end end as budget from {name}_5)"""


def mixing_sql(domain: str, mix: Mix) -> str:
    return f"""
with sizes as (select doc_id, {domain} as domain, coalesce(lang, '') as lang, coalesce(source, '') as source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n_tokens from documents),
leaves as (select domain, lang, source, sum(n_tokens) as tokens, sum(n_tokens) * {mix.max_epochs} as capacity
  from sizes group by all),
root as (select least(sum(tokens) * {mix.budget_permille} // 1000, sum(capacity)) as budget from leaves),
{_level('d', ['domain'], 'root', mix)},
{_level('l', ['domain', 'lang'], 'd', mix)},
{_level('s', ['domain', 'lang', 'source'], 'l', mix)},
keyed as (select *, case when tokens > 0 then budget // tokens else 0 end as epochs,
    case when tokens > 0 then budget % tokens else 0 end as rest
  from sizes join leaves using (domain, lang, source) join s using (domain, lang, source)),
ranked as (select *, md5('{mix.seed}:' || epochs || ':' || doc_id || ':' || n_tokens) as key from keyed),
placed as (select *, coalesce(sum(n_tokens) over (partition by domain, lang, source order by key
    rows between unbounded preceding and 1 preceding), 0) as before from ranked)
select domain, lang, source, doc_id, n_tokens::bigint as n_tokens, epochs::bigint as epochs,
  greatest(0, least(n_tokens, rest - before))::bigint as prefix_tokens from placed"""


def contamination_sql(size: int) -> str:
    """Windows of items against windows of documents, word by word."""

    def words(column: str) -> str:
        lower = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

    return f"""
with items as (select item_id::varchar as item, {words('text')} as w from benchmark),
windows as (select distinct item, least(len(w), {size}) as size, array_to_string(w[pos : pos + least(len(w), {size}) - 1], ' ') as key
  from (select item, w, unnest(range(1, greatest(1, len(w) - {size - 1}) + 1)) as pos from items where len(w) > 0)),
docs as (select row_number() over () as row, doc_id, {words('text')} as w from documents),
places as (select row, unnest(range(1, len(w) + 1)) as pos, w from docs),
found as (select row, pos, size, item from (
    select row, pos, size, array_to_string(w[pos : pos + size - 1], ' ') as key
    from places, (select distinct size from windows) where pos + size - 1 <= len(w)) join windows using (size, key)),
hit as (select row, count(distinct word) as n_hit from (select row, unnest(range(pos, pos + size)) as word from found) group by row),
named as (select row, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct row, item from found where item is not null) group by row)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (row) left join named using (row)"""


def centroids_sql(k: int, rounds: int, dim: int) -> str:
    """Rounds of assignment and exact means, one after the other."""
    floor = "(s - ((s % n) + n) % n) // n"

    def assigned(r: int) -> str:
        far = f"list_sum(list_transform(range(1, {dim + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
        return f"""a{r} as (select row, vec_id, v, arg_min(cluster, (far, cluster)) as cluster, min(far) as distance
  from (select row, vec_id, v, cluster, {far}::bigint as far from kept, c{r}) group by all)"""

    def moved(r: int) -> str:
        return f"""m{r} as (select cluster, list(mean order by i) as c from (
    select cluster, i, {floor} as mean from (
      select cluster, i, sum(v[i])::hugeint as s, count(*)::hugeint as n
      from a{r - 1}, (select unnest(range(1, {dim + 1})) as i) group by cluster, i)) group by cluster),
c{r} as (select cluster, coalesce(m{r}.c, c{r - 1}.c)::bigint[] as c from c{r - 1} left join m{r} using (cluster))"""

    steps = [assigned(0)]
    for r in range(1, rounds + 1):
        steps += [moved(r), assigned(r)]
    return f"""
with kept as materialized (select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings where len(embedding) = {dim}
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x) and abs(x) < 524288)) = {dim}),
c0 as (select (row_number() over (order by sha256('2:' || vec_id), v) - 1)::int as cluster, v as c from kept
  order by cluster limit {k}),
{", ".join(steps)}
select vec_id, cluster, distance, sum(distance) over (partition by cluster)::bigint as cluster_inertia,
  sum(distance) over ()::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (cluster)"""
