"""Common table expressions shared by the check queries."""

from __future__ import annotations

WORD = r"[\p{L}\p{N}_]{2,}"

CTES = {
    "trends": """
select l_partkey as id, cast(date_trunc('week', l_shipdate) as date) as week_start,
       cast(floor(100 * sum(l_quantity) / max(sum(l_quantity)) over (partition by l_partkey)) as double) as interest
from lineitem group by l_partkey, cast(date_trunc('week', l_shipdate) as date)""",
    "catalog": """
select p.p_partkey as id, p.p_name as name, concat('Part ', cast(p.p_partkey as varchar)) as original_name,
       a.first_air_date, a.last_air_date,
       case when p.p_size % 11 = 0 then null else concat('ST', cast(p.p_size % 4 as varchar)) end as status,
       p.p_type as type, p.p_size > 25 as in_production, p.p_size as number_of_seasons,
       case when p.p_partkey % 10 = 0 then null else cast(p.p_size as double) end as episode_run_time_mean,
       p.p_retailprice as popularity, a.vote_average, a.vote_count,
       concat(p.p_name, ' ', lower(p.p_type), ' size', cast(p.p_size as varchar)) as keywords,
       case when p.p_size % 7 = 0 then null else concat('C', cast(p.p_size % 5 as varchar)) end as certification,
       concat(p.p_type, ', ', split_part(p.p_name, ' ', 2)) as genres, p.p_brand as networks,
       concat('L', cast(p.p_partkey % 6 as varchar)) as language
from part p
left join (select l_partkey, min(cast(l_shipdate as date)) as first_air_date,
                  max(case when cast(l_shipdate as date) < date '1999-01-01' then cast(l_shipdate as date) end) as last_air_date,
                  round(cast(sum(cast(l_discount as decimal(18,2))) as double) / count(l_discount) * 100, 4) as vote_average,
                  count(*) as vote_count
           from lineitem group by l_partkey) a on a.l_partkey = p.p_partkey""",
    "feat": """
select id, week_start, interest,
       lag(interest, 1) over w as lag_interest_1w, lag(interest, 2) over w as lag_interest_2w,
       lag(interest, 4) over w as lag_interest_4w, lag(interest, 8) over w as lag_interest_8w,
       interest - lag(interest, 1) over w as delta_interest_1w,
       avg(interest) over r4 as roll_mean_4w,
       case when count(interest) over r4 >= 2 then stddev_samp(interest) over r4 end as roll_std_4w,
       case when count(interest) over r8 >= 3 then quantile_cont(interest, 0.8) over r8 end as roll_q80_8w,
       lead(interest, 1) over w as next_interest
from trends
window w as (partition by id order by week_start),
       r4 as (partition by id order by week_start rows between 3 preceding and current row),
       r8 as (partition by id order by week_start rows between 7 preceding and current row)""",
    "panel": """
select f.id, f.week_start, f.interest, lag_interest_1w, lag_interest_2w, lag_interest_4w, lag_interest_8w,
       delta_interest_1w, roll_mean_4w, roll_std_4w,
       cast(coalesce(next_interest > roll_q80_8w, false) as int) as label, c.* exclude (id)
from feat f join catalog c on c.id = f.id""",
    "targets": """
select *, lead(interest, 1) over w as t1, lead(interest, 2) over w as t2,
       lead(interest, 3) over w as t3, lead(interest, 4) over w as t4
from panel window w as (partition by id order by week_start)""",
    "weeks": """
select week_start, row_number() over (order by week_start) - 1 as pos, count(*) over () as n
from (select distinct week_start from panel)""",
    "cut": "select week_start as cutoff_week from weeks where pos = floor(n * 0.8)",
    "long_targets": """
select horizon, case when week_start < cutoff_week then 'train' else 'val' end as split, cutoff_week, y, p
from (select week_start, roll_mean_4w as p, unnest([1, 2, 3, 4]) as horizon, unnest([t1, t2, t3, t4]) as y
      from targets) t, cut
where y is not null""",
    "ents": """
select c.*, w.n_weeks from catalog c
join (select id, count(*) as n_weeks from trends group by id) w on w.id = c.id""",
    "cert_mode": """
select certification from ents where certification is not null
group by certification order by sum(n_weeks) desc, certification limit 1""",
    "group_medians": """
select genres, median(episode_run_time_mean) as med from trends t join catalog c on c.id = t.id group by genres""",
    "group_filled": """
select e.id, e.n_weeks, coalesce(e.episode_run_time_mean, g.med) as run_time
from ents e left join group_medians g on g.genres = e.genres""",
    "overall_median": """
select median(run_time) as med from trends t join group_filled f on f.id = t.id""",
    "genre_items": """
select id, n_weeks, trim(unnest(string_split(genres, ','))) as token from ents""",
    "network_items": """
select id, n_weeks, trim(unnest(string_split(networks, ','))) as token from ents""",
    "top_genres": """
select token, cast(sum(n_weeks) as bigint) as n from genre_items where token <> ''
group by token order by n desc, token limit 15""",
    "top_networks": """
select token, cast(sum(n_weeks) as bigint) as n from network_items where token <> ''
group by token order by n desc, token limit 20""",
    "kw_tf": rf"""
select id, n_weeks, term, count(*) as tf
from (select id, n_weeks, unnest(regexp_extract_all(lower(keywords), '{WORD}')) as term from ents)
group by id, n_weeks, term""",
    "kw_counts": """
select term, sum(tf * n_weeks) as n, sum(n_weeks) as df from kw_tf group by term""",
    "kw_vocab": """
select term, n, df, row_number() over (order by term) - 1 as idx
from (select * from kw_counts order by n desc, term limit 200)""",
    "kw_idf": """
select term, idx, n, df, ln((1 + (select sum(n_weeks) from ents)) / (1 + df)) + 1 as idf from kw_vocab""",
    "kw_raw": "select t.id, t.term, t.tf * i.idf as raw from kw_tf t join kw_idf i on i.term = t.term",
    "kw_scores": """
select id, term, raw / sqrt(sum(raw * raw) over (partition by id)) as score from kw_raw""",
    "latest": """
select * from panel
qualify row_number() over (partition by id order by week_start desc) = 1""",
    "movers": """
select id, name, interest as last_interest, least(greatest(roll_mean_4w, 0), 100) as "predicted_t+1",
       popularity, vote_average, least(greatest(roll_mean_4w, 0), 100) - interest as "delta_t+1"
from latest where interest > 0""",
    "strong": "select * from movers where last_interest >= 5",
    "forecast": """
select id, horizon, week_start + cast(7 * horizon as int) as week_start, forecast
from (select id, week_start, roll_mean_4w as forecast, unnest([1, 2, 3, 4]) as horizon from latest)""",
    "top_ids": "select id, name from latest order by popularity desc nulls last, id limit 5",
    "top_catalog": "select id, popularity from latest order by popularity desc nulls last, id limit 200",
    "doc_tf": rf"""
select doc_id, term, count(*) as tf
from (select doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) as term from documents)
group by doc_id, term""",
    "doc_counts": "select term, sum(tf) as n, count(*) as df from doc_tf group by term",
    "doc_vocab": "select * from doc_counts order by n desc, term limit 200",
    "metrics_old": """
select concat('run_', cast(year(o_orderdate) as varchar)) as run_id,
       lower(split_part(o_orderpriority, '-', 2)) as family, cast(1 + o_custkey % 4 as int) as horizon,
       concat(cast(year(o_orderdate) as varchar), '-06-01T00:00:00Z') as created_utc,
       min(o_totalprice) / 1000 as rmse_train, max(o_totalprice) / 1000 as rmse_val,
       1 - min(o_totalprice) / max(o_totalprice) as r2_train,
       min(o_totalprice) / max(o_totalprice) as r2_val,
       cast(count(*) as bigint) as n_train, cast(count(case when o_orderstatus = 'F' then 1 end) as bigint) as n_val
from orders where year(o_orderdate) <= 1998 group by 1, 2, 3, 4""",
    "metrics_new": """
select concat('run_', cast(year(o_orderdate) as varchar)) as run_id,
       lower(split_part(o_orderpriority, '-', 2)) as family, cast(1 + o_custkey % 4 as int) as horizon,
       concat(cast(year(o_orderdate) as varchar), '-06-01T00:00:00Z') as created_utc,
       min(o_totalprice) / 500 as rmse_train, max(o_totalprice) / 500 as rmse_val,
       1 - min(o_totalprice) / max(o_totalprice) as r2_train,
       min(o_totalprice) / max(o_totalprice) as r2_val,
       cast(count(*) as bigint) as n_train, cast(count(case when o_orderstatus = 'F' then 1 end) as bigint) as n_val
from orders where year(o_orderdate) >= 1998 group by 1, 2, 3, 4""",
    "history": """
select * from metrics_new union all
select * from metrics_old o where not exists (
  select 1 from metrics_new n
  where n.run_id = o.run_id and n.family = o.family and n.horizon = o.horizon and n.created_utc = o.created_utc)""",
}

# Which expressions an expression reads.
_NEEDS = {
    "feat": ["trends"],
    "panel": ["feat", "catalog"],
    "targets": ["panel"],
    "weeks": ["panel"],
    "cut": ["weeks"],
    "long_targets": ["targets", "cut"],
    "ents": ["catalog", "trends"],
    "cert_mode": ["ents"],
    "group_medians": ["trends", "catalog"],
    "group_filled": ["ents", "group_medians"],
    "overall_median": ["trends", "group_filled"],
    "genre_items": ["ents"],
    "network_items": ["ents"],
    "top_genres": ["genre_items"],
    "top_networks": ["network_items"],
    "kw_tf": ["ents"],
    "kw_counts": ["kw_tf"],
    "kw_vocab": ["kw_counts"],
    "kw_idf": ["kw_vocab", "ents"],
    "kw_raw": ["kw_tf", "kw_idf"],
    "kw_scores": ["kw_raw"],
    "latest": ["panel"],
    "movers": ["latest"],
    "strong": ["movers"],
    "forecast": ["latest"],
    "top_ids": ["latest"],
    "top_catalog": ["latest"],
    "doc_counts": ["doc_tf"],
    "doc_vocab": ["doc_counts"],
    "history": ["metrics_old", "metrics_new"],
}


def with_ctes(names: str, body: str) -> str:
    """``body`` preceded by the named expressions and all they read."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for n in _NEEDS.get(name, []):
                visit(n)
            ordered.append(name)

    for name in names.split():
        visit(name)
    head = ",\n".join(f"{n} as ({CTES[n]})" for n in ordered)
    # A body that starts with a comma brings expressions of its own.
    return f"with {head}{body}" if body.startswith(",") else f"with {head}\n{body}"
