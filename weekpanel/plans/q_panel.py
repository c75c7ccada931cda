"""Queries on projections, windows, targets and the time split."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekpanel.functions import casts as C
from weekpanel.functions import dates as D
from weekpanel.functions import text as TX
from weekpanel.operators import encoding as E
from weekpanel.operators import panel as P
from weekpanel.operators import split as S
from weekpanel.operators.insights import panel_summary
from weekpanel.plans import inputs as I
from weekpanel.plans.registry import query
from weekpanel.plans.sql import CTES, with_ctes
from weekpanel.schemas import TRENDS
from weekpanel.session import cut_lineage, scratch_path
from weekpanel.streaming import weekly as W

FEATURES = (
    "lag_interest_1w, lag_interest_2w, lag_interest_4w, lag_interest_8w, delta_interest_1w, "
    "round(roll_mean_4w, 6) as roll_mean_4w, round(roll_std_4w, 6) as roll_std_4w"
)


@query(
    "panel_base",
    with_ctes(
        "panel",
        f"""select id, week_start, interest, {FEATURES}, label, name, original_name, first_air_date,
        last_air_date, status, type, in_production, number_of_seasons, episode_run_time_mean, popularity,
        vote_average, vote_count, keywords, certification, genres, networks, language from panel""",
    ),
)
def panel_base(spark, sf):
    return I.rounded(I.panel(spark, sf), "roll_mean_4w", "roll_std_4w")


@query(
    "win_lags",
    with_ctes(
        "feat",
        "select id, week_start, lag_interest_1w, lag_interest_2w, lag_interest_4w, lag_interest_8w from feat",
    ),
)
def win_lags(spark, sf):
    lags = P.lag_features()
    return I.trends(spark, sf).withColumns(lags).select("id", "week_start", *lags)


@query("win_delta", with_ctes("feat", "select id, week_start, delta_interest_1w from feat"))
def win_delta(spark, sf):
    return P.add_time_features(I.trends(spark, sf)).select("id", "week_start", "delta_interest_1w")


@query(
    "win_roll_mean", with_ctes("feat", "select id, week_start, round(roll_mean_4w, 6) as roll_mean_4w from feat")
)
def win_roll_mean(spark, sf):
    return I.trends(spark, sf).select("id", "week_start", F.round(P.roll_mean(), 6).alias("roll_mean_4w"))


@query("win_roll_std", with_ctes("feat", "select id, week_start, round(roll_std_4w, 6) as roll_std_4w from feat"))
def win_roll_std(spark, sf):
    return I.trends(spark, sf).select("id", "week_start", F.round(P.roll_std(), 6).alias("roll_std_4w"))


@query("win_roll_q80", with_ctes("feat", "select id, week_start, round(roll_q80_8w, 6) as roll_q80_8w from feat"))
def win_roll_q80(spark, sf):
    rows = P.add_roll_quantile(I.trends(spark, sf))
    return rows.select("id", "week_start", F.round("roll_q80_8w", 6).alias("roll_q80_8w"))


@query(
    "win_label",
    with_ctes(
        "feat", "select id, week_start, cast(coalesce(next_interest > roll_q80_8w, false) as int) as label from feat"
    ),
)
def win_label(spark, sf):
    return P.add_time_features(I.trends(spark, sf)).select("id", "week_start", "label")


@query(
    "win_targets",
    with_ctes(
        "targets",
        """select id, week_start, t1 as "interest_t+1", t2 as "interest_t+2", t3 as "interest_t+3",
        t4 as "interest_t+4" from targets""",
    ),
)
def win_targets(spark, sf):
    names = [f"`interest_t+{h}`" for h in P.HORIZONS]
    return P.add_targets(I.trends(spark, sf)).select("id", "week_start", *names)


@query(
    "filter_date_range",
    with_ctes(
        "trends",
        """select id, week_start, interest, lag(interest, 1) over (partition by id order by week_start) as lag_interest_1w
        from trends where week_start between date '1997-01-06' and date '1999-12-27'""",
    ),
)
def filter_date_range(spark, sf):
    kept = P.clean_trends(I.trends(spark, sf), "1997-01-06", "1999-12-27", collapse=False)
    return P.add_time_features(kept).select("id", "week_start", "interest", "lag_interest_1w")


@query(
    "proj_tolerant_cast",
    """with t as (
  select event_id, event_type, cast(json_extract_string(props, '$.k') as int) as k from events),
v as (select event_id, k,
  try_cast(case event_type when 'error' then 'x' when 'signup' then 'NaN' when 'view' then 'Infinity'
           else cast(k as varchar) end as double) as num from t)
select event_id, case when isfinite(num) then num end as num,
       try_cast(concat('2024-', lpad(cast(k % 15 as varchar), 2, '0'), '-15') as date) as day,
       try_cast(case when k > 50 then concat(cast(k as varchar), 'a') else cast(k as varchar) end as bigint) as key
from v""",
)
def proj_tolerant_cast(spark, sf):
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    text = F.when(kind == "error", "x").when(kind == "signup", "NaN").when(kind == "view", "Infinity").otherwise(k)
    month = F.lpad((k.cast("int") % 15).cast("string"), 2, "0")
    day = F.concat(F.lit("2024-"), month, F.lit("-15"))
    key = F.when(k.cast("int") > 50, F.concat(k, F.lit("a"))).otherwise(k)
    return I.table(spark, sf, "events").select(
        "event_id", C.to_number(text).alias("num"), C.to_date(day).alias("day"), C.to_id(key).alias("key")
    )


@query(
    "filter_null_keys",
    with_ctes(
        "catalog",
        "select id, status, certification from catalog where status is not null and certification is not null",
    ),
)
def filter_null_keys(spark, sf):
    rows = I.catalog(spark, sf).na.drop(subset=["status", "certification"])
    return rows.select("id", "status", "certification")


@query(
    "proj_fill_text",
    with_ctes(
        "catalog",
        "select id, coalesce(status, '') as status, coalesce(certification, '') as certification, genres from catalog",
    ),
)
def proj_fill_text(spark, sf):
    filled = C.fill_text(I.catalog(spark, sf), ["status", "certification", "no_such_column"])
    return filled.select("id", "status", "certification", "genres")


@query(
    "proj_clean_nonfinite",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       case when l_discount > 0 and l_tax > 0 then round(l_tax / l_discount, 6) end as ratio
from lineitem""",
)
def proj_clean_nonfinite(spark, sf):
    tax, discount = F.col("l_tax"), F.col("l_discount")
    ratio = (
        F.when((tax == 0) & (discount == 0), F.lit(float("nan")))
        .when(discount == 0, F.lit(float("inf")))
        .when(tax == 0, F.lit(float("-inf")))
        .otherwise(F.round(F.try_divide(tax, discount), 6))
    )
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return C.clean_nonfinite(I.table(spark, sf, "lineitem").select(*keys, ratio.alias("ratio")))


@query(
    "date_week_start",
    """select o_orderkey, cast(date_trunc('week', o_orderdate) as date) as week_start,
       case when o_orderstatus = 'F' then 'manual' else concat('airflow_', strftime(o_orderdate, '%Y%m%d')) end as run_id,
       cast(date_trunc('week', o_orderdate) as date) + 28 as in_four_weeks
from orders""",
)
def date_week_start(spark, sf):
    given = F.when(F.col("o_orderstatus") == "F", "manual")
    return I.table(spark, sf, "orders").select(
        "o_orderkey",
        D.week_start("o_orderdate").alias("week_start"),
        D.run_id_for(given, "o_orderdate").alias("run_id"),
        D.weeks_after(D.week_start("o_orderdate"), 4).alias("in_four_weeks"),
    )


@query(
    "json_props",
    """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
       concat('{"k2":', cast(2 * cast(json_extract_string(props, '$.k') as bigint) as varchar), '}') as back
from events""",
)
def json_props(spark, sf):
    k = F.from_json("props", "k bigint")["k"]
    return I.table(spark, sf, "events").select(
        "event_id", k.alias("k"), F.to_json(F.struct((2 * k).alias("k2"))).alias("back")
    )


@query(
    "str_split_list",
    with_ctes(
        "catalog",
        """select id, array_to_string(list_filter(list_transform(string_split(concat(' ', genres, ', ,', networks, ' '), ','),
        lambda x: trim(x)), lambda x: x <> ''), '|') as items from catalog""",
    ),
)
def str_split_list(spark, sf):
    messy = F.concat(F.lit(" "), "genres", F.lit(", ,"), "networks", F.lit(" "))
    return I.catalog(spark, sf).select("id", F.array_join(TX.split_list(messy), "|").alias("items"))


@query(
    "search_terms",
    with_ctes(
        "catalog",
        """select id, case when base = '' then '' when net = '' then concat(base, ' tv series')
        else concat(base, ' tv series|', base, ' ', net, '|', base, ' ', net, ' tv series') end as terms
from (select id, trim(coalesce(nullif(case when status is null then '' else name end, ''), original_name, '')) as base,
             case when certification is null then '' else networks end as net from catalog)""",
    ),
)
def search_terms(spark, sf):
    name = F.when(F.col("status").isNull(), "").otherwise(F.col("name"))
    networks = F.when(F.col("certification").isNotNull(), F.col("networks"))
    terms = TX.search_terms(name, "original_name", networks)
    return I.catalog(spark, sf).select("id", F.array_join(terms, "|").alias("terms"))


@query(
    "str_pretty_kw",
    with_ctes(
        "catalog",
        """select id, keyword, concat(upper(left(r, 1)), substr(r, 2)) as keyword_readable
from (select id, keyword, trim(replace(replace(replace(keyword, 'kw_', ''), 'KW_', ''), '_', ' ')) as r
      from (select id, concat('kw__', replace(keywords, ' ', '_')) as keyword from catalog))""",
    ),
)
def str_pretty_kw(spark, sf):
    keyword = F.concat(F.lit("kw__"), F.replace("keywords", F.lit(" "), F.lit("_")))
    return I.catalog(spark, sf).select(
        "id", keyword.alias("keyword"), TX.pretty_keyword(keyword).alias("keyword_readable")
    )


@query(
    "str_label_parse",
    """select o_orderkey, concat(o_orderpriority, ' (id=', cast(o_orderkey as varchar), ')') as label,
       o_orderkey as label_id, concat('run_', o_orderstatus) as run_id
from orders""",
)
def str_label_parse(spark, sf):
    label = TX.entity_label("o_orderpriority", "o_orderkey")
    run = TX.run_label("o_orderpriority", F.concat(F.lit("run_"), "o_orderstatus"), F.lit(None).cast("string"))
    return I.table(spark, sf, "orders").select(
        "o_orderkey",
        label.alias("label"),
        TX.label_id(label).alias("label_id"),
        TX.run_label_id(run).alias("run_id"),
    )


@query(
    "split_counts",
    with_ctes(
        "long_targets",
        """select horizon, cast(count(case when split = 'train' then 1 end) as bigint) as n_train,
        cast(count(case when split = 'val' then 1 end) as bigint) as n_val, cutoff_week
        from long_targets group by horizon, cutoff_week""",
    ),
)
def split_counts(spark, sf):
    return S.split_counts(S.time_split(I.targets(spark, sf)))


@query(
    "split_fallback",
    """with short as (
  select user_id as id, cast(date_trunc('month', ts) as date) + cast(10 * ((day(ts) - 1) // 10) as int) as week_start,
         cast(count(*) as double) as interest
  from events group by 1, 2)
select id, week_start, interest,
       case when row_number() over (order by id, week_start) <= floor(count(*) over () * 0.8) then 'train' else 'val' end as split,
       max(week_start) over () as cutoff_week
from short""",
)
def split_fallback(spark, sf):
    # Ten-day periods of one month: fewer than five, so the rows are split by position.
    period = F.floor((F.dayofmonth("ts") - 1) / 10).cast("int") * 10
    start = F.date_add(F.trunc(F.col("ts").cast("date"), "MONTH"), period)
    keys = (F.col("user_id").alias("id"), start.alias("week_start"))
    rows = I.table(spark, sf, "events").groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("interest"))
    return S.time_split(rows)


@query(
    "snapshot_stats",
    with_ctes(
        "targets",
        """select count(*) as n_rows, 32 as n_cols, 14 as n_features, count(distinct week_start) as n_unique_weeks,
        count(distinct id) as n_unique_shows from targets""",
    ),
)
def snapshot_stats(spark, sf):
    frame = I.targets(spark, sf)
    return S.snapshot(frame, len(E.feature_columns(frame)))


@query(
    "panel_summary",
    with_ctes(
        "panel",
        """select count(*) as n_rows, count(distinct id) as n_shows, min(week_start) as min_week, max(week_start) as max_week,
        round(100.0 * avg(case when interest is null then 1 else 0 end), 6) as pct_interest_missing from panel""",
    ),
)
def panel_summary_query(spark, sf):
    return I.rounded(panel_summary(I.panel(spark, sf)), "pct_interest_missing")


@query(
    "eval_metrics",
    with_ctes(
        "long_targets",
        """select horizon, split, count(*) as n, round(sqrt(avg((y - p) * (y - p))), 6) as rmse,
        round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) as r2 from long_targets group by horizon, split""",
    ),
)
def eval_metrics(spark, sf):
    rows = S.target_rows(S.time_split(I.targets(spark, sf)), "roll_mean_4w")
    return I.rounded(S.error_metrics(rows, ["horizon", "split"]), "rmse", "r2")


_FEATURES = CTES["feat"].replace("from trends", "from merged")


@query(
    "panel_collapsed",
    with_ctes(
        "trends catalog",
        f""", raw as (
  select id, week_start, case when (id + week(week_start)) % 9 <> 0 then interest end as interest from trends
  union all
  select id, week_start, interest / 4 from trends where id % 3 = 0),
merged as (select id, week_start, avg(interest) as interest from raw group by id, week_start),
feat as ({_FEATURES})
select f.id, f.week_start, round(f.interest, 6) as interest, round(lag_interest_2w, 6) as lag_interest_2w,
       round(roll_mean_4w, 6) as roll_mean_4w, round(roll_std_4w, 6) as roll_std_4w,
       cast(coalesce(next_interest > roll_q80_8w, false) as int) as label,
       case when c.id % 7 <> 0 and c.id % 3 < 2 then c.name else upper(c.name) end as name
from feat f join catalog c on c.id = f.id""",
    ),
)
def panel_collapsed(spark, sf):
    """Repeated and missing weeks, and a catalog that repeats its ids: the first by ``seen`` counts, a missing one last."""
    trends, cat = I.trends(spark, sf), I.catalog(spark, sf)
    known = (F.col("id") + F.weekofyear("week_start")) % 9 != 0
    gaps = trends.withColumn("interest", F.when(known, F.col("interest")))
    again = trends.where(F.col("id") % 3 == 0).withColumn("interest", F.col("interest") / 4)
    seen = F.when(F.col("id") % 7 != 0, (F.col("id") % 3).cast("double"))
    twice = cat.withColumn("seen", seen).unionByName(
        cat.withColumn("name", F.upper("name")).withColumn("seen", F.lit(1.5))
    )
    panel = P.build_panel(gaps.unionByName(again), twice, catalog_order=["seen"])
    shown = panel.select(
        "id", "week_start", "interest", "lag_interest_2w", "roll_mean_4w", "roll_std_4w", "label", "name"
    )
    return I.rounded(shown, "interest", "lag_interest_2w", "roll_mean_4w", "roll_std_4w")


@query(
    "panel_from_arrivals",
    with_ctes(
        "feat",
        """select id, week_start, interest, lag_interest_1w, lag_interest_8w, delta_interest_1w,
        round(roll_mean_4w, 6) as roll_mean_4w, round(roll_std_4w, 6) as roll_std_4w,
        cast(coalesce(next_interest > roll_q80_8w, false) as int) as label,
        lead(interest, 1) over w as t1, lead(interest, 4) over w as t4
        from feat window w as (partition by id order by week_start)""",
    ),
)
def panel_from_arrivals(spark, sf):
    """The series kept up from three landings, each taken by a run of its own: old weeks, new weeks, and weeks that are
    late. It equals what the whole table gives at once."""
    root = scratch_path(spark, "arrivals")
    landed, target, checkpoint = f"{root}/landed", f"{root}/target", f"{root}/checkpoint"
    trends = cut_lineage(I.trends(spark, sf))
    late = F.pmod(F.xxhash64("id", "week_start"), F.lit(20)) == 0
    new = F.col("week_start") >= F.lit("2000-06-01").cast("date")
    for part in (~late & ~new, ~late & new, late):
        trends.where(part).write.mode("append").option("header", True).csv(landed)
        W.update_series(spark, landed, TRENDS, target, checkpoint)
    out = I.rounded(W.current_series(spark, target), "roll_mean_4w", "roll_std_4w")
    return out.select(
        "id", "week_start", "interest", "lag_interest_1w", "lag_interest_8w", "delta_interest_1w", "roll_mean_4w", "roll_std_4w", "label",
        F.col("`interest_t+1`").alias("t1"), F.col("`interest_t+4`").alias("t4"),
    )
