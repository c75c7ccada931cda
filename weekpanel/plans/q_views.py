"""Queries behind the read-side views: latest state, movers, rankings, series and data health."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekpanel.functions.casts import direction, plain, signed
from weekpanel.operators import dedupe as DD
from weekpanel.operators import display as DS
from weekpanel.operators import insights as K
from weekpanel.operators import latest as L
from weekpanel.operators import movers as MV
from weekpanel.operators import panel as P
from weekpanel.operators import ranking as R
from weekpanel.operators.encoding import contract_projection, feature_columns
from weekpanel.plans import inputs as I
from weekpanel.plans.registry import query
from weekpanel.plans.sql import with_ctes
from weekpanel.session import cut_lineage, scratch_path
from weekpanel.sources import tables as ST

_MOVER = """id, name, last_interest, round("predicted_t+1", 6) as "predicted_t+1", popularity, vote_average,
round("delta_t+1", 6) as "delta_t+1\""""
_MOVER_NUMBERS = ("predicted_t+1", "delta_t+1")


@query(
    "latest_per_entity",
    with_ctes(
        "latest",
        """select id, week_start, interest, round(roll_mean_4w, 6) as roll_mean_4w, label, name, status, popularity,
        vote_count from latest""",
    ),
)
def latest_per_entity(spark, sf):
    columns = ["id", "week_start", "interest", "roll_mean_4w", "label", "name", "status", "popularity", "vote_count"]
    return I.rounded(I.latest(spark, sf).select(*columns), "roll_mean_4w")


@query(
    "catalog_top",
    with_ctes(
        "latest",
        "select id, name, status, type, popularity, genres from latest order by popularity desc nulls last, id limit 200",
    ),
)
def catalog_top(spark, sf):
    return L.catalog_top(I.latest(spark, sf)).select("id", "name", "status", "type", "popularity", "genres")


@query(
    "change_4w",
    with_ctes(
        "trends",
        """, tail as (
  select *, row_number() over (partition by id order by week_start desc) as rn from trends)
select id, max(week_start) as latest_week, arg_max(interest, week_start) as latest_interest,
       case when count(*) >= 2 then arg_max(interest, week_start) - arg_min(interest, week_start) end as change_4w
from tail where rn <= 4 group by id""",
    ),
)
def change_4w(spark, sf):
    return L.recent_change(I.trends(spark, sf))


@query(
    "entity_trailing_26w",
    with_ctes(
        "trends",
        """select id, week_start, interest from (
  select *, max(week_start) over (partition by id) as last from trends) where week_start >= last - 182""",
    ),
)
def entity_trailing_26w(spark, sf):
    return L.trailing_per_entity(I.trends(spark, sf))


@query(
    "entity_history",
    with_ctes(
        "panel top_ids",
        """select id, week_start, interest, round(roll_mean_4w, 6) as roll_mean_4w from panel
        where id = (select id from latest order by popularity desc nulls last, id limit 1)""",
    ),
)
def entity_history(spark, sf):
    top = L.catalog_top(I.latest(spark, sf), 1).first()["id"]
    rows = L.entity_history(I.panel(spark, sf), top)
    return I.rounded(rows.select("id", "week_start", "interest", "roll_mean_4w"), "roll_mean_4w")


@query("movers_base", with_ctes("movers", f"select {_MOVER} from movers"))
def movers_base(spark, sf):
    return I.rounded(I.movers(spark, sf), *_MOVER_NUMBERS)


@query(
    "movers_gainers",
    with_ctes("strong", f'select {_MOVER} from strong order by strong."delta_t+1" desc, id limit 25'),
)
def movers_gainers(spark, sf):
    return I.rounded(MV.gainers(I.movers(spark, sf)), *_MOVER_NUMBERS)


@query("movers_losers", with_ctes("strong", f'select {_MOVER} from strong order by strong."delta_t+1", id limit 40'))
def movers_losers(spark, sf):
    return I.rounded(MV.losers(I.movers(spark, sf), n=40), *_MOVER_NUMBERS)


@query(
    "movers_both",
    with_ctes(
        "strong",
        f"""select * from (select {_MOVER} from strong order by strong."delta_t+1" desc, id limit 12)
union all select * from (select {_MOVER} from strong order by strong."delta_t+1", id limit 12)""",
    ),
)
def movers_both(spark, sf):
    return I.rounded(MV.both_ways(I.movers(spark, sf)), *_MOVER_NUMBERS)


@query(
    "movers_display",
    with_ctes(
        "strong",
        """select name as "Show", printf('%.1f', last_interest) as "Latest interest",
        printf('%.1f', "predicted_t+1") as "Forecast (t+1)", printf('%+.1f', "delta_t+1") as "Net change (t+1)"
from strong order by "delta_t+1" desc, id limit 15""",
    ),
)
def movers_display(spark, sf):
    return DS.formatted(MV.gainers(I.movers(spark, sf), n=15), DS.MOVERS)


@query(
    "export_results",
    with_ctes(
        "strong history",
        """, shown as (select * from strong order by "delta_t+1" desc, id limit 15)
select 'movers' as export, concat_ws('|', name, printf('%.1f', last_interest), printf('%.1f', "predicted_t+1"), printf('%+.1f', "delta_t+1")) as line
from shown
union all
select 'run metrics', concat_ws('|', run_id, family, cast(horizon as varchar), cast(n_train as varchar), cast(n_val as varchar)) from history""",
    ),
)
def export_results(spark, sf):
    """The exports of the result views: the movers as they are shown, and the run metrics; one CSV file each, read back."""
    root = scratch_path(spark, "export")
    metrics = I.history(spark, sf).select("run_id", "family", "horizon", "n_train", "n_val")
    out = []
    for name, table in (("movers", DS.formatted(MV.gainers(I.movers(spark, sf), n=15), DS.MOVERS)), ("run metrics", metrics)):
        path = f"{root}/{name.replace(' ', '_')}"
        ST.write_csv(table, path, single_file=True)
        read = ST.read_csv(spark, path, ", ".join(f"`{c}` string" for c in table.columns))
        out.append(read.select(F.lit(name).alias("export"), F.concat_ws("|", *[F.col(f"`{c}`") for c in read.columns]).alias("line")))
    return out[0].unionByName(out[1])


@query(
    "movers_direction",
    with_ctes(
        "movers",
        """select id, case when d >= 0 then 'Up' else 'Down' end as direction, round(abs(d), 6) as size,
        printf('%+.1f', d) as delta_text, printf('%.1f', last_interest) as interest_text
from (select id, last_interest, "delta_t+1" as d from movers)""",
    ),
)
def movers_direction(spark, sf):
    rows = I.movers(spark, sf).select("id", "last_interest", F.col("`delta_t+1`").alias("d"))
    return rows.select(
        "id",
        direction("d", "Up", "Down").alias("direction"),
        F.round(F.abs("d"), 6).alias("size"),
        signed("d").alias("delta_text"),
        plain("last_interest").alias("interest_text"),
    )


@query(
    "overview_ranked",
    with_ctes(
        "movers top_catalog",
        """select m.id, name, last_interest, round("predicted_t+1", 6) as "predicted_t+1", m.popularity, vote_average,
        round("delta_t+1", 6) as "delta_t+1", t.popularity as popularity_catalog,
        row_number() over (order by m.popularity desc nulls last, m.id) as rank_popularity
from movers m left join top_catalog t on t.id = m.id""",
    ),
)
def overview_ranked(spark, sf):
    # The latest rows feed the top catalog, the range bounds and the ranking.
    columns = ("id", "name", "interest", "roll_mean_4w", "popularity", "vote_average")
    latest = cut_lineage(I.latest(spark, sf).select(*columns))
    base = MV.movers_base(latest, "roll_mean_4w")
    return I.rounded(MV.overview_ranked(base, L.catalog_top(latest)), *_MOVER_NUMBERS)


@query(
    "overview_page",
    with_ctes(
        "movers",
        """select * from (
  select id, name, popularity, row_number() over (order by popularity desc nulls last, id) as rank_popularity,
         cast(ceil(count(*) over () / 50.0) as bigint) as n_pages from movers)
where rank_popularity between 51 and 100""",
    ),
)
def overview_page(spark, sf):
    base = I.movers(spark, sf).select("id", "name", "popularity")
    shown = R.page(base, MV.popularity_order(), 2, out="rank_popularity")
    return shown.withColumn("n_pages", R.page_count(base).scalar())


@query(
    "forecast_export",
    with_ctes(
        "trends forecast",
        """select coalesce(h.id, f.id) as id, coalesce(h.week_start, f.week_start) as week_start,
        h.interest as historical_interest, round(f.forecast, 6) as forecast
from trends h full join forecast f on f.id = h.id and f.week_start = h.week_start""",
    ),
)
def forecast_export(spark, sf):
    series = I.series(spark, sf)
    forecast = L.naive_forecast(L.latest_per_entity(series), P.HORIZONS)
    return I.rounded(L.history_with_forecast(series, forecast), "forecast")


@query(
    "outer_history_target",
    with_ctes(
        "trends",
        """, ahead as (
  select id, week_start + 7 as week_start, lead(interest) over (partition by id order by week_start) as target from trends),
known as (select * from ahead where target is not null)
select coalesce(h.id, f.id) as id, coalesce(h.week_start, f.week_start) as week_start,
       h.interest as historical_interest, f.target as forecast
from trends h full join known f on f.id = h.id and f.week_start = h.week_start""",
    ),
)
def outer_history_target(spark, sf):
    series = I.trends(spark, sf)
    ahead = P.add_targets(series, [1]).select(
        "id", F.date_add("week_start", 7).alias("week_start"), F.col("`interest_t+1`").alias("forecast")
    )
    return L.history_with_forecast(series, ahead.where(F.col("forecast").isNotNull()))


@query(
    "series_history_target",
    with_ctes(
        "trends forecast",
        """select id, week_start, interest as value, 'Historical' as series from trends
union all select id, week_start, round(forecast, 6), 'Forecast' from forecast""",
    ),
)
def series_history_target(spark, sf):
    series = I.series(spark, sf)
    forecast = L.naive_forecast(L.latest_per_entity(series), P.HORIZONS)
    return L.labelled_series(series, I.rounded(forecast, "forecast"))


@query(
    "compare_entities",
    with_ctes(
        "trends forecast top_ids",
        """, both_series as (
  select id, week_start, interest as value, 'Historical' as series from trends where id in (select id from top_ids)
  union all
  select id, week_start, round(forecast, 6), 'Forecast t+1' from forecast
  where horizon = 1 and id in (select id from top_ids))
select b.id, b.week_start, b.value, b.series, t.name as show from both_series b join top_ids t on t.id = b.id
where b.week_start >= (select max(week_start) from both_series) - 182""",
    ),
)
def compare_entities(spark, sf):
    needed = ("id", "week_start", "interest", "roll_mean_4w", "name", "popularity")
    panel = cut_lineage(I.panel(spark, sf).select(*needed))
    latest = cut_lineage(L.latest_per_entity(panel))
    forecast = I.rounded(L.naive_forecast(latest, P.HORIZONS), "forecast")
    ids = [r["id"] for r in L.catalog_top(latest, L.MAX_COMPARED).select("id").collect()]
    return L.compare_entities(panel, forecast, latest, ids)


@query(
    "feature_snapshot",
    with_ctes(
        "latest",
        """, one as (select * from latest order by popularity desc nulls last, id limit 1)
select feature, value from (
  select unnest(['interest', 'lag_interest_1w', 'lag_interest_2w', 'lag_interest_4w', 'lag_interest_8w',
    'delta_interest_1w', 'roll_mean_4w', 'roll_std_4w', 'in_production', 'number_of_seasons', 'episode_run_time_mean',
    'popularity', 'vote_average', 'vote_count']) as feature,
  unnest([round(coalesce(interest, 0), 6), coalesce(lag_interest_1w, 0), coalesce(lag_interest_2w, 0),
    coalesce(lag_interest_4w, 0), coalesce(lag_interest_8w, 0), coalesce(delta_interest_1w, 0),
    round(coalesce(roll_mean_4w, 0), 6), round(coalesce(roll_std_4w, 0), 6), cast(in_production as double),
    number_of_seasons, coalesce(episode_run_time_mean, 0), popularity, vote_average, vote_count]) as value
  from one) order by abs(value) desc, feature limit 40""",
    ),
)
def feature_snapshot(spark, sf):
    latest = I.latest(spark, sf)
    names = feature_columns(latest)
    one = contract_projection(L.catalog_top(latest, 1), names)
    return I.rounded(K.feature_snapshot(one, names), "value")


@query(
    "interest_histogram",
    with_ctes(
        "trends",
        """select cast(least(floor(interest / 5) * 5, 95) as double) as bin_start, count(*) as weeks
from trends group by 1""",
    ),
)
def interest_histogram(spark, sf):
    return K.histogram(I.trends(spark, sf), width=K.nice_width(0, 100))


# All columns of the panel.
_COLUMNS = (
    "id week_start interest lag_interest_1w lag_interest_2w lag_interest_4w lag_interest_8w delta_interest_1w roll_mean_4w "
    "roll_std_4w label name original_name first_air_date last_air_date status type in_production number_of_seasons "
    "episode_run_time_mean popularity vote_average vote_count keywords certification genres networks language"
).split()


@query(
    "missingness_top",
    with_ctes(
        "panel",
        'select "column", missing_rate from ('
        + " union all ".join(
            f"""select '{c}' as "column", round(100.0 * avg(case when {c} is null then 1 else 0 end), 2) as missing_rate
            from panel"""
            for c in _COLUMNS
        )
        + """) order by missing_rate desc, "column" limit 12""",
    ),
)
def missingness_top(spark, sf):
    return K.missingness(I.panel(spark, sf))


@query(
    "dedupe_first",
    """select event_id, user_id, event_type, value from events
qualify row_number() over (partition by user_id order by event_id) = 1
order by event_id limit 100""",
)
def dedupe_first(spark, sf):
    events = I.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return DD.dedupe_first(events, "user_id", "event_id", 100)
