"""Queries on sources, sinks, resumable loads and publication. Files go to the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekpanel.operators.encoding import feature_columns
from weekpanel.operators.panel import add_time_features, weekly_series
from weekpanel.plans import inputs as I
from weekpanel.plans.registry import query
from weekpanel.plans.sql import with_ctes
from weekpanel.schemas import CACHE_ROW, TRENDS
from weekpanel.session import scratch_path
from weekpanel.sources import documents as DOC
from weekpanel.sources import landing as LD
from weekpanel.sources import publish as PB
from weekpanel.sources import tables as ST
from weekpanel.streaming import landing as SL


@query(
    "src_pages_explode",
    """select p_partkey as id, p_name as name, p_brand as original_name, '1999-01-01' as first_air_date,
       p_retailprice as popularity, cast(p_size as double) as vote_average, cast(p_size as bigint) as vote_count,
       concat('C', cast(p_size % 3 as varchar), ',US') as origin_country, p_type as language from part
union all
select p_partkey, upper(p_name), p_brand, null, p_retailprice, 0, null, '', p_type from part""",
)
def src_pages_explode(spark, sf):
    size = F.col("p_size")
    countries = F.array(F.concat(F.lit("C"), (size % 3).cast("string")), F.lit("US"))

    def item(name, aired, rating, votes, origin):
        return F.struct(
            F.col("p_partkey").alias("id"),
            name.alias("name"),
            F.col("p_brand").alias("original_name"),
            aired.cast("string").alias("first_air_date"),
            F.col("p_retailprice").alias("popularity"),
            rating.alias("vote_average"),
            votes.cast("bigint").alias("vote_count"),
            origin.cast("array<string>").alias("origin_country"),
            F.col("p_type").alias("original_language"),
        )

    first = item(F.col("p_name"), F.lit("1999-01-01"), size.cast("double"), size, countries)
    second = item(F.upper("p_name"), F.lit(None), F.lit(0.0), F.lit(None), F.lit(None))
    page = F.to_json(F.struct(F.lit(25).alias("total_pages"), F.array(first, second).alias("results")))
    path = scratch_path(spark, "pages")
    I.table(spark, sf, "part").select(page.alias("value")).write.text(path)
    return DOC.entity_list(DOC.read_list_pages(spark, path))


@query(
    "src_catalog_from_json",
    with_ctes(
        "catalog",
        """select id, name, original_name, cast(first_air_date as varchar) as first_air_date,
        cast(last_air_date as varchar) as last_air_date, status, type, in_production, number_of_seasons,
        2 * number_of_seasons as number_of_episodes,
        case when id % 10 <> 0 then cast(number_of_seasons + 1 as double) end as episode_run_time_mean,
        popularity, vote_average, vote_count, number_of_seasons % 4 as num_cast,
        case when number_of_seasons % 3 = 0 then 1 else 2 end as num_directors,
        replace(keywords, ' ', ',') as keywords,
        case when number_of_seasons % 7 = 0 then null when number_of_seasons % 2 = 0 then concat('US', certification)
             else concat('GB', certification) end as certification,
        concat('tt', cast(id as varchar)) as imdb_id, replace(genres, ', ', ',') as genres, networks, language
from catalog""",
    ),
)
def src_catalog_from_json(spark, sf):
    cat = I.catalog(spark, sf)
    size = F.col("number_of_seasons")

    def named(items):
        return F.transform(items, lambda x: F.struct(x.alias("name")))

    def rating(country):
        text = F.concat(F.lit(country), "certification")
        return F.struct(F.lit(country).alias("iso_3166_1"), text.alias("rating"))

    def crew(name, job):
        return F.struct(F.lit(name).alias("name"), F.lit(job).alias("job"))

    cast = F.transform(F.slice(F.sequence(F.lit(0), size % 4), F.lit(2), size % 4), lambda i: i.cast("string"))
    two = F.array(crew("a", "Director"), crew("b", "Writer"), crew("c", "Director"))
    one = F.array(crew("a", "Director"), crew("b", "Writer"))
    foreign, domestic = rating("GB"), rating("US")
    ratings = (
        F.when(size % 7 == 0, F.slice(F.array(foreign), 1, 0))
        .when(size % 2 == 0, F.array(foreign, domestic))
        .otherwise(F.array(foreign))
    )
    times = F.when(F.col("id") % 10 != 0, F.array(size, size + 2)).otherwise(F.slice(F.array(size), 1, 0))
    doc = F.struct(
        "id", "name", "original_name",
        F.col("first_air_date").cast("string").alias("first_air_date"),
        F.col("last_air_date").cast("string").alias("last_air_date"),
        "status", "type", "in_production", "number_of_seasons",
        (2 * size).alias("number_of_episodes"),
        times.alias("episode_run_time"),
        "popularity", "vote_average", "vote_count",
        F.col("language").alias("original_language"),
        named(F.split("genres", ", ")).alias("genres"),
        named(F.array("networks")).alias("networks"),
        F.struct(named(cast).alias("cast"), F.when(size % 3 == 0, one).otherwise(two).alias("crew")).alias("credits"),
        F.struct(named(F.split("keywords", " ")).alias("results")).alias("keywords"),
        F.struct(ratings.alias("results")).alias("content_ratings"),
        F.struct(F.concat(F.lit("tt"), F.col("id").cast("string")).alias("imdb_id")).alias("external_ids"),
    )
    # Every large entity also has a broken copy, a copy without id and one with an unnamed genre.
    broken = F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "name": '))
    no_id = F.lit('{"name": "x"}')
    unnamed = F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "genres": [{"k": 1}]}'))
    bad = F.when(size > 45, F.array(broken, no_id, unnamed)).otherwise(F.array().cast("array<string>"))
    lines = cat.select(F.explode(F.concat(F.array(F.to_json(doc)), bad)).alias("value"))
    path = scratch_path(spark, "details")
    lines.write.text(path)
    return DOC.flatten_details(DOC.read_details(spark, path))


@query("sink_csv_roundtrip", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    rows = I.table(spark, sf, "customer")
    ST.write_csv(rows, path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return ST.read_csv(spark, path, schema)


@query("sink_parquet_roundtrip", with_ctes("trends", "select id, week_start, interest from trends"))
def sink_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet")
    ST.write_parquet(I.trends(spark, sf), path)
    return ST.read_parquet(spark, path)


@query("src_pruned_scan", with_ctes("catalog", "select id, name, original_name, networks from catalog"))
def src_pruned_scan(spark, sf):
    path = scratch_path(spark, "catalog")
    ST.write_parquet(I.catalog(spark, sf), path)
    return ST.read_parquet(spark, path, ["id", "name", "original_name", "networks"])


_RUNS = [{"run_id": "first", "week_start": "2024-01-01"}, {"run_id": "second", "week_start": "2024-01-08"}]


@query(
    "sink_run_partitioned",
    with_ctes(
        "trends",
        "select id, week_start as week, interest, 'second' as run_id, '2024-01-08' as week_start from trends where interest >= 50",
    ),
)
def sink_run_partitioned(spark, sf):
    path = scratch_path(spark, "runs")
    rows = I.trends(spark, sf).withColumnRenamed("week_start", "week")
    ST.write_run(rows, path, _RUNS[0])
    ST.write_run(rows.where(F.col("interest") >= 50), path, _RUNS[1])
    found = ST.read_run(spark, path, _RUNS[1])
    return found.withColumns({c: F.col(c).cast("string") for c in ("run_id", "week_start")})


_NATION_SQL = """select cast(s.s_nationkey as bigint) as id, cast(date_trunc('week', l.l_shipdate) as date) as week_start,
       sum(l.l_quantity) as interest
from lineitem l join supplier s on s.s_suppkey = l.l_suppkey group by 1, 2"""


def _nation_series(spark, sf):
    """Weekly quantity per nation: few entities with long series."""
    # Aggregated per supplier before the join, so that a hot supplier is a few rows there.
    sold = weekly_series(
        I.table(spark, sf, "lineitem"), "l_suppkey", "l_shipdate", "l_quantity", scale_to_peak=False
    )
    nation = I.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("bigint").alias("nation")
    )
    return weekly_series(sold.join(nation, "id"), "nation", "week_start", "interest", scale_to_peak=False)


@query("src_cache_scan", _NATION_SQL)
def src_cache_scan(spark, sf):
    path = scratch_path(spark, "cache")
    LD.write_entity_cache(_nation_series(spark, sf), path)
    return LD.usable_series(LD.read_entity_cache(spark, path)).select("id", "week_start", "interest")


@query("src_cache_bucketed", with_ctes("trends", "select id, week_start, interest from trends"))
def src_cache_bucketed(spark, sf):
    path = scratch_path(spark, "cache")
    LD.write_bucketed_cache(I.trends(spark, sf), path, 16)
    return LD.read_bucketed_cache(spark, path, TRENDS).select("id", "week_start", "interest")


@query(
    "src_resume_anti",
    """select c_custkey as id, 'to load' as state from customer
where c_custkey not in (select o_custkey from orders)
union all
select c_custkey, 'landed' from customer where c_custkey in (select o_custkey from orders)""",
)
def src_resume_anti(spark, sf):
    wanted = I.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    done = I.table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    open_ids = LD.not_landed(wanted, done).withColumn("state", F.lit("to load"))
    return open_ids.unionByName(LD.landed(wanted, done).withColumn("state", F.lit("landed")))


@query("src_budget_limit", with_ctes("catalog", "select id, name, networks from catalog order by id limit 150"))
def src_budget_limit(spark, sf):
    return LD.load_budget(I.catalog(spark, sf).select("id", "name", "networks"), 150, ["id"])


@query(
    "src_load_report",
    """, cached as (select o_custkey as id, count(*) as n from orders where o_orderstatus = 'F' group by 1),
fetched as (select o_custkey as id, count(*) as n from orders where o_orderstatus = 'O' group by 1)
select count(*) as attempted, cast(count(c.n) as bigint) as used_cache,
       cast(count(case when c.n is null then f.n end) as bigint) as fetched,
       cast(count(case when c.n is null and f.n is null then 1 end) as bigint) as failed,
       cast(coalesce(sum(coalesce(c.n, f.n, 0)), 0) as bigint) as rows
from customer w left join cached c on c.id = w.c_custkey left join fetched f on f.id = w.c_custkey""".replace(
        ", cached", "with cached", 1
    ),
)
def src_load_report(spark, sf):
    wanted = I.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    rows = I.table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), "o_orderstatus")
    cached = rows.where(F.col("o_orderstatus") == "F")
    fetched = rows.where(F.col("o_orderstatus") == "O")
    return LD.load_report(wanted, cached, fetched)


@query("src_resume_stream", _NATION_SQL)
def src_resume_stream(spark, sf):
    """Two landings, three runs: the repeated run finds nothing new."""
    root = scratch_path(spark, "intake")
    landed, target, checkpoint = f"{root}/landed", f"{root}/target", f"{root}/checkpoint"
    series = _nation_series(spark, sf)
    early = F.col("week_start") < F.lit("1999-01-01").cast("date")
    for part in (early, ~early):
        series.where(part).write.mode("append").option("header", True).csv(landed)
        SL.take_new_files(spark, landed, TRENDS, target, checkpoint)
    SL.take_new_files(spark, landed, TRENDS, target, checkpoint)
    return SL.intake(spark, target)


@query(
    "publish_manifest_read",
    with_ctes(
        "feat",
        """select id, week_start, interest, round(roll_mean_4w, 6) as roll_mean_4w, 'second' as run_id,
        cast(2 as bigint) as generation, cast(8 as bigint) as n_features, true as third_refused from feat""",
    ),
)
def publish_manifest_read(spark, sf):
    root = scratch_path(spark, "published")
    panel = I.rounded(add_time_features(I.trends(spark, sf)), "roll_mean_4w")
    names = feature_columns(panel)
    for run in _RUNS:
        PB.publish(panel, names, root, {**run, "run_date": run["week_start"]})
    refused = False
    try:
        PB.publish(panel.limit(0), ["none"], root, {**_RUNS[0], "run_date": "2024-01-15"}, expected_generation=1)
    except ValueError:
        refused = True
    found = PB.resolve(spark, root)
    return found["panel_clean"].select(
        "id",
        "week_start",
        "interest",
        "roll_mean_4w",
        F.lit(found["manifest"]["run_id"]).alias("run_id"),
        F.lit(found["manifest"]["generation"]).cast("bigint").alias("generation"),
        F.lit(len(found["feature_columns"])).cast("bigint").alias("n_features"),
        F.lit(refused).alias("third_refused"),
    )
