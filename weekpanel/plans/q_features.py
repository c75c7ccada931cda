"""Queries on entity features, text, codes and the feature contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekpanel.functions.text import tokens
from weekpanel.operators import display as DS
from weekpanel.operators import encoding as E
from weekpanel.operators import features as X
from weekpanel.operators import insights as K
from weekpanel.operators import panel as P
from weekpanel.operators import tfidf as T
from weekpanel.operators.assemble import GENRES, NETWORKS
from weekpanel.plans import inputs as I
from weekpanel.plans.refresh import clean_entities, clean_panel, refresh
from weekpanel.plans.registry import query
from weekpanel.plans.sql import WORD, with_ctes
from weekpanel.session import scratch_path
from weekpanel.sources import tables as ST


@query(
    "freshness",
    with_ctes(
        "trends catalog",
        """select t.id, t.week_start, cast(t.week_start - c.last_air_date as int) as freshness_raw,
        cast(case when t.week_start < c.last_air_date then 0 else t.week_start - c.last_air_date end as int) as freshness_days,
        cast(coalesce(t.week_start < c.last_air_date, false) as int) as freshness_future_flag
        from trends t join catalog c on c.id = t.id""",
    ),
)
def freshness(spark, sf):
    rows = I.trends(spark, sf).join(I.catalog(spark, sf).select("id", "last_air_date"), "id")
    return X.freshness(rows).select("id", "week_start", "freshness_raw", "freshness_days", "freshness_future_flag")


@query(
    "impute_mode",
    with_ctes(
        "ents cert_mode",
        "select id, coalesce(certification, (select certification from cert_mode)) as certification from ents",
    ),
)
def impute_mode(spark, sf):
    return X.impute_mode(I.entities(spark, sf)).select("id", "certification")


@query(
    "impute_group_median",
    with_ctes(
        "group_filled overall_median",
        "select id, round(coalesce(run_time, (select med from overall_median)), 6) as episode_run_time_mean from group_filled",
    ),
)
def impute_group_median(spark, sf):
    filled = X.impute_group_median(I.entities(spark, sf)).select("id", "episode_run_time_mean")
    return I.rounded(filled, "episode_run_time_mean")


@query("top_genres", with_ctes("top_genres", "select token, n from top_genres"))
def top_genres(spark, sf):
    return X.top_tokens(I.entities(spark, sf), "genres", I.N_GENRES)


@query("top_networks", with_ctes("top_networks", "select token, n from top_networks"))
def top_networks(spark, sf):
    return X.top_tokens(I.entities(spark, sf), "networks", I.N_NETWORKS)


def _multihot(spark, sf, column, n, prefix):
    entities = I.entities(spark, sf)
    names = X.names_of(X.top_tokens(entities, column, n))
    return X.multihot_pairs(X.keep_tokens(entities, column, names, "kept"), "kept", prefix)


def _multihot_sql(column: str, prefix: str) -> str:
    return with_ctes(
        f"{column}_items top_{column}s",
        f"""select distinct id, concat('{prefix}', token) as feature, 1 as value from {column}_items
        where token in (select token from top_{column}s)""",
    )


@query("multihot_genres", _multihot_sql("genre", "genre__"))
def multihot_genres(spark, sf):
    return _multihot(spark, sf, "genres", I.N_GENRES, "genre__")


@query("multihot_networks", _multihot_sql("network", "net__"))
def multihot_networks(spark, sf):
    return _multihot(spark, sf, "networks", I.N_NETWORKS, "net__")


@query(
    "tfidf_tokens",
    f"""select doc_id, cast(len(t) as int) as n_tokens, array_to_string(t, ' ') as tokens
from (select doc_id, regexp_extract_all(lower(text), '{WORD}') as t from documents)""",
)
def tfidf_tokens(spark, sf):
    words = I.table(spark, sf, "documents").select("doc_id", tokens("text").alias("t"))
    return words.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query(
    "tfidf_idf",
    with_ctes(
        "kw_idf",
        """select term, cast(idx as int) as idx, cast(n as bigint) as n, cast(df as bigint) as df,
        round(idf, 6) as idf from kw_idf""",
    ),
)
def tfidf_idf(spark, sf):
    fitted = T.fit(I.entities(spark, sf), "keywords", I.N_TERMS, "n_weeks")
    return I.rounded(fitted.frame(spark), "idf")


@query("tfidf_scores", with_ctes("kw_scores", "select id, term, round(score, 6) as score from kw_scores"))
def tfidf_scores(spark, sf):
    scored, fitted = T.tfidf(I.entities(spark, sf), "keywords", I.N_TERMS, "n_weeks")
    return I.rounded(T.scores_long(scored, fitted), "score")


@query(
    "tfidf_fixed_vocab",
    with_ctes(
        "kw_counts",
        rf""", vtf as (
  select id, term, count(*) as tf
  from (select id, unnest(regexp_extract_all(lower(concat(keywords, ' ', original_name)), '{WORD}')) as term from catalog)
  group by id, term),
vocab as (
  select term, row_number() over (order by term) - 1 as idx
  from (select term from vtf group by term order by sum(tf) desc, term limit 30))
select v.term, cast(v.idx as int) as idx, cast(coalesce(c.n, 0) as bigint) as n, cast(coalesce(c.df, 0) as bigint) as df,
       round(ln((1 + (select sum(n_weeks) from ents)) / (1 + coalesce(c.df, 0))) + 1, 6) as idf
from vocab v left join kw_counts c on c.term = v.term""",
    ),
)
def tfidf_fixed_vocab(spark, sf):
    text = F.concat("keywords", F.lit(" "), "original_name")
    first = T.fit(I.catalog(spark, sf).select(text.alias("text")), "text", 30)
    path = scratch_path(spark, "vocabulary")
    ST.write_vocabulary(first.frame(spark), path)
    fixed = ST.read_vocabulary(spark, path)
    again = T.fit(I.entities(spark, sf), "keywords", I.N_TERMS, "n_weeks", fixed)
    return I.rounded(again.frame(spark), "idf")


@query(
    "tfidf_documents",
    with_ctes(
        "doc_tf doc_vocab",
        """, raw as (
  select t.doc_id, t.term, t.tf * (ln((1 + (select count(*) from documents)) / (1 + v.df)) + 1) as raw
  from doc_tf t join doc_vocab v on v.term = t.term)
select doc_id, term, round(raw / sqrt(sum(raw * raw) over (partition by doc_id)), 6) as score from raw""",
    ),
)
def tfidf_documents(spark, sf):
    docs = I.table(spark, sf, "documents").select("doc_id", "text")
    scored, fitted = T.tfidf(docs, "text", X.TOP_TERMS)
    return I.rounded(T.scores_long(scored, fitted, "doc_id"), "score")


_LIFT = """, totals as (select sum(n) as n, sum(known) as known, sum(total) as total from sums),
present as (
  select k.term, sum(n) as n, sum(known) as known, sum(total) as total
  from kw k join sums s on s.id = k.id group by k.term),
lift as (
  select concat('kw__', p.term) as keyword, 100.0 * p.n / t.n as coverage, p.total / nullif(p.known, 0) as m1,
         (t.total - coalesce(p.total, 0)) / nullif(t.known - p.known, 0) as m0, t.total / t.known as m, p.term
  from present p, totals t where p.n >= 0.01 * t.n)
"""
_LIFT_COLUMNS = """select keyword, round(coverage, 6) as "coverage_%", round(m1, 6) as mean_interest_present,
  round(m0, 6) as mean_interest_absent, round(m1 - m0, 6) as lift_present_minus_absent,
  round(m1 - m, 6) as lift_vs_global_mean, concat(upper(left(trim(replace(term, '_', ' ')), 1)),
  substr(trim(replace(term, '_', ' ')), 2)) as keyword_readable
from lift order by m1 - m0 desc nulls last, keyword limit 12"""
_PANEL_SUMS = """, sums as (
  select id, count(*) as n, count(interest) as known, sum(interest) as total from trends group by id),
kw as (select id, term from kw_scores where score > 0)"""
_LIFT_NUMBERS = (
    "coverage_%", "mean_interest_present", "mean_interest_absent", "lift_present_minus_absent", "lift_vs_global_mean",
)


def _panel_insights(spark, sf):
    scored, fitted = T.tfidf(I.entities(spark, sf), "keywords", I.N_TERMS, "n_weeks")
    present = T.scores_long(scored, fitted).select("id", "term")
    return K.keyword_insights(K.entity_sums(I.trends(spark, sf)), present)


@query("keyword_lift", with_ctes("kw_scores trends", _PANEL_SUMS + _LIFT + _LIFT_COLUMNS))
def keyword_lift(spark, sf):
    return I.rounded(K.keyword_lift(_panel_insights(spark, sf)), *_LIFT_NUMBERS)


_COVERAGE_COLUMNS = """select keyword, concat(upper(left(term, 1)), substr(term, 2)) as keyword_readable,
  round(coverage, 6) as "coverage_%", round(m1, 6) as mean_interest_present
from lift order by coverage desc, m1 desc nulls last, keyword limit 12"""


@query("keyword_coverage", with_ctes("kw_scores trends", _PANEL_SUMS + _LIFT + _COVERAGE_COLUMNS))
def keyword_coverage(spark, sf):
    return I.rounded(K.keyword_coverage(_panel_insights(spark, sf)), "coverage_%", "mean_interest_present")


_SHARE_COLUMNS = """select keyword, concat(upper(left(term, 1)), substr(term, 2)) as keyword_readable,
  round(coverage, 6) as "coverage_%", round(m1, 6) as mean_interest_present,
  round(coverage / sum(coverage) over (), 6) as coverage_share
from (select * from lift where m1 is not null order by coverage desc, m1 desc, keyword limit 6)"""


@query("keyword_share", with_ctes("kw_scores trends", _PANEL_SUMS + _LIFT + _SHARE_COLUMNS))
def keyword_share(spark, sf):
    top = K.keyword_share(_panel_insights(spark, sf))
    return I.rounded(top, "coverage_%", "mean_interest_present", "coverage_share")


@query(
    "keyword_display",
    with_ctes(
        "kw_scores trends",
        _PANEL_SUMS
        + _LIFT
        + """select concat(upper(left(term, 1)), substr(term, 2)) as "Keyword", printf('%.1f', coverage) as "Coverage (%)",
  coalesce(printf('%.2f', m1), '—') as "Mean interest (keyword present)",
  coalesce(printf('%.2f', m0), '—') as "Mean interest (keyword absent)",
  coalesce(printf('%+.2f', m1 - m0), '—') as "Lift (present − absent)"
from lift order by m1 - m0 desc nulls last, keyword limit 12""",
    ),
)
def keyword_display(spark, sf):
    return DS.formatted(K.keyword_lift(_panel_insights(spark, sf)), DS.KEYWORD_LIFT)


_DOC_SUMS = """, sums as (
  select doc_id as id, count(*) as n, count(quality) as known, cast(sum(quality) as double) as total
  from labels group by doc_id),
kw as (select t.doc_id as id, t.term from doc_tf t join doc_vocab v on v.term = t.term)"""


@query("keyword_lift_documents", with_ctes("doc_tf doc_vocab", _DOC_SUMS + _LIFT + _LIFT_COLUMNS))
def keyword_lift_documents(spark, sf):
    docs = I.table(spark, sf, "documents").select("doc_id", "text")
    scored, fitted = T.tfidf(docs, "text", X.TOP_TERMS)
    present = T.scores_long(scored, fitted, "doc_id").select("doc_id", "term")
    sums = K.entity_sums(I.table(spark, sf, "labels"), "doc_id", "quality")
    found = K.keyword_insights(sums.withColumn("total", F.col("total").cast("double")), present, "doc_id")
    return I.rounded(K.keyword_lift(found), *_LIFT_NUMBERS)


def _codes_sql(missing: str) -> str:
    columns = ("status", "type", "language", "certification")
    ranks = ", ".join(
        f"case when {c} is null then null else dense_rank() over (order by {c} nulls last) - 1 end as {c}_code, "
        f"(select count(distinct {c}) from catalog) as {c}_n"
        for c in columns
    )
    out = ", ".join(f"cast(coalesce({c}_code, {missing.format(c=c)}) as int) as {c}" for c in columns)
    return with_ctes("catalog", f"select id, {out} from (select *, {ranks} from catalog)")


@query("encode_train", _codes_sql("{c}_n"))
def encode_train(spark, sf):
    cat = I.catalog(spark, sf).select("id", *E.CATEGORY_COLUMNS)
    return E.encode_train(cat, E.category_codes(cat))


@query("encode_serve", _codes_sql("-1"))
def encode_serve(spark, sf):
    cat = I.catalog(spark, sf).select("id", *E.CATEGORY_COLUMNS)
    return E.encode_serve(cat, E.category_codes(cat))


_MATRIX = ("status", "type", "in_production", "number_of_seasons", "episode_run_time_mean", "vote_average")


@query(
    "encode_matrix",
    with_ctes(
        "catalog",
        """select id, cast(coalesce(case when status is not null then s - 1 end, sn) as double) as status,
        cast(t - 1 as double) as type, cast(in_production as double) as in_production,
        cast(number_of_seasons as double) as number_of_seasons, coalesce(episode_run_time_mean, -1) as episode_run_time_mean,
        coalesce(vote_average, -1) as vote_average
from (select *, dense_rank() over (order by status nulls last) as s, dense_rank() over (order by type) as t,
             (select count(distinct status) from catalog) as sn from catalog)""",
    ),
)
def encode_matrix(spark, sf):
    return E.encode_matrix(I.catalog(spark, sf).select("id", *_MATRIX), _MATRIX)


@query(
    "contract_projection",
    with_ctes(
        "catalog",
        """select id, coalesce(vote_average, 0) as vote_average, cast(0 as double) as no_such_feature,
        coalesce(try_cast(certification as double), 0) as certification, cast(in_production as double) as in_production,
        coalesce(episode_run_time_mean, 0) as episode_run_time_mean from catalog""",
    ),
)
def contract_projection(spark, sf):
    names = ["vote_average", "no_such_feature", "certification", "in_production", "episode_run_time_mean"]
    return E.contract_projection(I.catalog(spark, sf), names)


_CONTRACT = (
    "interest", "lag_interest_1w", "lag_interest_2w", "lag_interest_4w", "lag_interest_8w", "delta_interest_1w",
    "roll_mean_4w", "roll_std_4w", "in_production", "number_of_seasons", "episode_run_time_mean", "popularity",
    "vote_average", "vote_count",
)


@query(
    "contract_columns",
    with_ctes(
        "panel",
        " union all ".join(
            f"select {i} as position, '{c}' as name, count({c}) as n_present from panel"
            for i, c in enumerate(_CONTRACT)
        ),
    ),
)
def contract_columns(spark, sf):
    panel = I.panel(spark, sf)
    path = scratch_path(spark, "contract")
    ST.write_contract(spark, E.feature_columns(panel), path)
    names = ST.read_contract(spark, path)
    counts = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(n).alias("name"), F.count(f"`{n}`").alias("n_present"))
            for i, n in enumerate(names)
        ]
    )
    return panel.agg(counts.alias("_c")).select(F.explode("_c").alias("_c")).select("_c.*")


_CLEAN_SQL =     with_ctes(
        "feat ents cert_mode group_filled overall_median genre_items top_genres network_items top_networks kw_scores",
        """, kept_genres as (
  select id, string_agg(token, ',' order by token) as kept
  from (select distinct id, token from genre_items where token in (select token from top_genres)) group by id),
kept_networks as (
  select id, string_agg(token, ',' order by token) as kept
  from (select distinct id, token from network_items where token in (select token from top_networks)) group by id),
kept_terms as (select id, string_agg(term, ',' order by term) as terms from kw_scores group by id)
select f.id, f.week_start, f.interest, round(f.roll_std_4w, 6) as roll_std_4w,
       coalesce(e.certification, (select certification from cert_mode)) as certification,
       round(coalesce(g.run_time, (select med from overall_median)), 6) as episode_run_time_mean,
       cast(case when f.week_start < e.last_air_date then 0 else f.week_start - e.last_air_date end as int) as freshness_days,
       coalesce(kg.kept, '') as genres_kept, coalesce(kn.kept, '') as networks_kept, coalesce(kt.terms, '') as terms
from feat f join ents e on e.id = f.id join group_filled g on g.id = f.id
left join kept_genres kg on kg.id = f.id left join kept_networks kn on kn.id = f.id
left join kept_terms kt on kt.id = f.id""",
    )


@query("panel_clean_narrow", _CLEAN_SQL)
def panel_clean_narrow(spark, sf):
    # Same rows as the panel, which the entity join would give its metadata a second time.
    series = P.add_time_features(P.clean_trends(I.trends(spark, sf), collapse=False))
    entities, _, fitted = clean_entities(
        I.trends(spark, sf), I.catalog(spark, sf),
        n_genres=I.N_GENRES, n_networks=I.N_NETWORKS, n_terms=I.N_TERMS,
    )
    # An entity's lists are the same in all its weeks, so they become text before the join.
    return _clean_columns(clean_panel(series, _listed(entities, fitted)))


@query("refresh_clean", _CLEAN_SQL)
def refresh_clean(spark, sf):
    """The whole refresh up to the clean panel, which a run without training publishes nothing from."""
    run = {"run_id": "r1", "run_date": "2024-01-03", "week_start": "2024-01-01"}
    root = scratch_path(spark, "refresh")
    out = refresh(spark, I.trends(spark, sf), I.catalog(spark, sf), root, run, retrain=False)
    return _clean_columns(_listed(out["panel_clean"], out["terms"]))


def _listed(rows, fitted):
    """The kept lists and the terms as text."""
    texts = {c: F.array_join(c, ",") for c in (GENRES, NETWORKS)}
    return rows.withColumns({**texts, "terms": F.array_join(T.present_terms(fitted), ",")})


def _clean_columns(clean):
    return clean.select(
        "id",
        "week_start",
        "interest",
        F.round("roll_std_4w", 6).alias("roll_std_4w"),
        "certification",
        F.round("episode_run_time_mean", 6).alias("episode_run_time_mean"),
        "freshness_days",
        GENRES,
        NETWORKS,
        "terms",
    )
