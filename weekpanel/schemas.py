"""Explicit schemas of the tables the library reads and writes."""

from __future__ import annotations

DETAIL_DOC = """
id bigint, name string, original_name string, first_air_date string, last_air_date string,
status string, type string, in_production boolean, number_of_seasons int, number_of_episodes int,
episode_run_time array<int>, popularity double, vote_average double, vote_count bigint,
original_language string, genres array<struct<name:string>>, networks array<struct<name:string>>,
credits struct<cast:array<struct<name:string>>,crew:array<struct<name:string,job:string>>>,
keywords struct<results:array<struct<name:string>>>,
content_ratings struct<results:array<struct<iso_3166_1:string,rating:string>>>,
external_ids struct<imdb_id:string>
"""

LIST_PAGE = """
total_pages int,
results array<struct<id:bigint,name:string,original_name:string,first_air_date:string,
popularity:double,vote_average:double,vote_count:bigint,origin_country:array<string>,
original_language:string>>
"""

TRENDS = "id bigint, week_start date, interest double"

CACHE_ROW = "week_start date, interest double"

METRICS_HISTORY = """
family string, horizon int, rmse_train double, rmse_val double, r2_train double, r2_val double,
n_train bigint, n_val bigint, cutoff_week string, run_id string, run_date string,
week_start string, created_utc string, n_rows bigint, n_cols int, n_features int,
n_unique_weeks bigint, n_unique_shows bigint
"""

MANIFEST = """
generation bigint, token string, run_id string, run_date string, week_start string,
panel_clean_path string, feature_columns_path string, metrics_history_path string,
models struct<hgbr_dir:string,lgbm_dir:string>
"""

FEATURE_CONTRACT = "position int, name string"

VOCABULARY = "term string, idx int"
