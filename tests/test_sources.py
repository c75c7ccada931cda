from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from weekpanel import schemas, session
from weekpanel.operators import metrics as MH
from weekpanel.operators import model as M
from weekpanel.plans import serve as SV
from weekpanel.plans.refresh import refresh
from weekpanel.sources import documents as DOC
from weekpanel.sources import landing as LD
from weekpanel.sources import publish as PB
from weekpanel.sources import tables as ST
from weekpanel.streaming import landing as SL

DETAIL = {
    "id": 5, "name": "A", "genres": [{"name": "Drama"}, {"name": "War"}], "networks": [{"name": "N"}],
    "credits": {"cast": [{"name": "x"}, {"name": "y"}], "crew": [{"name": "d", "job": "Director"}, {"name": "w", "job": "Writer"}]},
    "keywords": {"results": [{"name": "k1"}, {"name": "k2"}]}, "episode_run_time": [40, 50],
    "content_ratings": {"results": [{"iso_3166_1": "DE", "rating": "12"}, {"iso_3166_1": "US", "rating": "TV-MA"}]},
    "external_ids": {"imdb_id": "tt1"}, "original_language": "en",
}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_detail_documents(spark, tmp_path):
    docs = {
        "5": json.dumps(DETAIL, indent=2),
        "6": json.dumps({"id": 6, "content_ratings": {"results": [{"iso_3166_1": "DE", "rating": "16"}]}, "episode_run_time": []}),
        "7": '{"id": 7, "name": ',
        "8": json.dumps({"name": "no id"}),
        "9": json.dumps({"id": 9, "networks": [{"logo": "x"}]}),
    }
    for name, text in docs.items():
        write(tmp_path / f"{name}.json", text)
    out = DOC.flatten_details(DOC.read_details(spark, str(tmp_path), multi_line=True)).orderBy("id").collect()
    assert [r["id"] for r in out] == [5, 6]
    assert len(out[0]) == 22
    full = out[0].asDict()
    assert (full["genres"], full["keywords"], full["certification"]) == ("Drama,War", "k1,k2", "TV-MA")
    assert (full["num_cast"], full["num_directors"], full["episode_run_time_mean"]) == (2, 1, 45.0)
    bare = out[1].asDict()
    assert (bare["genres"], bare["certification"], bare["num_cast"], bare["episode_run_time_mean"]) == ("", "16", 0, None)


def test_list_pages(spark, tmp_path):
    page = {"total_pages": 2, "results": [{"id": 1, "origin_country": ["US", "GB"]}, {"id": 2}]}
    write(tmp_path / "p.json", json.dumps(page) + "\n{broken\n")
    out = DOC.entity_list(DOC.read_list_pages(spark, str(tmp_path))).orderBy("id").collect()
    assert [(r["id"], r["origin_country"]) for r in out] == [(1, "US,GB"), (2, "")]


def test_cache_files_named_by_id(spark, tmp_path):
    write(tmp_path / "11.csv", "week_start,interest\n2024-01-01,5\n2024-01-08,7\nnonsense,1\n")
    write(tmp_path / "12.csv", "")
    write(tmp_path / "notes.csv", "week_start,interest\n2024-01-01,5\n")
    rows = LD.read_cache_files(spark, str(tmp_path)).orderBy("week_start").collect()
    assert [(r["id"], r["interest"]) for r in rows] == [(11, 5.0), (11, 7.0)]


def test_load_report(spark):
    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "id bigint")

    row = LD.load_report(ids(1, 2, 3, 4), ids(1, 1, 9), ids(1, 2, 2, 2)).first()
    assert row.asDict() == {"attempted": 4, "used_cache": 1, "fetched": 1, "failed": 2, "rows": 5}


def test_intake_takes_every_file_once(spark, tmp_path):
    landed, target, ckpt = (str(tmp_path / d) for d in ("landed", "target", "ckpt"))
    schema = "id bigint, v int"
    write(tmp_path / "landed" / "a.csv", "id,v\n1,10\n")
    SL.take_new_files(spark, landed, schema, target, ckpt)
    write(tmp_path / "landed" / "b.csv", "id,v\n2,20\n")
    for _ in range(2):
        SL.take_new_files(spark, landed, schema, target, ckpt)
    assert sorted(tuple(r) for r in SL.intake(spark, target).collect()) == [(1, 10), (2, 20)]


def test_runs_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run, n in (("a", 2), ("b", 3)):
        ST.write_run(spark.range(n), path, {"run_id": run, "week_start": "2024-01-01"})
    found = ST.read_run(spark, path, {"run_id": "b", "week_start": "2024-01-01"})
    assert found.count() == 3
    assert "PartitionFilters: [isnotnull(run_id" in found._jdf.queryExecution().executedPlan().toString()


def test_contract_must_not_be_empty(spark, tmp_path):
    path = str(tmp_path / "contract")
    ST.write_contract(spark, ["b", "a"], path)
    assert ST.read_contract(spark, path) == ["b", "a"]
    empty = str(tmp_path / "empty")
    ST.write_contract(spark, [], empty)
    with pytest.raises(ValueError, match="empty"):
        ST.read_contract(spark, empty)


RUN = {"run_id": "r", "run_date": "2024-01-03", "week_start": "2024-01-01"}


def test_publish_refuses_a_stale_generation(spark, tmp_path):
    root = str(tmp_path / "pub")
    with pytest.raises(FileNotFoundError):
        PB.resolve(spark, root)
    assert PB.publish(spark.range(1), ["x"], root, RUN, expected_generation=0) == 1
    assert PB.publish(spark.range(2), ["x", "y"], root, RUN) == 2
    with pytest.raises(ValueError, match="stale"):
        PB.publish(spark.range(3), ["x"], root, RUN, expected_generation=1)
    found = PB.resolve(spark, root)
    assert found["panel_clean"].count() == 2 and found["feature_columns"] == ["x", "y"]
    assert found["metrics_history"].isEmpty()
    assert set(schemas.METRICS_HISTORY.replace("\n", " ").split()) >= set(found["metrics_history"].columns)


def test_metrics_append(spark):
    schema = "run_id string, family string, horizon int, created_utc string, rmse_val double"
    old = spark.createDataFrame([("r", "f", 1, "t", 1.0), ("r", "f", 2, "t", 2.0)], schema)
    new = spark.createDataFrame([("r", "f", 2, "t", 9.0, "n")], schema + ", note string")
    merged = MH.append_dedupe(old, new)
    assert sorted((r["horizon"], r["rmse_val"], r["note"]) for r in merged.collect()) == [(1, 1.0, None), (2, 9.0, "n")]
    assert MH.append_dedupe(merged, new).count() == 2
    assert MH.append_dedupe(None, new).count() == 1
    assert MH.append_plain(old.withColumn("ts", F.lit("x")), new).where("ts is null").count() == 0


def test_shared_folder_follows_the_session(spark):
    assert session.shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("refresh"))
    trends = spark.range(30 * 40).selectExpr(
        "id % 30 as id",
        "date_add(date'2023-01-02', cast(7 * (id div 30) as int)) as week_start",
        "cast(pmod(id % 30 * 3 + id div 30 * 2, 101) as double) as interest",
    )
    catalog = spark.range(30).selectExpr(
        "id", "concat('show ', id) as name", "concat('show ', id) as original_name",
        "date'2020-01-01' as first_air_date", "date'2023-05-01' as last_air_date",
        "case when id % 5 = 0 then null else concat('S', id % 3) end as status", "'Scripted' as type", "'en' as language",
        "case when id % 4 = 0 then null else concat('C', id % 2) end as certification",
        "concat('Drama, G', id % 4) as genres", "concat('Net', id % 3) as networks", "concat('dark word', id % 6) as keywords",
        "cast(id as double) as popularity", "5.0D as vote_average",
        "case when id % 6 = 0 then null else cast(id % 3 * 10 as double) end as episode_run_time_mean",
    )
    quick = {f: {"maxIter": 2, "maxDepth": 3} for f in M.FAMILIES}
    out = refresh(spark, trends, catalog, root, RUN, horizons=[1, 2], settings=quick)
    again = refresh(spark, trends, catalog, root, {**RUN, "run_id": "r2"}, horizons=[1, 2], settings=quick)
    return root, out, again


def test_refresh_end_to_end(spark, refreshed):
    root, out, again = refreshed
    assert (out["generation"], again["generation"]) == (1, 2)
    found = PB.resolve(spark, root)
    assert found["feature_columns"] == again["features"].names()
    assert found["panel_clean"].count() == 1200
    history = found["metrics_history"]
    assert history.count() == 8
    assert set(schemas.METRICS_HISTORY.replace("\n", " ").split()) >= set(history.columns)
    assert history.agg(F.min("n_train"), F.max("n_train")).first() == (32 * 30, 32 * 30)
    assert MH.family_counts(history).where("n <> 2").isEmpty()
    models = M.load_models(spark, found["manifest"]["models"]["lgbm_dir"])
    assert sorted(models) == [1, 2]
    with pytest.raises(FileNotFoundError):
        M.load_models(spark, f"{root}/nowhere")


def test_contributions_add_up(spark, refreshed):
    _, out, _ = refreshed
    model = M.load_models(spark, out["folders"]["hgbr_dir"], [1])[1]
    vectors = M.with_vector(out["panel_clean"], out["features"], ["id", "week_start"], out["codes"])
    last = vectors.where("week_start = (date'2023-01-02' + 7 * 39)")
    names = out["features"].names()
    shares = M.local_contributions(last, model, names, n=None)
    sums = shares.groupBy("id").agg((F.first("bias") + F.sum("contribution")).alias("sum"), F.count("*").alias("n"))
    scored = M.add_predictions(last, {1: model}).join(sums, "id")
    rows = scored.select("id", "`raw_t+1`", "sum", "n").collect()
    assert len(rows) == 30
    assert all(r["n"] == len(names) and r["sum"] == pytest.approx(r["raw_t+1"]) for r in rows)
    top = M.local_contributions(last, model, names)
    assert top.groupBy("id").count().where(f"count <> {min(12, len(names))}").isEmpty()
    important = M.feature_importance(spark, model, names).collect()
    assert important[0]["importance"] > 0 and len(important) == min(20, len(names))


def test_forecast_is_clipped_and_complete(spark, refreshed):
    _, out, _ = refreshed
    models = M.load_models(spark, out["folders"]["lgbm_dir"])
    last = out["panel_clean"].where("week_start = (date'2023-01-02' + 7 * 39)")
    vectors = M.with_vector(last, out["features"], ["id", "week_start"], out["codes"])
    rows = M.forecast_all(vectors, models).collect()
    assert len(rows) == 60 and all(0 <= r["forecast"] <= 100 for r in rows)
    assert {(r["week_start"] - rows[0]["week_start"]).days % 7 for r in rows} == {0}


def test_serving_reads_what_was_published(spark, refreshed):
    root, _, again = refreshed
    serving = SV.load(spark, root)
    assert serving.features == again["features"]
    history, forecast = SV.entity_forecast(serving, 3, max_horizon=1)
    assert history.count() == 40
    assert [str(r["week_start"]) for r in forecast.collect()] == ["2023-10-09"]
    with pytest.raises(ValueError, match="99"):
        SV.entity_forecast(serving, 99)
    moved = SV.trending(serving).collect()
    assert [r["delta_t+1"] for r in moved] == sorted((r["delta_t+1"] for r in moved), reverse=True)
    ranked = SV.overview(serving).orderBy("rank_popularity").collect()
    assert [r["popularity"] for r in ranked] == sorted((r["popularity"] for r in ranked), reverse=True)
    important, local = SV.explain(serving, 3)
    assert important.count() > 0 and {r["id"] for r in local.collect()} == {3}


def test_validation_guards(refreshed):
    _, out, _ = refreshed
    clean, spec = out["panel_clean"], out["features"]
    with pytest.raises(ValueError, match="exactly one"):
        M.validate(clean, spec)
    with pytest.raises(ValueError, match="missing"):
        M.validate(clean.drop("interest"), spec, folder=out["folders"]["hgbr_dir"])
    report = M.validate(clean, spec, codes=out["codes"], folder=out["folders"]["hgbr_dir"])
    assert [r["n_rows"] for r in M.require_valid(report)] == [1200, 1200]
    with pytest.raises(ValueError, match="unusable"):
        M.require_valid(report.withColumn("n_bad", F.lit(1)))
