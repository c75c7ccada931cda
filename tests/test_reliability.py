"""Writes that are repeated, publishers that meet, documents and values that are unusable."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weekpanel.functions.casts import clip
from weekpanel.operators import latest as L
from weekpanel.operators.dedupe import keep_first, keep_last
from weekpanel.operators.panel import weekly_series
from weekpanel.sources import documents as DOC
from weekpanel.sources import landing as LD
from weekpanel.sources import publish as PB
from weekpanel.sources import tables as ST

RUN = {"run_id": "007", "run_date": "2024-01-03", "week_start": "2024-01-01"}
WEEKS = "id bigint, week_start date, interest double"


def _weeks(spark, *rows):
    return spark.createDataFrame([(i, w, v) for i, w, v in rows], "id bigint, week_start string, interest double").withColumn(
        "week_start", F.col("week_start").cast("date")
    )


def test_run_ids_are_names_and_a_retry_replaces(spark, tmp_path):
    path = str(tmp_path / "runs")
    for _ in range(2):
        ST.write_run(spark.range(3), path, RUN)
    ST.write_run(spark.range(5), path, {**RUN, "run_id": "8"})
    assert ST.read_run(spark, path, RUN).count() == 3
    assert ST.read_run(spark, path, {**RUN, "run_id": "7"}).count() == 0
    assert ST.read_run(spark, path, {**RUN, "run_id": "8"}).count() == 5


@pytest.mark.parametrize("bucketed", [False, True])
def test_a_second_landing_replaces_the_first(spark, tmp_path, bucketed):
    path = str(tmp_path / "cache")

    def write(df):
        LD.write_bucketed_cache(df, path, 2) if bucketed else LD.write_entity_cache(df, path)

    write(_weeks(spark, (1, "2024-01-01", 5.0), (2, "2024-01-01", 6.0), (3, "2024-01-01", 7.0)))
    write(_weeks(spark, (1, "2024-01-01", 8.0), (1, "2024-01-08", 9.0)))
    read = LD.read_bucketed_cache(spark, path, WEEKS) if bucketed else LD.read_entity_cache(spark, path)
    rows = sorted((r["id"], str(r["week_start"]), r["interest"]) for r in read.collect())
    assert rows == [(1, "2024-01-01", 8.0), (1, "2024-01-08", 9.0), (2, "2024-01-01", 6.0), (3, "2024-01-01", 7.0)]


def test_a_bad_value_keeps_its_week_whatever_is_selected(spark, tmp_path):
    (tmp_path / "5.csv").write_text("week_start,interest\n2024-01-01,3\n2024-01-08,oops\n,4\n2024-01-15,5\n")
    rows = LD.read_cache_files(spark, str(tmp_path))
    assert rows.count() == rows.select("week_start").count() == len(rows.collect()) == 3
    assert LD.unusable(rows) == 1 and LD.usable_series(rows).count() == 2


def test_malformed_documents_are_dropped_alike(spark, tmp_path):
    lines = ['{"id": 1, "name": "a"}', '{"id": 2, "name": ', '{"id": "x", "name": "b"}', '{"id": 3}', ""]
    (tmp_path / "d.json").write_text("\n".join(lines))
    schema = "id bigint, name string"
    docs = DOC.read_documents(spark, str(tmp_path), schema)
    assert docs.count() == docs.select("name").count() == len(docs.collect()) == 2
    assert DOC.malformed(spark, str(tmp_path), schema) == 2


def test_a_load_that_gains_nothing_is_an_error(spark):
    wanted, none = spark.range(3), spark.createDataFrame([], "id bigint")
    with pytest.raises(ValueError, match="produced nothing"):
        LD.require_loaded(LD.load_report(wanted, none, none))
    LD.require_loaded(LD.load_report(wanted, none, spark.range(1)))
    LD.require_loaded(LD.load_report(none, none, none))


def test_of_two_publishers_one_wins_and_the_other_leaves_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "published")
    inner = PB._create_exclusively

    def meanwhile(*args):
        monkeypatch.setattr(PB, "_create_exclusively", inner)
        PB.publish(spark.range(2), ["y"], root, {**RUN, "run_id": "fast"})
        return inner(*args)

    monkeypatch.setattr(PB, "_create_exclusively", meanwhile)
    with pytest.raises(ValueError, match="meanwhile"):
        PB.publish(spark.range(1), ["x"], root, RUN)
    found = PB.resolve(spark, root)
    assert found["manifest"]["run_id"] == "fast" and found["feature_columns"] == ["y"]
    assert PB.current_generation(spark, root) == 1
    assert len([p for p in (tmp_path / "published/manifest").iterdir() if not p.name.endswith(".crc")]) == 1


def test_of_many_creators_of_one_file_one_wins(spark, tmp_path):
    from multiprocessing.pool import ThreadPool

    with ThreadPool(8) as pool:
        won = pool.map(lambda k: PB._create_exclusively(spark, str(tmp_path), 7, str(k)), range(24))
    assert sum(won) == 1
    assert (tmp_path / "manifest/generation-0000000007.json").read_text() == str(won.index(True))


class _ObjectStore:
    """A store whose rename replaces and is no single step; its create without overwrite is one."""

    def __init__(self, inner):
        self.inner, self.renames = inner, 0

    def getScheme(self):
        return "store"

    def rename(self, *_):
        self.renames += 1
        raise AssertionError("publication must not depend on a rename")

    def __getattr__(self, name):
        return getattr(self.inner, name)


def test_publication_does_without_a_rename(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "published")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = _ObjectStore(path.getFileSystem(spark._jsc.hadoopConfiguration()))

    def racing(generation, text):
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest/generation-{generation:010d}.json")
        return PB._put_new(spark, store, target, text)

    store.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest"))
    assert racing(1, "first") and not racing(1, "second")
    assert (tmp_path / "published/manifest/generation-0000000001.json").read_text() == "first" and store.renames == 0


def test_an_unfinished_manifest_is_passed_over_and_discarded(spark, tmp_path):
    root = str(tmp_path / "published")
    assert PB.publish(spark.range(1), ["x"], root, RUN) == 1
    broken = tmp_path / "published/manifest/generation-0000000002.json"
    broken.write_text('{"generation": 2, "token": "ab')
    assert PB.current_generation(spark, root) == 1 and PB.resolve(spark, root)["manifest"]["generation"] == 1
    with pytest.raises(ValueError, match="meanwhile"):
        PB.publish(spark.range(2), ["y"], root, RUN)
    assert PB.discard_unfinished(spark, root) == []
    assert PB.discard_unfinished(spark, root, 0) == ["generation-0000000002.json"]
    assert PB.publish(spark.range(2), ["y"], root, RUN) == 2 and PB.discard_unfinished(spark, root, 0) == []


def _records(spark, *rows):
    kind = "family string, run_id string, horizon int, created_utc string, rmse_val double"
    return spark.createDataFrame(list(rows), kind)


def test_metrics_are_added_and_only_published_ones_are_seen(spark, tmp_path):
    root = str(tmp_path / "published")

    def publish(run_id, *rows, **more):
        return PB.publish(spark.range(1), ["x"], root, {**RUN, "run_id": run_id}, new_metrics=_records(spark, *rows), **more)

    def seen():
        rows = PB.resolve(spark, root)["metrics_history"]
        return sorted((r["family"], r["run_id"], r["horizon"], r["rmse_val"]) for r in rows.collect())

    publish("007", ("lgbm", "007", 1, "t", 1.0), ("hgbr", "007", 1, "t", 2.0))
    files = {p for p in (tmp_path / "published/data/metrics_log").rglob("*.parquet")}
    # Two start from the same generation: the second is refused, and its records are never seen.
    with pytest.raises(ValueError, match="stale"):
        publish("9", ("lgbm", "9", 1, "t", 3.0), expected_generation=0)
    publish("8", ("lgbm", "8", 1, "t", 4.0))
    assert files < {p for p in (tmp_path / "published/data/metrics_log").rglob("*.parquet")}
    assert seen() == [("hgbr", "007", 1, 2.0), ("lgbm", "007", 1, 1.0), ("lgbm", "8", 1, 4.0)]
    publish("007", ("lgbm", "007", 1, "t", 0.5))
    assert seen() == [("hgbr", "007", 1, 2.0), ("lgbm", "007", 1, 0.5), ("lgbm", "8", 1, 4.0)]



def test_small_semantics(spark):
    one = spark.range(1)
    assert one.select(clip(F.lit(float("nan")), 0, 100)).first()[0] is None
    raw = spark.createDataFrame([(1, "2024-01-01", 0.0), (1, "2024-01-08", 0.0), (2, "2024-01-01", 4.0)], "e int, d string, v double")
    rows = {(r["id"], r["interest"]) for r in weekly_series(raw.withColumn("d", F.col("d").cast("date")), "e", "d", "v").collect()}
    assert rows == {(1, 0.0), (2, 100.0)}
    repeated = spark.createDataFrame([(1, None, "a"), (1, 2, "z"), (1, 3, "b")], "id int, seen int, name string")
    assert keep_first(repeated, ["id"], ["seen"]).first()["name"] == "z"
    assert keep_last(repeated, ["id"], ["seen"]).first()["name"] == "b"
    with pytest.raises(ValueError, match="not 6"):
        L.compare_entities(repeated, repeated, repeated, range(6))
