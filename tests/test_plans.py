"""The physical plans that the design relies on."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from weekpanel.operators import insights as K
from weekpanel.operators import latest as L
from weekpanel.operators import panel as P
from weekpanel.operators import ranking as R
from weekpanel.operators import split as SP
from weekpanel.plans import inputs as I
from weekpanel.sources import tables as ST


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans"))
    ST.write_parquet(I.trends(spark, sf_dir), f"{path}/trends")
    ST.write_parquet(I.panel(spark, sf_dir), f"{path}/panel")
    return path


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_all_window_features_and_targets_share_one_shuffle_and_sort(spark, stored):
    featured = P.add_targets(P.add_time_features(ST.read_parquet(spark, f"{stored}/trends")))
    text = plan(featured)
    assert text.count("Exchange") == 1 and "hashpartitioning(id" in text
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_panel_is_not_moved_for_a_large_catalog(spark, sf_dir, stored, no_broadcast):
    trends = ST.read_parquet(spark, f"{stored}/trends")
    catalog = spark.range(50).withColumn("name", F.lit("x"))
    text = plan(P.build_panel(trends, catalog, collapse=False))
    assert "SortMergeJoin" in text
    # One exchange for the series, one for the catalog.
    assert text.count("Exchange hashpartitioning") == 2


def test_small_catalog_is_broadcast_by_size(spark, stored):
    trends = ST.read_parquet(spark, f"{stored}/trends")
    text = plan(P.build_panel(trends, spark.range(50).withColumn("name", F.lit("x"))))
    assert "BroadcastHashJoin" in text


def test_entity_filter_and_columns_reach_the_scan(spark, stored):
    panel = ST.read_parquet(spark, f"{stored}/panel")
    text = plan(L.entity_history(panel, 1).select("id", "interest"))
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,1)]" in text
    assert "ReadSchema: struct<id:bigint,interest:double>" in text


def test_latest_aggregates_before_the_shuffle(spark, stored):
    text = plan(L.latest_per_entity(ST.read_parquet(spark, f"{stored}/panel").select("id", "week_start", "interest")))
    assert "partial_max" in text and text.count("Exchange") == 1


def test_top_lists_are_top_k(spark, stored):
    text = plan(L.catalog_top(ST.read_parquet(spark, f"{stored}/panel")).select("id"))
    assert "TakeOrderedAndProject" in text


def test_recent_change_limits_rows_before_the_shuffle(spark, stored):
    text = plan(L.recent_change(ST.read_parquet(spark, f"{stored}/trends")))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.count("Exchange") == 1


def test_missingness_is_one_aggregate(spark, stored):
    text = plan(K.missingness(ST.read_parquet(spark, f"{stored}/panel")))
    assert text.count("Scan parquet") == 1


def test_no_cross_or_nested_loop_joins(spark, sf_dir):
    for df in (I.panel(spark, sf_dir), I.movers(spark, sf_dir)):
        text = plan(df)
        assert "Cartesian" not in text and "NestedLoop" not in text


def test_late_pages_equal_early_ones(spark, monkeypatch):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    order = [F.desc("v"), F.asc("id")]
    early = [tuple(r) for r in R.page(df, order, 9, 50).orderBy("rank").collect()]
    monkeypatch.setattr(R, "TOP_ROWS", 100)
    assert [tuple(r) for r in R.page(df, order, 9, 50).orderBy("rank").collect()] == early
    assert "TakeOrdered" not in plan(R.page(df, order, 9, 50))


def test_snapshot_does_not_multiply_rows(spark, stored):
    assert "Expand" not in plan(SP.snapshot(ST.read_parquet(spark, f"{stored}/panel"), 3))


def test_targets_and_features_of_the_refresh_share_one_exchange(spark, stored):
    trends = ST.read_parquet(spark, f"{stored}/trends")
    series = P.add_targets(P.add_time_features(P.clean_trends(trends, collapse=False)))
    assert plan(series).count("Exchange") == 1


def test_staged_tables_are_read_by_id_without_exchange(spark, tmp_path):
    """Windows, targets, catalog join and aggregates by id over staged tables: not one exchange; the same rows as before."""
    from weekpanel.operators import panel as P
    from weekpanel.sources import tables as ST

    rows = spark.range(0, 3000, 1, 5).selectExpr(
        "id % 60 as id", "date_add(date'2023-01-02', cast(7 * (id div 60) as int)) as week_start", "cast(id % 17 as double) as interest"
    )
    catalog = spark.range(60).selectExpr("id", "concat('n', id) as name", "'' as genres", "'' as networks", "'' as keywords")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        series = ST.write_by_key(rows, str(tmp_path / "series"), order=["week_start"])
        cat = ST.write_by_key(P.prepare_catalog(catalog), str(tmp_path / "catalog"), dealt=True)

        def panel(s, c):
            featured = P.attach_catalog(P.add_targets(P.add_time_features(s)), c)
            return featured.join(s.groupBy("id").agg(F.count("*").alias("n_weeks")), "id")

        plan = panel(series, cat)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" in plan and "SortMergeJoin" in plan
        assert "Exchange" in panel(rows, catalog)._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, panel(series, cat).collect())) == sorted(map(repr, panel(rows, catalog).collect()))
        ST.forget_staged(spark)
        assert not [t for t in spark.catalog.listTables() if t.name.startswith(ST.STAGED)]
        assert spark.read.parquet(str(tmp_path / "series")).count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _raw_rows(spark):
    """Dated amounts with a null id, a null date, null amounts, rows that come twice and two rows of one week."""
    return spark.sql(
        """select * from values
        (1L, date'2024-01-01', 5D), (1L, date'2024-01-03', 2D), (1L, date'2024-01-09', null), (1L, date'2024-01-16', 4D),
        (1L, date'2024-01-16', 4D), (2L, date'2024-01-01', 0D), (2L, date'2024-01-08', 0D), (3L, date'2024-01-01', double('nan')),
        (null, date'2024-01-01', 3D), (4L, null, 1D), (4L, date'2024-01-01', -1D) as t(key, day, amount)"""
    )


def test_refresh_averages_a_sorted_series_in_its_order(spark, tmp_path, monkeypatch):
    from weekpanel.plans import refresh as RF

    plans = {}

    def seen(df, path, *args, **kwargs):
        plans[path.rsplit("/", 1)[-1]] = plan(df)
        return ST.write_by_key(df, path, *args, **kwargs)

    monkeypatch.setattr(RF, "write_by_key", seen)
    catalog = spark.sql(
        """select id, 'Drama' as genres, 'N' as networks, 'dark moon' as keywords, date'2024-01-01' as last_air_date,
        'C' as certification, 30D as episode_run_time_mean from values (1L), (2L), (2L), (null) as t(id)"""
    )
    setting = next(iter(RF.SORTED_AGGREGATES))
    before = spark.conf.get(setting)
    run = {"run_id": "r", "run_date": "2024-02-01", "week_start": "2024-01-29"}
    weekly = P.weekly_series(_raw_rows(spark), "key", "day", "amount")
    out = RF.refresh(spark, weekly, catalog, str(tmp_path / "root"), run, retrain=False)
    assert spark.conf.get(setting) == before
    # One sort by id and week serves peak, mean of a week, features and targets; no hash table holds the weeks.
    assert len(re.findall(r"\bSort \[", plans["series"])) == 1 and "SortAggregate" in plans["series"]
    rows = sorted((r["id"], str(r["week_start"]), r["interest"]) for r in out["panel_clean"].collect())
    assert [r[:2] for r in rows] == [(1, "2024-01-01"), (1, "2024-01-08"), (1, "2024-01-15"), (2, "2024-01-01"), (2, "2024-01-08")]
    assert [r[2] for r in rows] == [87.0, None, 100.0, 0.0, 0.0]


def test_sorted_and_hashed_averages_are_the_same(spark):
    from weekpanel.plans.refresh import SORTED_AGGREGATES
    from weekpanel.session import configured

    def rows(source):
        return sorted(map(repr, P.add_targets(P.add_time_features(P.clean_trends(source))).collect()))

    raw = _raw_rows(spark)
    unsorted = raw.selectExpr("cast(key as string) as id", "day as week_start", "amount as interest")
    in_order = unsorted.repartition(2, "id").sortWithinPartitions("id", "week_start")
    for source in (P.weekly_series(raw, "key", "day", "amount"), unsorted, in_order, unsorted.limit(0)):
        hashed = rows(source)
        with configured(spark, SORTED_AGGREGATES):
            assert rows(source) == hashed


def test_bytes_decide_on_a_broadcast_not_rows(spark, monkeypatch):
    from weekpanel import session
    from weekpanel.operators import encoding as E

    few_wide = spark.range(20).selectExpr("cast(id as string) as id", "repeat('x', 1000) as genres")
    many_short = spark.range(500).selectExpr("cast(id as string) as id", "'x' as genres")
    assert few_wide.agg(session.value_bytes(few_wide)).first()[0] > 20_000 > 500 * 36
    monkeypatch.setattr(session, "BROADCAST_BYTES", 19_000)
    hinted = lambda df: "broadcast" in session.broadcast_if_small(df)._jdf.queryExecution().logical().toString().lower()
    assert not hinted(few_wide) and hinted(many_short)
    assert session.broadcast_if_small(spark.range(0)).count() == 0
    codes = spark.sql("select 'status' as column, 'a' as value, 0 as code")
    assert E.encode_serve(spark.sql("select 1 as id, 'a' as status"), codes, ["status"]).first()["status"] == 0
