from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from weekpanel.functions import casts as C
from weekpanel.operators import latest as L
from weekpanel.operators import panel as P
from weekpanel.operators import split as S

EXAMPLE = [3, 1, 4, 1, 5, None, 2, 6, 5, 3, 5, 8]


def column(df, name):
    return [r[name] for r in df.orderBy("id", "week_start").collect()]


def test_window_features_by_hand(series):
    out = P.add_time_features(series(e1=EXAMPLE)).cache()
    assert column(out, "label") == [0, 0, 0, 1, 0, 0, 1, 1, 0, 0, 1, 0]
    for k in P.LAGS:
        assert column(out, f"lag_interest_{k}w") == [None] * k + EXAMPLE[:-k]
    deltas = [None] + [None if a is None or b is None else b - a for a, b in zip(EXAMPLE, EXAMPLE[1:], strict=False)]
    assert column(out, "delta_interest_1w") == deltas
    windows = [[v for v in EXAMPLE[max(0, i - 3) : i + 1] if v is not None] for i in range(len(EXAMPLE))]
    assert column(out, "roll_mean_4w") == pytest.approx([statistics.mean(w) for w in windows])
    stds = [statistics.stdev(w) if len(w) > 1 else None for w in windows]
    assert [s is None for s in column(out, "roll_std_4w")] == [s is None for s in stds]
    assert [s for s in column(out, "roll_std_4w") if s is not None] == pytest.approx([s for s in stds if s is not None])


def test_short_and_gappy_series(spark, series):
    out = P.add_time_features(series(e1=[7], e2=[1, 9])).orderBy("id", "week_start").collect()
    assert [(r["lag_interest_1w"], r["roll_std_4w"] is None, r["label"]) for r in out] == [
        (None, True, 0),
        (None, True, 0),
        (1.0, False, 0),
    ]
    gap = series(e1=[1, 2, 3, 4]).where("week_start <> date'2024-01-08'")
    # Lags count rows, not calendar weeks.
    assert column(P.add_time_features(gap), "lag_interest_1w") == [None, 1.0, 3.0]


def test_join_keeps_first_catalog_row_and_drops_unknown(spark, series):
    catalog = spark.createDataFrame(
        [(1, 2, "b", None, 9.0), (1, 1, "a", "x", 9.0), (3, 1, "c", "", 9.0)],
        "id bigint, seq int, name string, genres string, interest double",
    )
    first = P.prepare_catalog(catalog, ["seq"])
    out = P.attach_catalog(series(e1=[5], e2=[6]), first)
    row = out.collect()
    assert [(r["id"], r["name"], r["genres"], r["interest"]) for r in row] == [(1, "a", "x", 9.0)]
    assert out.columns.count("interest") == 1


def test_bounds_apply_before_windows(series):
    kept = P.clean_trends(series(e1=[1, 2, 3, 4]), "2024-01-08", "2024-01-15")
    assert column(P.add_time_features(kept), "lag_interest_1w") == [None, 2.0]


def test_unusable_values_and_repeated_weeks(spark):
    raw = spark.createDataFrame(
        [("1", "2024-01-01", "4"), ("1", "2024-01-01", "6"), ("1", "2024-13-01", "1"), ("x", "2024-01-01", "1"),
         ("2", "2024-01-01", "NaN"), ("2", "2024-01-08", "Infinity"), ("2", "2024-01-15", "x")],
        "id string, week_start string, interest string",
    )
    out = P.clean_trends(raw, collapse=True).orderBy("id", "week_start").collect()
    assert [(r["id"], r["interest"]) for r in out] == [(1, 5.0), (2, None), (2, None), (2, None)]


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="interest"):
        P.clean_trends(spark.range(1).withColumn("week_start", F.lit(None)))
    with pytest.raises(ValueError, match="id"):
        P.prepare_catalog(spark.range(1).toDF("key"))


def test_nonfinite_values_become_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.5,), (None,)], "x double")
    assert [r["x"] for r in C.clean_nonfinite(df).collect()] == [None, None, None, 1.5, None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (50.0,), (101.0,), (None,)], "x double")
    assert [r[0] for r in df.select(C.clip("x", 0, 100)).collect()] == [0.0, 50.0, 100.0, None]


@pytest.fixture(scope="module")
def dense(spark):
    """146 entities with 262 weeks each, the shape of the published training run."""
    cells = spark.range(146 * 262)
    return cells.selectExpr(
        "id % 146 as id",
        "date_add(date'2020-01-05', cast(7 * (id div 146) as int)) as week_start",
        "cast(pmod(hash(id), 101) as double) as interest",
    )


def test_split_counts_of_the_published_run(dense):
    split = S.time_split(P.add_targets(dense))
    assert split.count() == 38252
    assert S.require_rows(S.split_counts(split)) == {
        1: (30514, 7592),
        2: (30514, 7446),
        3: (30514, 7300),
        4: (30514, 7154),
    }
    assert split.where("split is null").count() == 0


def test_purge_drops_the_weeks_before_the_cut(dense):
    purged = S.time_split(P.add_targets(dense), purge=4)
    assert S.require_rows(S.split_counts(purged, [1]))[1] == (30514 - 4 * 146, 7592)


def test_five_weeks_cut_at_the_last_and_four_fall_back(series):
    five = S.time_split(series(e1=range(5), e2=range(5)))
    assert five.where("split = 'val'").count() == 2
    four = S.time_split(series(e1=range(4), e2=range(4)))
    got = {(r["id"], str(r["week_start"])): r["split"] for r in four.collect()}
    assert [got[k] for k in sorted(got)] == ["train"] * 6 + ["val"] * 2


def test_empty_split_raises(series):
    alone = S.time_split(P.add_targets(series(e1=[1, 2, 3, 4, 5, 6]), [1]))
    with pytest.raises(ValueError, match="empty split"):
        S.require_rows(S.split_counts(alone.where("split = 'train'"), [1]))


def test_error_metrics_edge_cases(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 1.0), ("a", 1.0, 1.0), ("b", 1.0, 2.0), ("b", 1.0, 1.0), ("c", 0.0, 1.0), ("c", 2.0, 1.0)],
        "k string, y double, p double",
    )
    got = {r["k"]: (r["rmse"], r["r2"]) for r in S.error_metrics(rows, ["k"]).collect()}
    assert got == {"a": (0.0, 1.0), "b": (pytest.approx(0.5**0.5), 0.0), "c": (1.0, 0.0)}


def test_change_needs_two_rows(series):
    got = {r["id"]: r["change_4w"] for r in L.recent_change(series(e1=[9], e2=[1, 5, 2, 3, 9])).collect()}
    assert got == {1: None, 2: 4.0}


def test_unknown_entity_raises(series):
    with pytest.raises(ValueError, match="7"):
        L.entity_history(series(e1=[1]), 7)


def test_compare_limits(series):
    panel = series(e1=[1], e2=[2])
    with pytest.raises(ValueError, match="two"):
        L.compare_entities(panel, panel, panel, [1])
