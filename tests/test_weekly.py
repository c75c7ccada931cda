"""The series kept up from arrivals against the window operators over all rows at once."""

from __future__ import annotations

import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weekpanel.operators.panel import add_targets, add_time_features, clean_trends
from weekpanel.schemas import TRENDS
from weekpanel.streaming import weekly as W

MONDAY = date(2020, 1, 6)


def _whole(rows):
    return add_targets(add_time_features(clean_trends(rows)))


def _sorted(df, columns):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*[F.col(f"`{c}`") for c in columns]).collect()), key=repr
    )


@pytest.fixture(scope="module")
def arrivals():
    """Batches of (id, week, interest): gaps, missing values, repeated weeks, late ones of every lateness."""
    rng = random.Random(6)
    batches = [[], [], [], []]
    for i in range(6):
        weeks = [w for w in range(70) if rng.random() < 0.9]
        for w in weeks:
            row = (i, MONDAY + timedelta(7 * w), rng.choice([None, 0.0, 3.0, 7.5, 40.0, 100.0]))
            at = min(2, w // 30) if rng.random() < 0.85 else rng.randrange(4)
            batches[at].append(row)
            if rng.random() < 0.05:
                batches[rng.randrange(4)].append((i, row[1], rng.choice([1.0, 9.0, None])))
    batches[3].append((99, MONDAY, 5.0))
    return batches


def test_arrivals_in_several_runs_give_what_all_rows_give(spark, tmp_path, arrivals):
    landed, target, checkpoint = (str(tmp_path / n) for n in ("landed", "target", "checkpoint"))
    every = []
    for k, batch in enumerate(arrivals):
        df = spark.createDataFrame(batch, TRENDS)
        df.write.mode("append").option("header", True).csv(landed)
        every += batch
        W.update_series(spark, landed, TRENDS, target, checkpoint)
        if k == 1:
            W.update_series(spark, landed, TRENDS, target, checkpoint)  # nothing new
        want = _whole(spark.createDataFrame(every, TRENDS))
        got = W.current_series(spark, target)
        assert _sorted(got, want.columns) == _sorted(want, want.columns)
    # The last run, which brings weeks late, wrote the rows it touched only.
    last = spark.read.parquet(f"{target}/batch={len(arrivals) - 1}")
    assert 0 < last.count() < got.count()


def test_rows_that_a_week_touches():
    known = [(MONDAY + timedelta(7 * k), 1.0, 1) for k in range(40)]
    series, touched = W.merged(known, [(MONDAY + timedelta(7 * 40), 2.0, 1)])
    assert len(series) == 41 and touched == [36, 37, 38, 39, 40]
    _, touched = W.merged(known, [(MONDAY + timedelta(7 * 20), 2.0, 1)])
    assert touched == list(range(16, 29))
    assert W.merged([], [(MONDAY, 0.0, 0)]) == ([(MONDAY, 0.0, 0)], [0])


class _State(list):
    """A value and a list, as a state store holds them."""

    def exists(self):
        return bool(self)

    def get(self):
        return self[0]

    def update(self, value):
        self[:] = [value]

    def put(self, values):
        self[:] = values

    appendValue = list.append


class _Listed(_State):
    def get(self):
        return iter(self)


def test_a_group_of_entities_is_worked_on_at_once():
    """Few rows go to the state operator, and it gives for a thousand entities what it gives for each alone."""
    rng = np.random.default_rng(3)

    def group(parts):
        series, out = W._Series(), []
        series.recent, series.older = _State(), _Listed()
        for part in parts:
            batch = pa.RecordBatch.from_pydict({"group": np.zeros(len(part), "i4"), **{n: part[n].to_numpy() for n in ("id", "week", "interest")}})
            packed = list(W._packed(iter([batch.slice(0, 7), batch.slice(7)])))
            assert [b.num_rows for b in packed] == [1]
            (frame,) = series.handleInputRows((0,), iter([packed[0].to_pandas()]), None)
            out.append(frame)
        return out

    rows = pd.DataFrame({"id": np.repeat(np.arange(-500, 500), 45), "week": np.tile(np.arange(45), 1000)})
    rows["interest"] = np.where(rng.random(len(rows)) < 0.1, np.nan, rng.integers(0, 101, len(rows)))
    late = rng.random(len(rows)) < 0.05
    parts = [rows[~late & (rows["week"] < 30)], rows[~late & (rows["week"] >= 30)], rows[late]]
    every = group(parts)
    for i in (-500, -3, 0, 499):
        alone = group([p[p["id"] == i] for p in parts])
        for some, own in zip(every, alone, strict=True):
            pd.testing.assert_frame_equal(some[some["id"] == i].reset_index(drop=True), own)
    # The second landing repairs four rows before its own, not all.
    assert len(every[1]) < len(parts[1]) + 5 * 1000


def test_last_versions_are_found_with_one_exchange_and_sort(spark, tmp_path):
    for batch, value in ((0, 1.0), (1, None)):
        rows = spark.createDataFrame([(7, MONDAY, value)], "id bigint, week_start date, interest double")
        rows.write.parquet(f"{tmp_path}/batch={batch}")
    current = W.current_series(spark, str(tmp_path))
    assert [r["interest"] for r in current.collect()] == [None]
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1 and plan.split("Initial Plan")[-1].count("Sort ") == 1
