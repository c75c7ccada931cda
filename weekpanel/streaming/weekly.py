"""The series with features and targets kept up from what arrives: a new week costs its own rows, not the whole history.

Every entity's last rows are its state. A new week is computed from them, and the rows before it get their label and
targets; a late week, or another value of a known one, repairs the rows it touches. Changed rows are appended by batch,
and readers take the last version of each. Entities are dealt into groups, whose rows are worked on as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weekpanel.operators.panel import (
    BREAKOUT_QUANTILE,
    HORIZONS,
    LAGS,
    MEAN_ROWS,
    QUANTILE_MIN_ROWS,
    QUANTILE_ROWS,
    STD_ROWS,
    clean_trends,
)
from weekpanel.session import configured

#: Rows that a changed row reaches: those whose features look back at it, and those whose targets look ahead to it.
AFTER, BEFORE = max(*LAGS, MEAN_ROWS - 1, STD_ROWS - 1, QUANTILE_ROWS - 1), max(HORIZONS)
#: Rows of an entity that are always at hand; weeks that are late by more rows read its older ones too.
RECENT_ROWS = AFTER + BEFORE + 8
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}

#: Groups of entities that share a state; a checkpoint holds for one number of them.
GROUPS = 1024
#: Rows that a task sorts by group at a time.
PACK_ROWS = 1 << 20
_ROW = np.dtype([("id", "<i8"), ("week", "<i4"), ("total", "<f8"), ("n", "<i8")])
_FEATURES = [
    *(f"lag_interest_{k}w double" for k in LAGS), "delta_interest_1w double", "roll_mean_4w double", "roll_std_4w double", "label int",
    *(f"`interest_t+{h}` double" for h in HORIZONS),
]
CHANGED = ", ".join(["id bigint", "week_start date", "interest double", *_FEATURES])

EPOCH = np.datetime64("1970-01-01")
Known = list  # of (week, sum of values, number of values), in the order of weeks


def _entities(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last place of each row's entity, of rows in the order of ids."""
    starts = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1))
    sizes = np.diff(starts, append=len(ids))
    return np.repeat(starts, sizes), np.repeat(starts + sizes - 1, sizes)


def features_at(values: np.ndarray, first: np.ndarray, last: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Features, label and targets of the rows at some places of several series, as the window operators have them.

    ``first`` and ``last`` bound each row's series; missing values are NaN.
    """

    def near(k: int) -> np.ndarray:
        place = at + k
        inside = (place >= first[at]) & (place <= last[at])
        return np.where(inside, values[np.where(inside, place, at)], np.nan)

    def window(n: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.stack([near(k) for k in range(1 - n, 1)])
        return rows, ~np.isnan(rows)

    def mean_of(rows: np.ndarray, known: np.ndarray) -> np.ndarray:
        return np.where(known, rows, 0.0).sum(0) / known.sum(0)

    with np.errstate(invalid="ignore", divide="ignore"):
        own, following = near(0), near(1)
        mean = mean_of(*window(MEAN_ROWS))
        rows, known = window(STD_ROWS)
        squares = np.where(known, (rows - mean_of(rows, known)) ** 2, 0.0).sum(0)
        n = known.sum(0)
        std = np.where(n > 1, np.sqrt(squares / (n - 1)), np.nan)
        rows, known = window(QUANTILE_ROWS)
        recent, n = np.sort(rows, axis=0), known.sum(0)  # missing values come last
        place = np.maximum(n - 1, 0) * BREAKOUT_QUANTILE
        low, high = (np.take_along_axis(recent, p(place).astype(int)[None], 0)[0] for p in (np.floor, np.ceil))
        beaten = following > low + (high - low) * (place - np.floor(place))
    label = ((n >= QUANTILE_MIN_ROWS) & beaten).astype(np.int32)
    return [own, *(near(-k) for k in LAGS), own - near(-1), mean, std, label, *(near(h) for h in HORIZONS)]


def merge(known: np.ndarray, arrived: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The series of all entities with what arrived, by id and week, and the places of the rows that differ in any column."""
    every = np.concatenate((known, arrived))
    order = np.lexsort((every["week"], every["id"]))
    every, new = every[order], order >= len(known)
    begins = np.ones(len(every), bool)
    begins[1:] = (every["id"][1:] != every["id"][:-1]) | (every["week"][1:] != every["week"][:-1])
    starts = np.flatnonzero(begins)
    out = every[starts]
    out["total"], out["n"] = np.add.reduceat(every["total"], starts), np.add.reduceat(every["n"], starts)
    first, last = _entities(out["id"])
    at = np.flatnonzero(np.logical_or.reduceat(new, starts))
    begun = np.bincount(np.maximum(at - BEFORE, first[at]), minlength=len(out) + 1)
    ended = np.bincount(np.minimum(at + AFTER, last[at]) + 1, minlength=len(out) + 1)
    return out, np.flatnonzero(np.cumsum(begun - ended)[:-1])


def merged(known: Known, arrived: Known) -> tuple[Known, list[int]]:
    """The series of one entity with what arrived, and the places of the rows that differ in any column."""

    def rows(of: Known) -> np.ndarray:
        return np.array([(0, (np.datetime64(w) - EPOCH).astype(int), total, n) for w, total, n in of], _ROW)

    out, touched = merge(rows(known), rows(arrived))
    weeks = (EPOCH + out["week"]).tolist()
    return [*zip(weeks, out["total"].tolist(), out["n"].tolist(), strict=True)], touched.tolist()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each group as bytes, so that a group is passed on in few rows."""

    def packed(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        column = {n: np.concatenate([b[n].to_numpy(zero_copy_only=False) for b in some]) for n in ("group", "id", "week", "interest")}
        order = np.argsort(column["group"], kind="stable")
        group, value = column["group"][order], column["interest"][order].astype(float)
        known, rows = ~np.isnan(value), np.empty(len(order), _ROW)
        rows["id"], rows["week"] = column["id"][order], column["week"][order]
        rows["total"], rows["n"] = np.where(known, value, 0.0), known
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        ends = (np.append(starts, len(rows)) * _ROW.itemsize).astype(np.int32)
        values = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(group[starts], pa.int32()), values], names=["group", "rows"])

    some, n = [], 0
    for batch in batches:
        some, n = [*some, batch], n + batch.num_rows
        if n >= PACK_ROWS:
            yield packed(some)
            some, n = [], 0
    if n:
        yield packed(some)


class _Series(StatefulProcessor):
    """Takes the new rows of a group of entities and gives their changed ones."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        # The last rows of all entities, and the ids of those that have older ones.
        self.recent = handle.getValueState("recent", "rows binary, deep binary")
        self.older = handle.getListState("older", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = np.concatenate([np.frombuffer(r, _ROW) for part in rows for r in part["rows"]])
        known, deep = np.empty(0, _ROW), np.empty(0, np.int64)
        if self.recent.exists():
            known, deep = (np.frombuffer(r, kind) for r, kind in zip(self.recent.get(), (_ROW, np.int64), strict=True))
        # The group's entities that nothing arrived for stay as they are.
        arrived = arrived[np.argsort(arrived["id"], kind="stable")]
        ids, starts = np.unique(arrived["id"], return_index=True)
        own = np.isin(known["id"], ids)
        others, known = known[~own], known[own]
        # A row's columns look back AFTER rows, and the first one touched lies BEFORE rows before what arrived.
        entity = np.searchsorted(ids, known["id"])
        early = known["week"] < np.minimum.reduceat(arrived["week"], starts)[entity]
        short = ids[np.isin(ids, deep) & (np.bincount(entity[early], minlength=len(ids)) < AFTER + BEFORE)]
        left = np.empty(0, _ROW)
        if len(short):
            older = np.concatenate([np.frombuffer(r, _ROW) for (r,) in self.older.get()])
            wanted = np.isin(older["id"], short)
            left, known = older[~wanted], np.concatenate((older[wanted], known))
        series, touched = merge(known, arrived)
        first, last = _entities(series["id"])
        keep = last - np.arange(len(series)) < RECENT_ROWS
        old = series[~keep]  # what has become old, or was read
        if len(short):
            self.older.put([(np.concatenate((left, old)).tobytes(),)])
        elif len(old):
            self.older.appendValue((old.tobytes(),))
        self.recent.update((np.concatenate((others, series[keep])).tobytes(), np.union1d(deep, old["id"]).tobytes()))
        values = np.where(series["n"] > 0, series["total"] / np.maximum(series["n"], 1), np.nan)
        weeks = pd.Series(pd.array(EPOCH + series["week"][touched], dtype="datetime64[s]"))
        columns = [series["id"][touched], weeks, *features_at(values, first, last, touched)]
        names = [f.rsplit(" ", 1)[0].strip("`") for f in CHANGED.split(", ")]
        yield pd.DataFrame(dict(zip(names, columns, strict=True)))

    def close(self) -> None:
        pass


def update_series(spark: SparkSession, landed: str, schema: str, target: str, checkpoint: str, fmt: str = "csv") -> None:
    """Take what landed since the last run, append the rows that change to ``target``, then stop.

    Values of one entity and week are averaged, whichever run brings them. Rows without a usable key are left out. The
    checkpoint holds the state and which files were taken, so that a run that breaks off is repeated and changes nothing.
    """
    with configured(spark, STATE_STORE):
        source = spark.readStream.schema(schema).option("header", True).format(fmt).load(landed)
        group = F.pmod(F.xxhash64("id"), F.lit(GROUPS)).cast("int").alias("group")
        typed = clean_trends(source, collapse=False).select(group, "id", F.unix_date("week_start").alias("week"), "interest")
        packed = typed.mapInArrow(_packed, "group int, rows binary")
        changed = packed.groupBy("group").transformWithStateInPandas(_Series(), CHANGED, outputMode="Update", timeMode="None")

        def append(batch: DataFrame, number: int) -> None:
            # A batch that is repeated replaces its own folder.
            batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

        started = changed.writeStream.foreachBatch(append).outputMode("update").option("checkpointLocation", checkpoint)
        started.trigger(availableNow=True).start().awaitTermination()


def current_series(spark: SparkSession, target: str) -> DataFrame:
    """The last version of every row."""
    rows = spark.read.schema(f"{CHANGED}, batch bigint").parquet(target)
    # A batch has a row once, so that nothing is to be gained from an aggregate before the exchange.
    last = F.max("batch").over(Window.partitionBy("id", "week_start"))
    return rows.withColumn("_last", last).where(F.col("batch") == F.col("_last")).drop("batch", "_last")
