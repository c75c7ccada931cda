"""The metrics history and the views on it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.functions.dates import utc_iso
from weekpanel.operators.dedupe import keep_last

# What identifies a record, and what is kept as text.
RECORD_KEY = ("run_id", "family", "horizon", "created_utc")
TEXT_COLUMNS = ("created_utc", "run_date", "week_start")


def with_run(records: DataFrame, run: Mapping[str, object]) -> DataFrame:
    """Put the run's values on every record."""
    return records.withColumns({k: F.lit(v) for k, v in run.items()})


def append_dedupe(history: DataFrame | None, new: DataFrame) -> DataFrame:
    """History plus new records; of equal keys the newer record stays, within a batch the larger row."""
    new = new.withColumn("_batch", F.lit(1))
    merged = (
        new
        if history is None
        else history.withColumn("_batch", F.lit(0)).unionByName(new, allowMissingColumns=True)
    )
    keys = [k for k in RECORD_KEY if k in merged.columns]
    kept = keep_last(merged, keys, ["_batch"]) if keys else merged
    texts = {c: F.col(c).cast("string") for c in TEXT_COLUMNS if c in kept.columns}
    return kept.withColumns(texts).drop("_batch") if texts else kept.drop("_batch")


def append_plain(history: DataFrame | None, new: DataFrame) -> DataFrame:
    """History plus new records as they are; new records without a time stamp get the current one."""
    stamped = new if "ts" in new.columns else new.withColumn("ts", utc_iso())
    return stamped if history is None else history.unionByName(stamped, allowMissingColumns=True)


def of_run(history: DataFrame, family: str, run_id: str | None = None) -> DataFrame:
    rows = history.where(F.col("family") == family)
    return rows.where(F.col("run_id") == run_id) if run_id is not None else rows


def run_kpis(history: DataFrame, keys: tuple[str, ...] = ("family", "run_id")) -> DataFrame:
    """Horizons covered, best and average validation RMSE, average validation R2 of every run."""
    return history.groupBy(*keys).agg(
        F.sort_array(F.collect_set("horizon")).alias("horizons"),
        F.min("rmse_val").alias("rmse_best"),
        F.avg("rmse_val").alias("rmse_avg"),
        F.avg("r2_val").alias("r2_avg"),
    )


def by_horizon(history: DataFrame, keys: tuple[str, ...] = ("family", "run_id")) -> DataFrame:
    """Mean errors and largest row counts per horizon of every run."""
    means = [F.avg(c).alias(c) for c in ("rmse_val", "r2_val", "rmse_train", "r2_train")]
    sizes = [F.max(c).alias(c) for c in ("n_train", "n_val")]
    return history.where(F.col("horizon").isNotNull()).groupBy(*keys, "horizon").agg(*means, *sizes)


def runs(history: DataFrame) -> DataFrame:
    """Distinct runs, newest first."""
    return history.select("created_utc", "run_id", "week_start").distinct().orderBy(
        F.desc("created_utc"), F.asc("run_id"), F.asc("week_start")
    )


def family_counts(history: DataFrame) -> DataFrame:
    return history.groupBy("run_id", "family").agg(F.count(F.lit(1)).alias("n"))
