"""Time split, dataset snapshot and metrics of predictions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.operators.panel import HORIZONS
from weekpanel.operators.ranking import global_rank

# Training share, and below how many weeks the rows are split instead.
TRAIN_SHARE = 0.8
MIN_WEEKS = 5


def cutoff(df: DataFrame, time_col: str = "week_start") -> DataFrame:
    """One row: number of distinct weeks, the cut-off week and the last week.

    The set of weeks is as long as the calendar, not the data.
    """
    weeks = df.agg(F.sort_array(F.collect_set(time_col)).alias("w"))
    n = F.size("w")
    at = F.floor(n * F.lit(TRAIN_SHARE)).cast("int")
    return weeks.select(
        n.alias("n_weeks"), F.get("w", at).alias("cutoff_week"), F.get("w", n - 1).alias("last_week")
    )


def time_split(
    df: DataFrame, id_col: str = "id", time_col: str = "week_start", *, purge: int = 0
) -> DataFrame:
    """Add ``split`` (train, val) and ``cutoff_week``.

    Rows before the cut-off week train, later rows validate. Fewer than five weeks split by position in
    (id, week) order. ``purge`` drops that many weeks of training rows before the cut-off.
    """
    row = cutoff(df, time_col).first()
    if row["n_weeks"] < MIN_WEEKS:
        return _position_split(df, id_col, time_col, row["last_week"])
    cut = F.lit(row["cutoff_week"])
    week = F.col(time_col)
    split = F.when(week < F.date_sub(cut, 7 * purge), "train").when(week >= cut, "val")
    return df.withColumns({"split": split, "cutoff_week": cut})


def _position_split(df: DataFrame, id_col: str, time_col: str, last_week) -> DataFrame:
    order = [F.asc(id_col), F.asc_nulls_last(time_col)]
    ranked = global_rank(df, order, "_rank")
    n_train = int(ranked.count() * TRAIN_SHARE)
    return ranked.withColumns(
        {
            "split": F.when(F.col("_rank") <= n_train, "train").otherwise("val"),
            "cutoff_week": F.lit(last_week or date(1970, 1, 1)),
        }
    ).drop("_rank")


def target_rows(df: DataFrame, prediction: str | None = None, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """One row per row and horizon with a known target: (horizon, split, y, p)."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(h).alias("horizon"),
                F.col(f"`interest_t+{h}`").alias("y"),
                (F.col(prediction) if prediction else F.lit(None).cast("double")).alias("p"),
            )
            for h in horizons
        ]
    )
    return (
        df.select("split", "cutoff_week", F.explode(pairs).alias("_t"))
        .select("split", "cutoff_week", "_t.horizon", "_t.y", "_t.p")
        .where(F.col("y").isNotNull() & F.col("split").isNotNull())
    )


def split_counts(df: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Usable training and validation rows per horizon."""
    in_split = {s: F.col("split") == s for s in ("train", "val")}
    per_horizon = [
        F.struct(
            F.lit(h).alias("horizon"),
            *[
                F.count_if(F.col(f"`interest_t+{h}`").isNotNull() & is_in).alias(f"n_{s}")
                for s, is_in in in_split.items()
            ],
        )
        for h in horizons
    ]
    # All horizons in one aggregate, so no row is repeated.
    counted = df.groupBy("cutoff_week").agg(F.array(*per_horizon).alias("_h"))
    return counted.select("cutoff_week", F.explode("_h").alias("_c")).select("_c.*", "cutoff_week")


def require_rows(counts: DataFrame) -> dict[int, tuple[int, int]]:
    """The counts per horizon; raises if a horizon has no training or no validation rows."""
    found = {r["horizon"]: (r["n_train"], r["n_val"]) for r in counts.collect()}
    for h, (n_train, n_val) in sorted(found.items()):
        if not n_train or not n_val:
            raise ValueError(f"horizon t+{h}: empty split, train rows {n_train}, validation rows {n_val}")
    if not found:
        raise ValueError("no rows to split")
    return found


def error_metrics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """RMSE, R2 and row count of (y, p) rows per key, in one pass."""
    error = F.col("y") - F.col("p")
    return (
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(error * error).alias("_mse"),
            F.var_pop("y").alias("_var"),
        )
        .select(
            *keys,
            "n",
            F.sqrt("_mse").alias("rmse"),
            F.when(F.col("_var") > 0, 1 - F.col("_mse") / F.nullif(F.col("_var"), F.lit(0.0)))
            .otherwise(F.when(F.col("_mse") == 0, 1.0).otherwise(0.0))
            .alias("r2"),
        )
    )


def snapshot(df: DataFrame, n_features: int, time_col: str = "week_start", id_col: str = "id") -> DataFrame:
    """Rows, columns, features, distinct weeks and distinct entities of the training frame.

    Weeks are collected, as they are as many as the calendar has; so only the entities need a distinct count.
    """
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_cols"),
        F.lit(n_features).alias("n_features"),
        F.size(F.collect_set(time_col)).cast("bigint").alias("n_unique_weeks"),
        F.countDistinct(id_col).alias("n_unique_shows"),
    )
