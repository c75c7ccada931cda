"""Latest state of every entity and views of one or several entities' series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.functions.dates import weeks_after
from weekpanel.operators.dedupe import keep_last

# Look-back of the short change and of the plots, and the compare limit.
CHANGE_ROWS = 4
PLOT_DAYS = 26 * 7
MAX_COMPARED = 5


def latest_per_entity(panel: DataFrame, id_col: str = "id", time_col: str = "week_start") -> DataFrame:
    """The last row of every entity."""
    return keep_last(panel, [id_col], [time_col])


def catalog_top(latest: DataFrame, n: int = 200, by: str = "popularity", id_col: str = "id") -> DataFrame:
    """The ``n`` most popular entities."""
    return latest.orderBy(F.desc_nulls_last(by), F.asc(id_col)).limit(n)


def recent_change(
    panel: DataFrame, rows: int = CHANGE_ROWS, value: str = "interest", id_col: str = "id", time_col: str = "week_start"
) -> DataFrame:
    """Last minus first value over an entity's last ``rows`` rows; NULL with fewer than two rows."""
    newest = Window.partitionBy(id_col).orderBy(F.desc(time_col))
    tail = panel.select(id_col, time_col, value, F.row_number().over(newest).alias("_rn")).where(
        F.col("_rn") <= rows
    )
    change = F.max_by(value, time_col) - F.min_by(value, time_col)
    return tail.groupBy(id_col).agg(
        F.max(time_col).alias("latest_week"),
        F.max_by(value, time_col).alias("latest_interest"),
        F.when(F.count(F.lit(1)) >= 2, change).alias("change_4w"),
    )


def entity_history(panel: DataFrame, entity_id, id_col: str = "id") -> DataFrame:
    """All rows of one entity; the filter reaches the scan. Raises if there are none."""
    rows = panel.where(F.col(id_col) == F.lit(entity_id))
    if rows.select(id_col).isEmpty():
        raise ValueError(f"id {entity_id} is not in the panel")
    return rows


def trailing(df: DataFrame, last: Column, days: int = PLOT_DAYS, time_col: str = "week_start") -> DataFrame:
    """Rows no more than ``days`` before ``last``."""
    return df.where(F.col(time_col) >= F.date_sub(last, days))


def trailing_per_entity(
    panel: DataFrame, days: int = PLOT_DAYS, id_col: str = "id", time_col: str = "week_start"
) -> DataFrame:
    """The last half year of every entity, counted from its own last week."""
    whole = Window.partitionBy(id_col)
    marked = panel.withColumn("_last", F.max(time_col).over(whole))
    return trailing(marked, F.col("_last"), days, time_col).drop("_last")


def naive_forecast(latest: DataFrame, horizons: Sequence[int], value: str = "roll_mean_4w") -> DataFrame:
    """A model-free forecast: the latest rolling mean for every horizon, as (id, horizon, week_start, forecast)."""
    steps = F.explode(F.array(*[F.lit(h) for h in horizons]))
    return latest.select("id", "week_start", F.col(value).alias("forecast"), steps.alias("horizon")).select(
        "id", "horizon", weeks_after("week_start", F.col("horizon")).alias("week_start"), "forecast"
    )


def history_with_forecast(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """Full outer join of observed and forecast values on entity and week."""
    seen = history.select("id", "week_start", F.col("interest").alias("historical_interest"))
    return seen.join(forecast.select("id", "week_start", "forecast"), ["id", "week_start"], "full")


def labelled_series(history: DataFrame, forecast: DataFrame, forecast_label: str = "Forecast") -> DataFrame:
    """Observed and forecast values below each other: (id, week_start, value, series)."""
    seen = history.select("id", "week_start", F.col("interest").alias("value"), F.lit("Historical").alias("series"))
    coming = forecast.select("id", "week_start", F.col("forecast").alias("value"), F.lit(forecast_label).alias("series"))
    return seen.unionByName(coming)


def compare_entities(panel: DataFrame, forecast: DataFrame, names: DataFrame, ids: Sequence) -> DataFrame:
    """Series and t+1 points of two to five entities over the last half year of their union."""
    chosen = list(dict.fromkeys(ids))
    if not 2 <= len(chosen) <= MAX_COMPARED:
        raise ValueError(f"pick two to {MAX_COMPARED} entities, not {len(chosen)}")
    picked = F.col("id").isin(chosen)
    t1 = forecast.where(picked & (F.col("horizon") == 1))
    both = labelled_series(panel.where(picked), t1, "Forecast t+1")
    last = both.agg(F.max("week_start")).scalar()
    # At most five names.
    shown = names.where(picked).select("id", F.col("name").alias("show"))
    return trailing(both, last).join(F.broadcast(shown), "id")
