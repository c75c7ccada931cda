"""The entity x week panel: cleaned series, row-based window features, targets and metadata.

Windows run per entity over weeks. ``weekly_series`` and ``clean_trends`` leave one row per entity and week,
so a window holds at most one row per calendar week (52 a year), however many raw rows the entity has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.functions.casts import clean_nonfinite, fill_text, require_columns, to_date, to_id, to_number
from weekpanel.functions.dates import week_start as monday
from weekpanel.operators.dedupe import keep_first

# The feature set of the panel.
LAGS = (1, 2, 4, 8)
HORIZONS = (1, 2, 3, 4)
MEAN_ROWS, STD_ROWS, QUANTILE_ROWS = 4, 4, 8
QUANTILE_MIN_ROWS = 3
BREAKOUT_QUANTILE = 0.8
TEXT_COLUMNS = ("genres", "networks", "keywords")


def weekly_series(
    raw: DataFrame, id_col: str, ts_col: str, amount_col: str, *, scale_to_peak: bool = True
) -> DataFrame:
    """Raw dated amounts to (id, week_start, interest), scaled so that an entity's best week is 100.

    An entity that never has more than 0 keeps 0 in all its weeks.
    """
    weekly = raw.groupBy(F.col(id_col).alias("id"), monday(ts_col).alias("week_start")).agg(
        F.sum(amount_col).alias("interest")
    )
    if not scale_to_peak:
        return weekly
    # Same partition and order as the feature windows, so that one sort serves both.
    whole = series_window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = weekly.withColumn("_peak", F.max("interest").over(whole))
    scaled = F.floor(100 * F.col("interest") / F.col("_peak")).cast("double")
    return marked.withColumn("interest", F.when(F.col("_peak") == 0, 0.0).otherwise(scaled)).drop("_peak")


def clean_trends(
    trends: DataFrame, min_week: str | None = None, max_week: str | None = None, *, collapse: bool = True
) -> DataFrame:
    """Typed (id, week_start, interest) rows with both keys, inside the optional inclusive bounds.

    ``collapse`` averages repeated (id, week) rows, map-side first, so that a window never holds more than
    one row per calendar week. Leave it out only for a source that has one row per week, such as
    ``weekly_series``.
    """
    require_columns(trends, ("id", "week_start", "interest"), "trends")
    typed = (
        trends.withColumns(
            {
                "id": to_id("id"),
                "week_start": to_date("week_start"),
                "interest": to_number("interest"),
            }
        )
        .na.drop(subset=["id", "week_start"])
    )
    if min_week:
        typed = typed.where(F.col("week_start") >= F.lit(min_week).cast("date"))
    if max_week:
        typed = typed.where(F.col("week_start") <= F.lit(max_week).cast("date"))
    if collapse:
        typed = typed.groupBy("id", "week_start").agg(F.avg("interest").alias("interest"))
    return typed


def series_window(id_col: str = "id", time_col: str = "week_start"):
    return Window.partitionBy(id_col).orderBy(time_col)


def lag_features(value: str = "interest", id_col: str = "id", time_col: str = "week_start") -> dict[str, Column]:
    w = series_window(id_col, time_col)
    return {f"lag_{value}_{k}w": F.lag(value, k).over(w) for k in LAGS}


def roll_mean(value: str = "interest", id_col: str = "id", time_col: str = "week_start") -> Column:
    return F.avg(value).over(series_window(id_col, time_col).rowsBetween(1 - MEAN_ROWS, 0))


def roll_std(value: str = "interest", id_col: str = "id", time_col: str = "week_start") -> Column:
    """Sample deviation; NULL with fewer than two known values."""
    return F.stddev_samp(value).over(series_window(id_col, time_col).rowsBetween(1 - STD_ROWS, 0))


def recent_values(value: str = "interest", id_col: str = "id", time_col: str = "week_start") -> Column:
    """The known values of the last eight rows."""
    return F.collect_list(value).over(series_window(id_col, time_col).rowsBetween(1 - QUANTILE_ROWS, 0))


def quantile_of(values: Column, q: float = BREAKOUT_QUANTILE, min_rows: int = QUANTILE_MIN_ROWS) -> Column:
    """Percentile of a short sorted list with linear interpolation; equal neighbours give exactly their value."""
    position = (F.size(values) - 1) * F.lit(q)
    below = F.floor(position).cast("int")
    low, high = F.get(values, below), F.get(values, F.ceil(position).cast("int"))
    return F.when(F.size(values) >= min_rows, low + (high - low) * (position - below))


def add_roll_quantile(
    df: DataFrame,
    out: str = "roll_q80_8w",
    value: str = "interest",
    id_col: str = "id",
    time_col: str = "week_start",
) -> DataFrame:
    """Rolling percentile of the last eight rows."""
    values = df.withColumn("_recent", F.sort_array(recent_values(value, id_col, time_col)))
    return values.withColumn(out, quantile_of(F.col("_recent"))).drop("_recent")


def add_time_features(
    df: DataFrame, value: str = "interest", id_col: str = "id", time_col: str = "week_start"
) -> DataFrame:
    """Lags, difference, rolling mean and deviation, and the breakout label, from one shuffle and sort.

    The label is 1 if the next row beats the rolling percentile; a missing operand gives 0.
    """
    names = (value, id_col, time_col)
    lags = lag_features(*names)
    windowed = df.withColumns(
        {
            **lags,
            "roll_mean_4w": roll_mean(*names),
            "roll_std_4w": roll_std(*names),
            "_next": F.lead(value, 1).over(series_window(id_col, time_col)),
        }
    )
    beaten = F.coalesce(F.col("_next") > F.col("_quantile"), F.lit(False))
    featured = add_roll_quantile(windowed, "_quantile", *names).withColumns(
        {
            f"delta_{value}_1w": F.col(value) - F.col(f"lag_{value}_1w"),
            "label": beaten.cast("int"),
        }
    )
    return featured.select(*df.columns, *lags, f"delta_{value}_1w", "roll_mean_4w", "roll_std_4w", "label")


def add_targets(
    df: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    value: str = "interest",
    id_col: str = "id",
    time_col: str = "week_start",
) -> DataFrame:
    """The value 1..4 rows ahead, one column per horizon."""
    w = series_window(id_col, time_col)
    return df.withColumns({f"{value}_t+{h}": F.lead(value, h).over(w) for h in horizons})


def prepare_catalog(catalog: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """One row per id (the first by ``order``), typed key, empty text for missing lists."""
    require_columns(catalog, ("id",), "catalog")
    typed = catalog.withColumn("id", to_id("id")).na.drop(subset=["id"])
    return fill_text(keep_first(typed, ["id"], order), TEXT_COLUMNS)


def attach_catalog(panel: DataFrame, catalog: DataFrame) -> DataFrame:
    """Inner join on id; catalog columns replace panel columns of the same name.

    No hint: the panel is already partitioned by id, so a large catalog merges without moving the panel
    and a small one is broadcast by its measured size.
    """
    clashes = [c for c in panel.columns if c in catalog.columns and c != "id"]
    return panel.drop(*clashes).join(catalog, "id", "inner")


def build_panel(
    trends: DataFrame,
    catalog: DataFrame,
    *,
    min_week: str | None = None,
    max_week: str | None = None,
    collapse: bool = True,
    catalog_order: Sequence[str] | None = None,
) -> DataFrame:
    """Cleaned series with window features and metadata. The week bounds apply before the windows.

    Of repeated catalog ids the first by ``catalog_order`` counts.
    """
    series = clean_trends(trends, min_week, max_week, collapse=collapse)
    featured = add_time_features(series)
    return clean_nonfinite(attach_catalog(featured, prepare_catalog(catalog, catalog_order)))
