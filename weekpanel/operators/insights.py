"""Keyword lift and coverage, panel summary, missingness and the interest histogram."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.functions.text import pretty_keyword
from weekpanel.session import cut_lineage

# Smallest coverage reported, list lengths, bin limit of the histogram.
MIN_COVERAGE = 0.01
LIFT_ROWS, COVERAGE_ROWS, SHARE_ROWS = 12, 12, 6
MISSING_ROWS = 12
MAX_BINS = 20
# Steps a bin width may have, times a power of ten.
NICE_STEPS = (1, 2, 5, 10)


def entity_sums(rows: DataFrame, id_col: str = "id", value: str = "interest") -> DataFrame:
    """Rows, known values and their sum per entity."""
    return rows.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("rows"), F.count(value).alias("known"), F.sum(value).alias("total")
    )


def keyword_insights(sums: DataFrame, keywords: DataFrame, id_col: str = "id") -> DataFrame:
    """Coverage and mean value with and without each keyword, and the lift between them.

    ``sums`` has one row per entity, ``keywords`` distinct (id, term). What is absent follows from the
    totals, so one aggregate serves all keywords. Totals and join both read ``sums``, which is written out once:
    the two plans differ below the join, so that Spark would work on all rows of the series a second time.
    """
    sums = cut_lineage(sums)
    totals = sums.agg(
        F.struct(F.sum("rows").alias("rows"), F.sum("known").alias("known"), F.sum("total").alias("total"))
    ).scalar()
    present = (
        keywords.join(sums, id_col)
        .groupBy("term")
        .agg(F.sum("rows").alias("rows"), F.sum("known").alias("known"), F.sum("total").alias("total"))
        .withColumn("_all", totals)
        .where(F.try_divide("rows", F.col("_all.rows")) >= MIN_COVERAGE)
    )
    means = present.select(
        F.concat(F.lit("kw__"), "term").alias("keyword"),
        (100.0 * F.col("rows") / F.col("_all.rows")).alias("coverage_%"),
        F.try_divide("total", "known").alias("mean_interest_present"),
        F.try_divide(
            F.col("_all.total") - F.coalesce("total", F.lit(0.0)), F.col("_all.known") - F.col("known")
        ).alias("mean_interest_absent"),
        F.try_divide(F.col("_all.total"), F.col("_all.known")).alias("_mean"),
    )
    lift = F.col("mean_interest_present") - F.col("mean_interest_absent")
    return means.withColumns(
        {
            "lift_present_minus_absent": lift,
            "lift_vs_global_mean": F.col("mean_interest_present") - F.col("_mean"),
            "keyword_readable": pretty_keyword("keyword"),
        }
    ).drop("_mean")


def keyword_lift(insights: DataFrame, n: int = LIFT_ROWS) -> DataFrame:
    """Keywords by lift."""
    return insights.orderBy(F.desc_nulls_last("lift_present_minus_absent"), "keyword").limit(n)


def keyword_coverage(insights: DataFrame, n: int = COVERAGE_ROWS) -> DataFrame:
    """Keywords by coverage, then mean value."""
    order = [F.desc("`coverage_%`"), F.desc_nulls_last("mean_interest_present"), F.asc("keyword")]
    return insights.select("keyword", "keyword_readable", "`coverage_%`", "mean_interest_present").orderBy(
        *order
    ).limit(n)


def keyword_share(insights: DataFrame, n: int = SHARE_ROWS) -> DataFrame:
    """Share of each of the most covering keywords in their common coverage."""
    top = keyword_coverage(insights.where(F.col("mean_interest_present").isNotNull()), n)
    total = top.agg(F.sum("`coverage_%`")).scalar()
    return top.withColumn("coverage_share", F.col("`coverage_%`") / total)


def panel_summary(panel: DataFrame) -> DataFrame:
    """Rows, entities, first and last week, percentage of missing interest."""
    return panel.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("id").alias("n_shows"),
        F.min("week_start").alias("min_week"),
        F.max("week_start").alias("max_week"),
        (100.0 * F.avg(F.col("interest").isNull().cast("int"))).alias("pct_interest_missing"),
    )


def missingness(df: DataFrame, n: int = MISSING_ROWS) -> DataFrame:
    """The columns with the highest share of missing values, in percent."""
    rates = [
        F.struct(
            F.lit(c).alias("column"),
            F.round(100.0 * F.avg(F.col(f"`{c}`").isNull().cast("int")), 2).alias("missing_rate"),
        )
        for c in df.columns
    ]
    one = df.agg(F.array(*rates).alias("_r"))
    return (
        one.select(F.explode("_r").alias("_c"))
        .select("_c.*")
        .orderBy(F.desc("missing_rate"), F.asc("column"))
        .limit(n)
    )


def nice_width(low: float, high: float, max_bins: int = MAX_BINS) -> float:
    """The smallest round bin width that needs no more than ``max_bins`` bins."""
    span = max(high - low, 1e-12)
    power = 10.0 ** math.floor(math.log10(span / max_bins))
    return next(power * step for step in NICE_STEPS if span / (power * step) <= max_bins)


def histogram(df: DataFrame, value: str = "interest", width: float = 5.0, high: float = 100.0) -> DataFrame:
    """Rows per bin; the top value belongs to the last bin."""
    start = F.least(F.floor(F.col(value) / width) * width, F.lit(high - width))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(start.cast("double").alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("weeks"))
    )


def feature_snapshot(row: DataFrame, names: list[str], n: int = 40) -> DataFrame:
    """One entity's model inputs as (feature, value), largest absolute value first."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in names]
    )
    return (
        row.select(F.explode(pairs).alias("_p"))
        .select("_p.*")
        .orderBy(F.abs("value").desc(), F.asc("feature"))
        .limit(n)
    )
