"""Tables the registered queries start from, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekpanel.operators import features as X
from weekpanel.operators import latest as L
from weekpanel.operators import movers as MV
from weekpanel.operators.metrics import append_dedupe
from weekpanel.operators.panel import add_targets, add_time_features, build_panel, clean_trends, prepare_catalog
from weekpanel.session import cut_lineage
from weekpanel.sources import adapters
from weekpanel.sources.adapters import table

N_GENRES, N_NETWORKS, N_TERMS = X.TOP_GENRES, X.TOP_NETWORKS, X.TOP_TERMS


def trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.trends(spark, sf_dir)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.catalog(spark, sf_dir)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_panel(trends(spark, sf_dir), catalog(spark, sf_dir), collapse=False)


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series with its rolling mean, staged; forecasts and histories need no metadata."""
    featured = add_time_features(clean_trends(trends(spark, sf_dir), collapse=False))
    return cut_lineage(featured.select("id", "week_start", "interest", "roll_mean_4w"))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_targets(panel(spark, sf_dir))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows with their panel row counts, written out once as several aggregates read them."""
    cat = prepare_catalog(catalog(spark, sf_dir))
    return cut_lineage(X.weighted_entities(trends(spark, sf_dir), cat))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.latest_per_entity(panel(spark, sf_dir))


def movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movers by the latest rolling mean as a model-free prediction."""
    return MV.movers_base(latest(spark, sf_dir), "roll_mean_4w")


def metric_records(spark: SparkSession, sf_dir: str, batch: str) -> DataFrame:
    """Records shaped like training metrics, from orders; the two batches overlap in 1998."""
    year, price = F.year("o_orderdate"), F.col("o_totalprice")
    rows, scale = {"old": (year <= 1998, 1000), "new": (year >= 1998, 500)}[batch]
    low, high = F.min(price), F.max(price)
    return (
        table(spark, sf_dir, "orders")
        .where(rows)
        .groupBy(
            F.concat(F.lit("run_"), year.cast("string")).alias("run_id"),
            F.lower(F.split_part("o_orderpriority", F.lit("-"), F.lit(2))).alias("family"),
            (1 + F.col("o_custkey") % 4).cast("int").alias("horizon"),
            F.concat(year.cast("string"), F.lit("-06-01T00:00:00Z")).alias("created_utc"),
        )
        .agg(
            (low / scale).alias("rmse_train"),
            (high / scale).alias("rmse_val"),
            (1 - low / high).alias("r2_train"),
            (low / high).alias("r2_val"),
            F.count(F.lit(1)).alias("n_train"),
            F.count_if(F.col("o_orderstatus") == "F").alias("n_val"),
        )
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return append_dedupe(metric_records(spark, sf_dir, "old"), metric_records(spark, sf_dir, "new"))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round results of root, logarithm and division for comparison."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})
