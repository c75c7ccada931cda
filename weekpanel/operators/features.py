"""Feature steps on the panel. Text and category work happens per entity, weighted by its panel rows.

The metadata of an entity is the same in all its rows, so counting an entity ``n_weeks`` times gives what
counting its rows would give, without building token rows for every week.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekpanel.functions.casts import to_date
from weekpanel.functions.text import split_list
from weekpanel.operators.quantile import grouped_percentile
from weekpanel.session import broadcast_if_small, cut_lineage

# Sizes of the kept vocabularies.
TOP_GENRES = 15
TOP_NETWORKS = 20
TOP_TERMS = 200


def freshness(df: DataFrame, week: str = "week_start", last: str = "last_air_date") -> DataFrame:
    """Days since the last air date: raw, clipped at 0, and a flag for dates after the week."""
    raw = F.datediff(to_date(week), to_date(last))
    return df.withColumn("freshness_raw", raw).withColumns(
        {
            "freshness_days": F.when(F.col("freshness_raw") < 0, 0).otherwise(F.col("freshness_raw")),
            "freshness_future_flag": F.coalesce(F.col("freshness_raw") < 0, F.lit(False)).cast("int"),
        }
    )


def entity_weights(panel: DataFrame, id_col: str = "id") -> DataFrame:
    """How many panel rows each entity has."""
    return panel.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_weeks"))


def weighted_entities(panel: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog rows of the entities in the panel, with their row count as ``n_weeks``."""
    return catalog.join(entity_weights(panel), "id", "inner")


def _weight(df: DataFrame, weight: str | None) -> Column:
    return F.col(weight) if weight else F.lit(1)


def mode_value(df: DataFrame, column: str, weight: str | None = "n_weeks") -> DataFrame:
    """One row with the most frequent non-null value, the smallest on ties; no row if all are null."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return (
        counts.agg(F.sum(_weight(df, weight)).alias("_n"))
        .orderBy(F.desc("_n"), F.asc(column))
        .limit(1)
        .select(column)
    )


def impute_mode(df: DataFrame, column: str = "certification", weight: str | None = "n_weeks") -> DataFrame:
    """Fill missing values with the mode."""
    return df.withColumn(column, F.coalesce(F.col(column), mode_value(df, column, weight).scalar()))


def impute_group_median(
    df: DataFrame,
    column: str = "episode_run_time_mean",
    group: str = "genres",
    weight: str | None = "n_weeks",
) -> DataFrame:
    """Fill with the group's median, then what is left with the median of the filled column."""
    # Used twice, and measured: few short groups are broadcast, others are joined with adaptive skew handling.
    medians = cut_lineage(grouped_percentile(df, [group], column, 0.5, weight, out="_median"))
    filled = (
        df.join(broadcast_if_small(medians), group, "left")
        .withColumn(column, F.coalesce(F.col(column), F.col("_median")))
        .select(*df.columns)
    )
    overall = grouped_percentile(filled, [], column, 0.5, weight, out="_median")
    return filled.withColumn(column, F.coalesce(F.col(column), overall.scalar()))


def top_tokens(df: DataFrame, column: str, n: int, weight: str | None = "n_weeks") -> DataFrame:
    """The ``n`` most frequent items of a comma-separated column; repeats inside a list count."""
    # Outer, as a plain explode would split the list a second time in a filter below it.
    items = df.select(F.explode_outer(split_list(column)).alias("token"), _weight(df, weight).alias("_w"))
    counts = items.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("_w").cast("bigint").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("token")).limit(n)


def keep_tokens(df: DataFrame, column: str, names: Sequence[str], out: str) -> DataFrame:
    """The sparse multi-hot row: the kept vocabulary items of the list, sorted, without repeats."""
    vocabulary = F.array(*[F.lit(n) for n in sorted(names)]).cast("array<string>")
    return df.withColumn(out, F.array_intersect(vocabulary, split_list(column)))


def multihot_pairs(df: DataFrame, kept: str, prefix: str, id_col: str = "id") -> DataFrame:
    """The multi-hot matrix as (id, feature, value) for its ones."""
    ones = df.select(id_col, F.explode_outer(kept).alias("_token")).where(F.col("_token").isNotNull())
    return ones.select(id_col, F.concat(F.lit(prefix), "_token").alias("feature"), F.lit(1).alias("value"))


def names_of(top: DataFrame, column: str = "token") -> list[str]:
    """The names of a vocabulary that a limit already bounds."""
    return sorted(r[0] for r in top.select(column).collect())
