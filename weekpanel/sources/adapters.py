"""The library's inputs as views over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekpanel.operators.panel import weekly_series

# Fixed value: last air dates are taken from before this day, so that some lie after a row's week.
LAST_AIR_BEFORE = "1999-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trends(spark: SparkSession, sf_dir: str, key: str = "l_partkey") -> DataFrame:
    """Weekly quantity per part (or supplier), as a share of the entity's best week."""
    return weekly_series(table(spark, sf_dir, "lineitem"), key, "l_shipdate", "l_quantity")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part attributes as the entity dimension."""
    shipped = F.col("l_shipdate").cast("date")
    early = F.when(shipped < F.lit(LAST_AIR_BEFORE).cast("date"), shipped)
    votes = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(
            F.min(shipped).alias("first_air_date"),
            F.max(early).alias("last_air_date"),
            # Summed as decimals, so that the order of rows cannot change the result.
            F.round(
                F.sum(F.col("l_discount").cast("decimal(18,2)")).cast("double")
                / F.count("l_discount")
                * 100,
                4,
            ).alias("vote_average"),
            F.count(F.lit(1)).alias("vote_count"),
        )
    )
    key, size = F.col("p_partkey"), F.col("p_size")

    def code(prefix: str, n: int, c=size):
        return F.concat(F.lit(prefix), (c % n).cast("string"))

    return (
        table(spark, sf_dir, "part")
        .join(votes, "p_partkey", "left")
        .select(
            key.alias("id"),
            F.col("p_name").alias("name"),
            F.concat(F.lit("Part "), key.cast("string")).alias("original_name"),
            "first_air_date",
            "last_air_date",
            F.when(size % 11 != 0, code("ST", 4)).alias("status"),
            F.col("p_type").alias("type"),
            (size > 25).alias("in_production"),
            size.alias("number_of_seasons"),
            F.when(key % 10 != 0, size.cast("double")).alias("episode_run_time_mean"),
            F.col("p_retailprice").alias("popularity"),
            "vote_average",
            "vote_count",
            F.concat(
                "p_name", F.lit(" "), F.lower("p_type"), F.lit(" size"), size.cast("string")
            ).alias("keywords"),
            F.when(size % 7 != 0, code("C", 5)).alias("certification"),
            F.concat("p_type", F.lit(", "), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("genres"),
            F.col("p_brand").alias("networks"),
            code("L", 6, key).alias("language"),
        )
    )
