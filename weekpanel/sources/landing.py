"""The per-entity cache of landed series, and loads that resume where they stopped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weekpanel.functions.casts import to_date, to_id, to_number
from weekpanel.schemas import CACHE_ROW
from weekpanel.session import scratch_path

_BUCKET = "cache_bucket"


def _typed(rows: DataFrame, schema: str) -> DataFrame:
    """Text columns to the types of ``schema``; a value that does not fit is NULL, its row stays."""
    casts = {"double": to_number, "date": to_date, "bigint": to_id}
    fields = StructType.fromDDL(schema).fields
    return rows.withColumns({f.name: casts.get(f.dataType.simpleString(), F.col)(f.name) for f in fields})


def _as_text(schema: str, *more: str) -> str:
    return ", ".join([*(f"{f.name} string" for f in StructType.fromDDL(schema).fields), *more])


def _replace(df: DataFrame, path: str, column: str) -> None:
    """Write ``df`` over the folders of the values it has; other folders stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
    writer.partitionBy(column).csv(path)


def write_entity_cache(df: DataFrame, path: str, id_col: str = "id") -> None:
    """One CSV file per entity, in a folder of its own; for sources of few, long series.

    A series has one row per week, so no entity is too long for one task. A later load of an entity replaces the
    earlier one.
    """
    _replace(df.repartition(id_col), path, id_col)


def read_entity_cache(spark: SparkSession, path: str, schema: str = CACHE_ROW, id_col: str = "id") -> DataFrame:
    """All entities' cached rows; the id comes from the path. A week with an unusable value has NULL there; rows without
    a week are dropped, whatever columns are asked for."""
    rows = spark.read.schema(_as_text(schema, f"{id_col} bigint")).option("header", True).csv(path)
    return _typed(rows, schema).na.drop(subset=["week_start"])


def read_cache_files(spark: SparkSession, path: str, schema: str = CACHE_ROW, id_col: str = "id") -> DataFrame:
    """Flat cache files named ``<id>.csv``, read like the entity cache; empty files have no rows."""
    rows = spark.read.schema(_as_text(schema)).option("header", True).csv(path)
    entity = F.regexp_extract("_metadata.file_name", r"^([0-9]+)\.csv$", 1).try_cast("bigint")
    return _typed(rows.withColumn(id_col, entity), schema).na.drop(subset=[id_col, "week_start"])


def write_bucketed_cache(df: DataFrame, path: str, buckets: int, id_col: str = "id") -> None:
    """The cache for many entities: a fixed number of folders, entities spread by hash.

    Entities that are there already are replaced: the touched folders are written anew from their other entities and the
    new rows. Tasks are as many as the data needs; a large folder is written by several.
    """
    spark = df.sparkSession
    bucket = F.pmod(F.hash(id_col), F.lit(buckets))
    marked = df.withColumn(_BUCKET, bucket)
    staged = scratch_path(spark, "cache")
    marked.write.parquet(staged)
    marked = spark.read.parquet(staged)
    try:
        old = spark.read.schema(marked.schema).option("header", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        touched = marked.select(_BUCKET).distinct()
        kept = old.join(touched, _BUCKET, "left_semi").join(marked.select(id_col).distinct(), id_col, "left_anti")
        merged = scratch_path(spark, "cache")
        marked.unionByName(kept).write.parquet(merged)
        marked = spark.read.parquet(merged)
    _replace(marked.hint("rebalance", _BUCKET), path, _BUCKET)


def read_bucketed_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _typed(spark.read.schema(_as_text(schema)).option("header", True).csv(path), schema)


def unusable(rows: DataFrame, column: str = "interest") -> int:
    """How many landed rows have no usable value."""
    return rows.where(F.col(column).isNull()).count()


def require_loaded(report: DataFrame) -> DataFrame:
    """The load report; raises if a load that had something to do gained no row."""
    row = report.first()
    if row["attempted"] and not row["rows"]:
        raise ValueError(f"the load produced nothing: {row['attempted']} attempted, {row['failed']} failed")
    return report


def not_landed(wanted: DataFrame, landed: DataFrame, id_col: str = "id") -> DataFrame:
    """Entities still to load. Repeated ids collapse map-side before the join."""
    return wanted.join(landed.select(id_col).distinct(), id_col, "left_anti")


def landed(wanted: DataFrame, done: DataFrame, id_col: str = "id") -> DataFrame:
    """Entities that a cache already serves."""
    return wanted.join(done.select(id_col).distinct(), id_col, "left_semi")


def load_budget(wanted: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` entities in catalog order."""
    return wanted.orderBy(*order).limit(n)


def load_report(wanted: DataFrame, cached: DataFrame, fetched: DataFrame, id_col: str = "id") -> DataFrame:
    """How many entities were attempted, served by the cache, fetched or failed, and the rows gained.

    Rows are counted per entity before the joins, so the joins are one to one.
    """

    def sizes(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(id_col).agg(F.count(F.lit(1)).alias(name))

    state = (
        wanted.select(id_col)
        .join(sizes(cached, "_cached"), id_col, "left")
        .join(sizes(fetched, "_fetched"), id_col, "left")
    )
    hit = F.col("_cached").isNotNull()
    new = ~hit & F.col("_fetched").isNotNull()
    gained = F.when(hit, F.col("_cached")).otherwise(F.coalesce("_fetched", F.lit(0)))
    return state.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(hit).alias("used_cache"),
        F.count_if(new).alias("fetched"),
        F.count_if(~hit & ~new).alias("failed"),
        F.coalesce(F.sum(gained), F.lit(0)).alias("rows"),
    )


def usable_series(rows: DataFrame) -> DataFrame:
    """Landed rows with a usable value."""
    return rows.withColumn("interest", to_number("interest")).na.drop(subset=["interest"])
