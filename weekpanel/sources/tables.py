"""Parquet, CSV and JSON tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weekpanel.schemas import FEATURE_CONTRACT, VOCABULARY


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table, with only the needed columns read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


#: Names of the tables that only this session's catalog knows; their files lie where the caller says.
STAGED = "weekpanel_staged_"


def write_by_key(df: DataFrame, path: str, key: str = "id", order: Sequence[str] = (), *, dealt: bool = False) -> DataFrame:
    """Write ``df`` in buckets by ``key``, and the table that reads it.

    Windows, aggregates and joins by the key then read it without an exchange, as often as they like. There are as many
    buckets as shuffle partitions. ``dealt`` rows come from a window or join by the key and are not moved once more.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df if dealt else df.repartition(n, key)
    name = f"{STAGED}{uuid.uuid4().hex}"
    writer = rows.write.mode("overwrite").format("parquet").bucketBy(n, key).option("path", path)
    writer.sortBy(key, *order).saveAsTable(name)
    return spark.table(name)


def forget_staged(spark: SparkSession) -> None:
    """Take staged tables out of the catalog; their files stay."""
    for t in spark.catalog.listTables():
        if t.name.startswith(STAGED):
            spark.sql(f"drop table if exists `{t.name}`")


def write_run(df: DataFrame, path: str, run: Mapping[str, str]) -> None:
    """Write one run of a run-versioned table laid out as ``run_id=.../week_start=...``; a retry replaces it."""
    keys = ("run_id", "week_start")
    marked = df.withColumns({f"_{k}": F.lit(run[k]) for k in keys}).drop(*keys)
    renamed = marked.withColumnsRenamed({f"_{k}": k for k in keys})
    writer = renamed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def read_run(spark: SparkSession, path: str, run: Mapping[str, str]) -> DataFrame:
    """One run of a run-versioned table; other runs' folders are not listed into the scan."""
    keys = ("run_id", "week_start")
    found = spark.read.parquet(path).schema
    # As text: the values are names, and a run called 007 is not 7.
    schema = StructType([StructField(f.name, StringType()) if f.name in keys else f for f in found.fields])
    df = spark.read.schema(schema).parquet(path)
    for k in keys:
        df = df.where(F.col(k) == run[k])
    return df


def write_csv(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for results whose size a limit bounds."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_contract(spark: SparkSession, names: Sequence[str], path: str) -> None:
    """The ordered feature names."""
    rows = spark.createDataFrame(list(enumerate(names)), FEATURE_CONTRACT)
    rows.coalesce(1).write.mode("overwrite").json(path)


def read_contract(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.schema(FEATURE_CONTRACT).json(path).orderBy("position").collect()
    if not rows:
        raise ValueError(f"the feature contract at {path} is empty")
    return [r["name"] for r in rows]


def write_vocabulary(vocab: DataFrame, path: str) -> None:
    vocab.select("term", "idx").coalesce(1).write.mode("overwrite").json(path)


def read_vocabulary(spark: SparkSession, path: str) -> list[str]:
    """The terms in their stored order."""
    return [r["term"] for r in spark.read.schema(VOCABULARY).json(path).orderBy("idx").collect()]
