"""Shared folder for checkpoints and scratch tables, and the size check for broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tables whose values take no more bytes are broadcast: a few MB per executor, whatever their rows look like.
BROADCAST_BYTES = 8 << 20
ROW_BYTES = 32


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a fresh local one only for an unconfigured local master."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="weekpanel-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the scratch tables of this application. Frames that still read them must not be used afterwards."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/scratch")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def configured(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for as long as the block runs."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once as a table in the shared folder; its readers prune columns and push filters down."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def value_bytes(df: DataFrame) -> Column:
    """Bytes that the values of all rows take, as an aggregate: text as it is long, and a constant for each row."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema.fields]
    return F.coalesce(F.sum(sum(texts, F.lit(ROW_BYTES)).cast("bigint")), F.lit(0))


def broadcast_if_small(df: DataFrame, n_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only when the measured bytes allow it; otherwise leave the join to AQE."""
    size = df.agg(value_bytes(df)).first()[0] if n_bytes is None else n_bytes
    return F.broadcast(df) if size <= BROADCAST_BYTES else df
