"""Exact ordering over a whole table, without ever sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.session import cut_lineage

# Fixed value: monotonically_increasing_id keeps the row number in its low 33 bits.
_ROW_BITS = 33
# Up to so many rows are picked by a top-n, which ends in one task.
TOP_ROWS = 10_000


def global_rank(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Row numbers 1..n in ``order``, which should end in a unique key.

    The table is range-partitioned on the full order (so equal leading values spread over tasks too),
    sorted per partition and materialised, which fixes the partition bounds. Only one count per
    partition is then summed up and broadcast.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = cut_lineage(ranged.withColumn("_pos", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_pos", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    row = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        fixed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + row + 1)
        .drop("_part", "_pos", "_before")
    )


def top_rank(df: DataFrame, order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """The first ``n`` rows with their row numbers; a top-n first, so at most ``n`` rows are numbered."""
    numbered = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return df.orderBy(*order).limit(n).withColumn(out, numbered)


def page(df: DataFrame, order: Sequence[Column], number: int, size: int = 50, out: str = "rank") -> DataFrame:
    """One page of the ranked table, counted from 1. Late pages come from a ranking spread over tasks."""
    first, last = (number - 1) * size + 1, number * size
    ranked = top_rank(df, order, last, out) if last <= TOP_ROWS else global_rank(df, order, out)
    return ranked.where(F.col(out).between(first, last))


def page_count(df: DataFrame, size: int = 50) -> DataFrame:
    return df.agg(F.ceil(F.count(F.lit(1)) / size).alias("n_pages"))
